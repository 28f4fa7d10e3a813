"""Tokenizing inside tasks.

A byte-level tokenizer cuts texts before each space that a non-space follows,
whatever else it does. So a text's ids are those of its pieces, and the pieces
of a corpus repeat. Texts are cut and their different pieces found by Arrow;
each piece of some texts is looked up once. Punctuation after a word of Latin
letters is a piece of its own. The encoder keeps the ids of pieces it has met,
within a fixed number of entries, and gives the library only new ones: many in
one text, whose ids are cut where a token begins with the space mark, as each
piece has one space, its first character.

The cutting rules are the slowest part of the library. Pieces of Latin letters,
ASCII digits and punctuation, and single line breaks among them, skip the rules
if the vocabulary has no token across a cut that these would make: then no
merge crosses one, and the model alone gives the same ids.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from functools import lru_cache
from string import digits, punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BEFORE_WORD = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?=\s)| $")
_LONGEST_KEPT = 48
#: The byte-level alphabet's sign for a space.
_MARK = "\u0120"
#: Letters up to U+024F are letters to the library, too, whatever its Unicode version.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
#: Punctuation after a word that is looked up by itself, in characters.
_TAIL = 3
#: The byte-level alphabet by byte: printable bytes stand for themselves, the others are counted from 256 on.
_OTHERS = [*range(33), *range(127, 161), 173]
_SIGNS = [chr(256 + _OTHERS.index(i)) if i in _OTHERS else chr(i) for i in range(256)]
#: A word of letters, and the punctuation after it that is looked up by itself.
_WORD = re.compile("([%s]+)([%s]{0,%d})" % (_LETTERS, re.escape(punctuation), _TAIL)).fullmatch
#: For Arrow: a word of letters, and text that may go past the cutting rules (an apostrophe may begin a contraction).
_LATIN = f"^[{_LETTERS}]+$"
_SIMPLE = "[" + _LETTERS + "0-9" + re.escape(punctuation.replace("'", "")) + "]+"
_SIMPLE = f"^{_SIMPLE}(?:\n{_SIMPLE})*$"
#: New pieces that go to the library as one text.
_TOGETHER = 50
#: Bytes of text to encode at once, for tasks that keep the ids; different pieces are then few.
TOGETHER = 4_000_000
#: Characters whose pieces are looked up together.
_BATCH = 4_000_000
#: Pieces whose ids are kept; a cache that has more begins anew.
_ENTRIES = 400_000


_BYTE_OF = {c: i for i, c in enumerate(_SIGNS)}
#: The kinds of characters that the cutting rules part from each other; of others, and of bytes that are no character, none.
_KINDS = {c: "letter" for c in _LETTERS} | {c: "digit" for c in digits} | {c: "sign" for c in punctuation if c != "'"}
_KINDS |= {" ": "space", "\n": "break"} | {chr(0xDC00 + i): "letter" for i in [*range(0x80, 0xC0), *range(0xC2, 0xCA)]}


def _crosses_cut(token: str) -> bool:
    """Whether a token can be in simple pieces, each after a space, and reach over a cut in them."""
    if not all(c in _BYTE_OF for c in token):
        return True
    kinds = [_KINDS.get(c) for c in bytes(_BYTE_OF[c] for c in token).decode(errors="surrogateescape")]
    pairs = [(x, y) for x, y in zip(kinds, kinds[1:]) if x != y or x in ("space", "break")]
    blank = {"space", "break"}
    if None in kinds or any(blank.issuperset(p) for p in pairs):
        return False  # such a text is not simple
    return any(x != "space" for x, _ in pairs)


class Encoder:
    """Ids of texts as little-endian arrays, the same as the library's encode(add_special_tokens=False).

    ``plain``: the strings of special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 2 ** 16 else "<u4")
        self.special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space") and not spec["normalizer"] and not spec["truncation"])
        self.pieces: dict[str, bytes] = {}
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab(True)
            self.words = self._model_alone(spec["model"], vocabulary)
            self.tails: dict[str, bytes] = {}  # ids of runs of punctuation: at most 32 ** _TAIL and shorter ones
            self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
            self.opens[[i for t, i in vocabulary.items() if t.startswith(_MARK)]] = True

    def _model_alone(self, model: dict, vocabulary: dict[str, int]):
        """The tokenizer without its cutting rules; None if simple texts need these."""
        from tokenizers import Tokenizer

        added = self.tokenizer.get_added_tokens_decoder().values()
        if (model.get("type", "BPE") != "BPE" or model.get("ignore_merges") or model.get("dropout")
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
                or any(not t.special for t in added)
                or any(_crosses_cut(t) for t in vocabulary.keys() - {t.content for t in added})):
            return None
        return Tokenizer(self.tokenizer.model)  # shared; added tokens stay out

    def _direct(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, tokenizer, pieces: list[str], signs: bool) -> list[bytes] | None:
        """Ids of pieces without a space, each with one before it; None if they cannot be told apart.
        signs: the tokenizer takes the signs of their bytes."""
        texts = [" " + " ".join(pieces[i:i + _TOGETHER]) for i in range(0, len(pieces), _TOGETHER)]
        if signs:
            texts = [t.encode().decode("latin-1").translate(_SIGNS) for t in texts]
        ids = np.concatenate([np.zeros(0, self.dtype)] + [
            np.array(e.ids, self.dtype) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(pieces) or (len(at) and at[0]):
            return None
        data, width = ids.tobytes(), self.dtype.itemsize
        ends = (np.append(at[1:], len(ids)) * width).tolist()
        return [data[i:j] for i, j in zip((at * width).tolist(), ends)]

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self._direct([tail])[0]
        return self.tails[tail]

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces, each after a space."""
        simple = [False] * len(pieces)
        if self.words is not None:
            simple = pc.match_substring_regex(pa.array(pieces, pa.large_string()), _SIMPLE).to_pylist()
        alone, some, other = [], [], []
        for p, x in zip(pieces, simple):
            (alone if x else other if not p or " " in p else some).append(p)
        known: dict[str, bytes] = {}
        for part, tokenizer, signs in ((alone, self.words, True), (some, self.tokenizer, False)):
            ids = self._together(tokenizer, part, signs) if part else []
            if ids is None:
                other += part
            else:
                known.update(zip(part, ids))
        known.update(zip(other, self._direct([" " + p for p in other])))
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_piece:
            return [np.frombuffer(x, self.dtype) for x in self._direct(texts)]
        collects = gc.isenabled()
        gc.disable()  # lists of pieces make no cycles, and there are many to look through
        out: list[np.ndarray | None] = [None] * len(texts)
        size, todo = 0, []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = np.frombuffer(self._direct([text])[0], self.dtype)
                continue
            todo.append((i, text))
            size += len(text)
            if size > _BATCH:
                self._fill(todo, out)
                size, todo = 0, []
        if todo:
            self._fill(todo, out)
        if collects:
            gc.enable()
        return out

    def _fill(self, todo: list[tuple[int, str]], out: list) -> None:
        """Each piece is looked up once for all texts that hold it."""
        if len(self.pieces) > _ENTRIES:
            self.pieces.clear()
        odd = [(i, t) for i, t in todo if _ODD.search(t)]
        if odd:
            left = {i for i, _ in odd}
            todo = [x for x in todo if x[0] not in left]
        held = []
        if todo:
            held.append(pc.split_pattern(pa.array([t for _, t in todo], pa.large_string()), " "))
        if odd:
            held.append(pa.array([_BEFORE_WORD.split(t) for _, t in odd], pa.list_(pa.large_string())))
        cuts = np.cumsum([0, *(n for x in held for n in x.value_lengths().to_pylist())])
        flat = pa.concat_arrays([x.flatten() for x in held])
        first = self._direct(flat.take(pa.array(cuts[:-1])).to_pylist())
        inner = np.ones(len(flat), bool)
        inner[cuts[:-1]] = False  # a text's first piece has no space before it
        words = flat.filter(pa.array(inner)).dictionary_encode()
        ids, sizes = self._ids(words.dictionary)
        codes = words.indices.to_numpy()
        ends = np.cumsum(sizes[codes])
        ids = _gathered(ids, sizes, codes)
        at = np.append(0, ends)[cuts - np.arange(len(cuts))].tolist()
        for (i, _), head, begin, end in zip(todo + odd, first, at, at[1:]):
            out[i] = np.concatenate([np.frombuffer(head, self.dtype), ids[begin:end]])

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different pieces, each after a space, one after the other, and how many each has."""
        core = pc.utf8_rtrim(pieces, characters=punctuation)
        whole = pc.binary_length(pieces)
        closed = pc.and_(pc.and_(pc.less(pc.binary_length(core), whole),
                                 pc.less_equal(pc.subtract(whole, pc.binary_length(core)), _TAIL)),
                         pc.match_substring_regex(core, _LATIN))
        keys = pc.if_else(closed, core, pieces).dictionary_encode()
        tails = pc.if_else(closed, pc.utf8_ltrim(pieces, characters=_LETTERS), "").dictionary_encode()
        parts = self._known(keys.dictionary.to_numpy(zero_copy_only=False).tolist())
        n_keys = len(parts)
        parts += map(self._tail, tails.dictionary.to_pylist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        codes = np.stack([keys.indices.to_numpy(), tails.indices.to_numpy() + n_keys], axis=1)
        ids = _gathered(np.frombuffer(b"".join(parts), self.dtype), sizes, codes.ravel())
        return ids, sizes[codes].sum(axis=1)

    def _known(self, pieces: list[str]) -> list[bytes]:
        ids = self.pieces
        got = list(map(ids.get, pieces))
        if None in got:
            gap = [k for k, x in enumerate(got) if x is None]
            some = self._new([pieces[k] for k in gap])
            for k in gap:
                got[k] = some[pieces[k]]
            ids.update(some)
            for p in some:
                if len(p) > _LONGEST_KEPT:
                    del ids[p]
        return got


def _gathered(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of the parts with these numbers, one after the other; ids: those of all parts, of these sizes."""
    starts, sizes = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
    ends = np.cumsum(sizes)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path, plain)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    import zlib
    return zlib.crc32(ids.astype("<u4"))
