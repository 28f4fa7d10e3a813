"""Alignment of the tokens of two tokenizers over the same texts.

A text is tokenized whole by both. Where a token of either ends at the same
byte and both next tokens begin with a space, the text can be cut: what lies
between two such anchors is a window, in general a word. The anchors are taken
from the tokens' byte offsets, so they hold whatever the tokenizers do inside,
and a text whose tokens' bytes are not its own has no alignment.

What aligns in a window depends on its two tuples of token ids alone, and the
windows of a corpus repeat: the groups (cut where tokens of both end), the links
(pairs of tokens whose bytes overlap) and the bytes of a window are worked out
once and kept under its id tuples, within a fixed number of entries.

The counts of linked id pairs over the corpus are sums of per-document counts,
combined before they are shuffled. They come back to the documents in two
parts that make the whole: the pairs above a count that at most ``HOT_PAIRS``
reach are broadcast (these are in a large part of all documents, and would be
hot keys); the rarer ones, none of which is frequent, are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import common, tokens

#: Id pairs that are broadcast, at most.
HOT_PAIRS = 200_000
#: Windows whose alignment a worker keeps.
_WINDOWS = 300_000
#: Texts are aligned so many bytes at a time, or one by one if they are longer.
_BYTES = 1_500_000


def byte_level(token: str) -> bytes:
    """The bytes of a byte-level token: printable characters of Latin-1 stand for themselves, the
    other bytes, in their order, for the characters from 256 on."""
    return bytes(_byte_of()[c] for c in token)


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of texts, and the bytes of its tokens."""

    def __init__(self, bytes_of: list[bytes]):
        self.table = np.array(bytes_of, object)
        self.sizes = np.array([len(x) for x in bytes_of], np.int64)
        self.spaced = np.array([x[:1] == b" " for x in bytes_of])


class ByteLevelSide(Side):
    """A byte-level BPE of the tokenizers library; a space goes before each text."""

    def __init__(self, path: str):
        self.encoder = tokens.encoder(path, plain=True)
        vocab = self.encoder.tokenizer.get_vocab(with_added_tokens=False)
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = byte_level(token) if all(c in _byte_of() for c in token) else token.encode()
        super().__init__(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [x.astype(np.int32) for x in self.encoder.encode([" " + t for t in texts])]


class PieceSide(Side):
    """A sentencepiece model that puts a space before each text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        super().__init__([bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.model.encode(texts, num_threads=1)]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _keys(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[bytes]:
    """Per window: how many of A's ids it has, these, and B's ids."""
    n = len(cuts_a) - 1
    flat = np.empty(len(a) + len(b) + n, np.int32)
    sizes_a, sizes_b = np.diff(cuts_a), np.diff(cuts_b)
    begins = cuts_a[:-1] + cuts_b[:-1] + np.arange(n)
    flat[begins] = sizes_a
    flat[_ranges(begins + 1, sizes_a)] = a
    flat[_ranges(begins + 1 + sizes_a, sizes_b)] = b
    raw, cuts = flat.tobytes(), [*(begins * 4).tolist(), len(flat) * 4]
    return [raw[i:j] for i, j in zip(cuts, cuts[1:])]


class Aligner:
    """Alignments of texts, with those of the windows met before."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        digits = [[b"%d" % i for i in range(len(s.sizes))] for s in (a, b)]
        # what a token adds to the groups as text: followed by others of its side, or the last one
        self.shown = [np.array([x + sep for sep in seps for x in d], object) for d, seps in zip(digits, ((b",", b"|"), (b",", b";")))]
        self.shown_sizes = [np.array([len(x) for x in d], np.int64) for d in self.shown]
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}  # by a window's ids: how many of A's, these, B's
        self.rendered: list[bytes] = []  # per window: its groups, each with a ; behind it
        self.bytes: list[bytes | None] = []
        self.n_groups = np.zeros(0, np.int64)
        self.link_ends = np.zeros(0, np.int64)  # per window: where its links end among all windows' ones
        self.links = np.zeros(0, np.int64)  # their id pairs: A's id, then 32 bits of B's

    def _add(self, keys: list[bytes]) -> None:
        """Aligns windows that were not met before; the sides of each have the same number of bytes."""
        flat, sizes = np.frombuffer(b"".join(keys), np.int32), np.fromiter(map(len, keys), np.int64, len(keys)) // 4
        at = np.cumsum(sizes) - sizes + 1
        tokens_of = [flat[at - 1].astype(np.int64), sizes - 1 - flat[at - 1]]
        ids = [flat[_ranges(at, tokens_of[0])], flat[_ranges(at + tokens_of[0], tokens_of[1])]]
        ends = [np.cumsum(s.sizes[x]) for s, x in zip((self.a, self.b), ids)]
        starts = [e - s.sizes[x] for e, s, x in zip(ends, (self.a, self.b), ids)]
        cut_a, cut_b = (np.cumsum(n) for n in tokens_of)
        bounds = ends[0][cut_a - 1]
        shared = np.intersect1d(*ends, assume_unique=True)
        first = np.searchsorted(ends[1], starts[0], "right")  # B tokens that overlap each A token
        n_over = np.searchsorted(starts[1], ends[0], "left") - first
        links = np.repeat(ids[0].astype(np.int64) << 32, n_over) | ids[1][_ranges(first, n_over)]
        # the groups as text: A's tokens of a group, then B's
        group_ends = [np.searchsorted(e, shared) + 1 for e in ends]
        group_of = [np.searchsorted(shared, e) for e in ends]
        shown = np.empty(len(ids[0]) + len(ids[1]), object)
        shown_sizes = np.empty(len(shown), np.int64)
        before_b = np.concatenate([[0], group_ends[1][:-1]])
        places = np.arange(len(ids[0])) + before_b[group_of[0]], np.arange(len(ids[1])) + group_ends[0][group_of[1]]
        for k in (0, 1):
            last = np.zeros(len(ids[k]), np.int64)
            last[group_ends[k] - 1] = len(self.shown[k]) // 2
            last += ids[k]
            shown[places[k]], shown_sizes[places[k]] = self.shown[k][last], self.shown_sizes[k][last]
        text, at = b"".join(shown.tolist()), [0, *np.cumsum(shown_sizes)[cut_a + cut_b - 1].tolist()]
        raw = [b"".join(s.table[x].tolist()) for s, x in zip((self.a, self.b), ids)]
        begin = len(self.rendered)
        self.rendered += [text[i:j] for i, j in zip(at, at[1:])]
        cuts = np.concatenate([[0], bounds]).tolist()
        parts = [raw[0][i:j] for i, j in zip(cuts, cuts[1:])]
        if raw[0] != raw[1]:
            parts = [x if x == raw[1][i:j] else None for x, i, j in zip(parts, cuts, cuts[1:])]
        self.bytes += parts
        self.n_groups = np.append(self.n_groups, np.diff(np.searchsorted(shared, bounds, "right"), prepend=0))
        self.link_ends = np.append(self.link_ends, len(self.links) + np.cumsum(n_over)[cut_a - 1])
        self.links = np.append(self.links, links)
        self.numbers.update(zip(keys, range(begin, len(self.rendered))))

    def n_links(self, windows: np.ndarray) -> np.ndarray:
        return self.link_ends[windows] - np.where(windows > 0, self.link_ends[windows - 1], 0)

    def windows(self, raws: list[bytes], a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray | None]:
        """Per text (with its space before it) the numbers of its windows; None without an alignment."""
        if len(self.numbers) > _WINDOWS:
            self._clear()
        sizes = np.array([len(x) for x in raws], np.int64)
        whole = [self.a.sizes[x].sum() == n == self.b.sizes[y].sum() for x, y, n in zip(a, b, sizes.tolist())]
        at = [i for i, ok in enumerate(whole) if ok and sizes[i]]
        out: list[np.ndarray | None] = [None] * len(raws)
        if not at:
            return out
        bounds = np.concatenate([[0], np.cumsum(sizes[at])])
        starts, flat = [], []
        for side, ids in ((self.a, a), (self.b, b)):
            flat.append(np.concatenate([ids[i] for i in at]))
            n = side.sizes[flat[-1]]
            starts.append(np.cumsum(n) - n)
        spaced = []  # the places of tokens that begin with a space, or a text
        for side, s, x in zip((self.a, self.b), starts, flat):
            mark = side.spaced[x]
            mark[np.searchsorted(s, bounds[:-1])] = True
            spaced.append(np.flatnonzero(mark))
        at_a, at_b = (s[k] for s, k in zip(starts, spaced))
        near = np.minimum(np.searchsorted(at_b, at_a), len(at_b) - 1)
        same = at_b[near] == at_a
        cuts = spaced[0][same], spaced[1][near[same]]
        anchors = np.append(at_a[same], bounds[-1])
        keys = _keys(*flat, *(np.append(c, len(x)) for c, x in zip(cuts, flat)))
        numbers = np.fromiter(map(self.numbers.get, keys, repeat(-1)), np.int64, len(keys))
        gaps = np.flatnonzero(numbers < 0).tolist()
        if gaps:
            new = [keys[k] for k in gaps]
            self._add(list(dict.fromkeys(new)))
            numbers[gaps] = list(map(self.numbers.__getitem__, new))
        of = np.searchsorted(anchors, bounds).tolist()
        for i, begin, end in zip(at, of, of[1:]):
            own = numbers[begin:end]
            parts = list(map(self.bytes.__getitem__, own.tolist()))
            if None not in parts and b"".join(parts) == raws[i]:
                out[i] = own
        return out

    def text(self, windows: np.ndarray) -> bytes:
        """The groups of a text's windows: a1,a2|b1;a3|b2,b3"""
        return b"".join(map(self.rendered.__getitem__, windows.tolist()))[:-1]

    def pairs(self, windows: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends per text, pairs, times): the texts' linked id pairs, and how many of a text's links hold each."""
        none = np.zeros(0, np.int64)
        flat = np.concatenate([none if w is None else w for w in windows]) if windows else none
        if not len(flat):
            return np.zeros(len(windows), np.int64), none, none
        docs = np.repeat(np.arange(len(windows)), [0 if w is None else len(w) for w in windows])
        used, times = np.unique(docs * len(self.link_ends) + flat, return_counts=True)
        docs, own = np.divmod(used, len(self.link_ends))
        sizes = self.n_links(own)
        docs, weights = np.repeat(docs, sizes), np.repeat(times, sizes)
        codes = self.links[_ranges(self.link_ends[own] - sizes, sizes)]
        order = np.lexsort((codes, docs))
        codes, docs, weights = codes[order], docs[order], weights[order]
        first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])))
        return (np.searchsorted(docs[first], np.arange(len(windows)), "right"), codes[first], np.add.reduceat(weights, first))


@lru_cache(maxsize=1)
def _aligner(a: str, b: str) -> Aligner:
    return Aligner(ByteLevelSide(a), PieceSide(b))


def _text(raw: bytes) -> str:
    """The text, or nothing where it has no tokens anyway."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return ""


_COLUMNS = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
           "pairs array<struct<pair:long,times:long>>"


def _align(a: str, b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, row = _aligner(a, b), TaskContext.get().partitionId() << 40
        for some in (x for batch in batches for x in common.by_bytes(batch, _BYTES)):
            raw = some["text"].to_pylist()
            texts = [_text(x) for x in raw]
            ids_a, ids_b = aligner.a.encode(texts), aligner.b.encode(texts)
            # texts that are empty, or no valid UTF-8, have bytes that differ from those of any tokens
            windows = aligner.windows([b" " + x if x else b"" for x in raw], ids_a, ids_b)
            ends, pairs, times = aligner.pairs(windows)
            held = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays(
                [pa.array(pairs), pa.array(times)], names=["pair", "times"]))
            sums = [[len(x) if w is not None else 0 for x, w in zip(side, windows)] for side in (ids_a, ids_b)]
            sums += [[0 if w is None else int(of(w).sum()) for w in windows] for of in (aligner.n_groups.__getitem__, aligner.n_links)]
            shown = [b"" if w is None else aligner.text(w) for w in windows]
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in shown]
            arrays = [pa.array(np.arange(row, row + len(raw))), some["id"], *[pa.array(x, pa.int64()) for x in sums],
                      pa.array(digests, pa.string()), held]
            names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
            if with_groups:
                names.append("groups")
                arrays.append(pa.array([x.decode() if x else None for x in shown], pa.string()))
            row += len(raw)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            common.give_back()
    return run


def _hot_from(scored: DataFrame, most: int) -> tuple[int, bool]:
    """The least count that at most ``most`` pairs reach, by steps of a quarter of a doubling, and
    whether other pairs are below it."""
    step = F.floor(F.log2("n") * 4).cast("int")
    rows = sorted(scored.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect(),
                  key=lambda r: -r["step"])  # a few hundred rows at most
    sums, least = 0, 2 ** 62
    for r in rows:
        sums += r["rows"]
        if sums > most:
            return least, True
        least = r["least"]
    return least, False


def aligned_tokens(docs: DataFrame, a: str | None = None, b: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text", with_groups: bool = False, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: id, tokens of both tokenizers (n_a, n_b), n_groups, n_links, the sums over
    its links of whether their id pair is its B id's most frequent one (n_best) and of their
    id pairs' counts over all documents (count_sum), and the digest of its groups of ids;
    with the groups themselves (``a1,a2|b1;a3|b2,b3``) on request.

    ``a`` is a byte-level BPE of the tokenizers library, before whose texts a
    space is put; ``b`` a sentencepiece model, which puts one there. Texts that
    are null, empty or no valid UTF-8, or whose tokens have other bytes than
    the space and the text, have no tokens: all numbers are 0 and the digest
    is ''. A null id stays null; repeated rows and rows that share an id are
    aligned and counted each; white texts are texts like others; long texts are
    aligned whole; an empty table gives no row; other columns are not read.
    """
    import public_tokenizers

    a = a or tokens.default_tokenizer()
    b = b or public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), common.utf8(text_col).alias("text"))
    schema = _COLUMNS + ", groups string" * with_groups
    aligned = materialize(rows.mapInArrow(_align(a, b, with_groups), schema), "aligned-tokens")
    links = aligned.select("row", F.inline("pairs"))
    counted = materialize(links.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    of_b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counted.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # a row per id of B's vocabulary
    scored = materialize(counted.join(F.broadcast(most), of_b == F.col("b"))
                         .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-scores")
    least, more = _hot_from(scored, hot_pairs)
    hot = F.broadcast(scored.filter(F.col("n") >= least))  # hot_pairs rows at most
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    scores = links.join(hot, "pair").groupBy("row").agg(*sums)
    if more:
        rest = links.join(hot.select("pair"), "pair", "left_anti").join(scored.filter(F.col("n") < least), "pair")
        scores = (scores.unionByName(rest.groupBy("row").agg(*sums)).groupBy("row")
                  .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return (aligned.drop("pairs").join(scores, "row", "left")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256",
                    *["groups"] * with_groups))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of byte-level and sentencepiece tokens of every document, with corpus-wide counts of linked id pairs."""
    return aligned_tokens(common.table(spark, sf_dir, "documents"))
