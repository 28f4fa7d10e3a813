"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are lower-cased and cut into words at ASCII characters other than letters
and digits. A document leaks an item of m words if some passage of it is within ``edit_share * m`` word edits of the item.

Windows of an item's size are embedded by the CGK random walk: at step j the
symbol under the pointer is written, and a random bit of (j, symbol) moves the
pointer or not. Few edits between two windows then leave most steps equal. An
LSH table samples some steps; windows and items that agree on all of them are
candidates, and an exact edit distance decides. The numbers of walks and of
steps in a key are set per size class, by trial on its largest items, edited as
much as the limit allows and searched at all shifts, so that one walk meets with
the target recall. Where no number of walks in reach does, and for very long
items, every window that can lie is a candidate.

Windows are only embedded where they can lie: k edits leave one of k + 1
segments of the item untouched, so a window that has none of its segments in
place, give or take k words, is too far away. That test loses nothing.

Documents are read once, in place; nothing is shuffled. Items are compared in
blocks of bounded size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from . import common

_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_U = np.uint64
_PAD, _UNKNOWN = 1, 0
#: Sizes up to this ratio apart have their walks in common.
_CLASS_RATIO = 1.25
#: Items of more words, or that need more walks, have all their windows aligned: that costs no more.
_MOST_WORDS, _MOST_WALKS = 512, 16
_MIX1, _MIX2, _MIX3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _salt(*numbers: int) -> np.uint64:
    out = 0
    for n in numbers:
        out = (out * int(_MIX2) + (n + 1) * int(_MIX3)) % 2 ** 64
    return _U(out)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORDS).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX2
    x = (x ^ (x >> _U(27))) * _MIX3
    return x ^ (x >> _U(31))


def embed(windows: np.ndarray, walk: int) -> np.ndarray:
    """The CGK walk over rows of m symbols: 3 m steps each."""
    n, m = windows.shape
    padded = np.concatenate([windows.astype(np.uint64), np.full((n, 1), _PAD, np.uint64)], axis=1)
    at, rows = np.zeros(n, np.int64), np.arange(n)
    out = np.empty((n, 3 * m), np.uint64)
    for j in range(3 * m):
        symbol = padded[rows, at]
        out[:, j] = symbol
        moves = _mix(symbol * _MIX1 + _salt(walk, j)) >> _U(63)
        at = np.minimum(at + moves.astype(np.int64), m)
    return out


def _sampled(m: int, walk: int, tables: int, bits: int) -> np.ndarray:
    """Steps to compare; after about 2 m of them a walk is at the window's end."""
    return np.random.default_rng([m, walk]).integers(0, 2 * m, (tables, bits))


def lsh_keys(windows: np.ndarray, walk: int, tables: int, bits: int) -> np.ndarray:
    """(tables, windows): hashes of the sampled steps."""
    m = windows.shape[1]
    steps = embed(windows, walk)
    keys = np.full((tables, len(windows)), _U(m), np.uint64)
    for t, places in enumerate(_sampled(m, walk, tables, bits)):
        keys[t] += _salt(walk, t)
        for p in places:
            keys[t] = _mix(keys[t] * _MIX2 + steps[:, p])
    return keys


def gram_hashes(ids: np.ndarray, g: int) -> np.ndarray:
    """Of every run of g words; needs g of them at least."""
    h = np.zeros(len(ids) - g + 1, np.uint64)
    for k in range(g):
        h = h * _MIX1 + ids[k:len(ids) - g + 1 + k].astype(np.uint64)
    return _mix(h + _U(g))


def best_alignment(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(fewest edits that turn some run of region into the item, where the run ends). Unknown words equal nothing."""
    row = np.zeros(len(region) + 1, np.int64)
    steps = np.arange(len(region) + 1)
    for i, word in enumerate(item, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (region != word))
        new = np.concatenate([[i], new])
        row = np.minimum.accumulate(new - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


class ItemIndex:
    """The items' segments, LSH tables and words: what a task needs of a block of items."""

    def __init__(self, items: Sequence[tuple[int, str]], edit_share: float, min_words: int, recall: float,
                 tables: int = 4, bits: int = 4):
        self.tables, self.bits = tables, bits
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int] = []
        self.words: list[np.ndarray] = []
        self.edits: list[int] = []
        for item_id, text in items:
            words = words_of(text or "")
            if words:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words]))
                self.edits.append(int(edit_share * len(words)) if len(words) >= min_words else 0)
        segments = defaultdict(list)  # (gram length) -> (hash, item, place)
        for i, (w, k) in enumerate(zip(self.words, self.edits)):
            cuts = [len(w) * s // (k + 1) for s in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                segments[b - a].append((int(gram_hashes(w[a:b], b - a)[0]), i, a))
        self.segments = {}
        for g, rows in segments.items():
            rows.sort()
            self.segments[g] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.int64))
        self.plan = self._plan(recall)
        self.lsh: dict[int, np.ndarray] = {}
        self.lsh_items: dict[int, np.ndarray] = {}
        by_size = defaultdict(list)
        for i, w in enumerate(self.words):
            by_size[len(w)].append(i)
        for m, items_m in by_size.items():
            walks, bits = self.plan[m]
            if not walks:
                continue
            keys = np.concatenate([lsh_keys(np.stack([self.words[i] for i in items_m]), r, tables, bits)
                                   for r in range(walks)]).ravel()
            owner = np.tile(np.array(items_m), walks * tables)
            order = np.argsort(keys, kind="stable")
            self.lsh[m], self.lsh_items[m] = keys[order], owner[order]

    def _plan(self, recall: float) -> dict[int, tuple[int, int]]:
        """{size: (walks, bits)}; no walks where all windows are to be aligned. Whole copies always meet."""
        plan, classes = {}, defaultdict(list)
        for i, w in enumerate(self.words):
            if self.edits[i]:
                classes[int(np.log(len(w)) / np.log(_CLASS_RATIO))].append(i)
            else:
                plan[len(w)] = 1, self.bits
        for own in classes.values():
            own.sort(key=lambda i: (-len(self.words[i]), i))
            found = self._walks_for(own[:4], recall)
            plan.update((len(self.words[i]), found) for i in own)
        return plan

    def _walks_for(self, items: Sequence[int], recall: float, trials: int = 40) -> tuple[int, int]:
        """Walks and bits by which the items, edited to their limit, share a key with the target
        probability, or better by half of what that lacks to 1; most bits that do so in few walks."""
        if len(self.words[items[0]]) > _MOST_WORDS:
            return 0, self.bits
        rng = np.random.default_rng(5)
        windows = [np.concatenate([self._shifts(i, rng) for _ in range(-(-trials // len(items)))]) for i in items]
        met = {(b, i): np.zeros(-(-trials // len(items)), bool) for b in range(1, self.bits + 1) for i in items}
        enough: dict[int, int] = {}
        for walk in range(_MOST_WALKS):
            for i, rows in zip(items, windows):
                w = self.words[i]
                same = embed(rows, walk) == embed(w[None], walk)
                for b in range(1, self.bits + 1):
                    hit = same[:, _sampled(len(w), walk, self.tables, b)].all(axis=2).any(axis=1)
                    met[b, i] |= hit.reshape(len(met[b, i]), -1).any(axis=1)
            for b in range(1, self.bits + 1):
                if b not in enough and np.mean([met[b, i] for i in items]) >= (1 + recall) / 2:
                    enough[b] = walk + 1
            if self.bits in enough:
                break
        return (enough[max(enough)], max(enough)) if enough else (0, self.bits)

    def _shifts(self, i: int, rng) -> np.ndarray:
        """The windows at which the item is looked for, edited to its limit among unknown words."""
        w, k = self.words[i], self.edits[i]
        edited = list(w)
        for _ in range(k):
            at = rng.integers(len(edited))
            kind = rng.integers(3)
            if kind == 0:
                edited[at] = _UNKNOWN
            elif kind == 1:
                edited.insert(at, _UNKNOWN)
            elif len(edited) > 1:
                del edited[at]
        around = np.array([_UNKNOWN] * k + edited + [_UNKNOWN] * (len(w) + 2 * k))
        return np.lib.stride_tricks.sliding_window_view(around, len(w))[:2 * k + 1]

    def windows(self, texts: list[np.ndarray]) -> tuple[set[tuple[int, int, int]], dict[tuple[int, int], set[int]]]:
        """(size, text, start) of the windows that have a segment of an item in place,
        and {(text, item): window starts} for the items without walks."""
        out: set[tuple[int, int, int]] = set()
        all_of_them = defaultdict(set)
        # One row of all texts, with an unknown word after each.
        ids = np.concatenate([np.zeros(0, np.int64), *(x for t in texts for x in (t, [_UNKNOWN]))])
        begins = [0, *np.cumsum([len(t) + 1 for t in texts]).tolist()]
        known = ids != _UNKNOWN
        for g, (hashes, owners) in self.segments.items():
            if len(ids) < g:
                continue
            whole = np.flatnonzero(np.convolve(known, np.ones(g, np.int64), "valid") == g)
            if not len(whole):
                continue
            h = gram_hashes(ids, g)[whole]
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for at in np.flatnonzero(high > low).tolist():
                text = bisect_right(begins, int(whole[at])) - 1
                for item, place in owners[low[at]:high[at]].tolist():
                    m, k = len(self.words[item]), self.edits[item]
                    start = int(whole[at]) - begins[text] - place
                    if self.plan[m][0]:
                        out.update((m, text, s) for s in range(start - k, start + k + 1))
                    else:
                        all_of_them[text, item].update(range(start - k, start + k + 1))
        return out, all_of_them

    def candidates(self, texts: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
        """{(text, item): window starts} that share an LSH key or need none; texts: word ids."""
        windows, out = self.windows(texts)
        at = defaultdict(list)
        for m, text, start in sorted(windows):
            at[m].append((text, start))
        for m, places in at.items():
            walks, bits = self.plan[m]
            step = min(20_000, max(1, 1_200_000 // m))
            for part in range(0, len(places), step):
                some = places[part:part + step]
                windows = np.zeros((len(some), m), np.int64)
                for row, (doc, start) in zip(windows, some):
                    ids = texts[doc]
                    piece = ids[max(0, start):max(0, start + m)]
                    row[max(0, -start):max(0, -start) + len(piece)] = piece
                for walk in range(walks):
                    keys = lsh_keys(windows, walk, self.tables, bits)
                    low = np.searchsorted(self.lsh[m], keys, "left")
                    high = np.searchsorted(self.lsh[m], keys, "right")
                    for t, w in zip(*np.nonzero(high > low)):
                        doc, start = some[w]
                        for item in self.lsh_items[m][low[t, w]:high[t, w]]:
                            out[doc, int(item)].add(start)
        return {k: sorted(v) for k, v in out.items()}

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, edits, about the first word) of the best alignment."""
        for (doc, item), starts in sorted(self.candidates(texts).items()):
            w, k, ids = self.words[item], self.edits[item], texts[doc]
            best, done = None, -1
            for start in starts:
                if start <= done:  # inside the region before
                    continue
                low = max(0, start - k)
                done = start + 2 * k
                edits, end = best_alignment(w, ids[low:max(low, done + len(w) + k)])
                if edits <= k and (best is None or edits < best[0]):
                    best = (edits, max(0, low + end - len(w)))
            if best:
                yield doc, item, *best


def _search(index: ItemIndex, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.vocabulary.get
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                texts = []
                for text in part["text"].to_pylist():
                    words = words_of(text)
                    texts.append(np.fromiter(map(get, words, repeat(_UNKNOWN)), np.int64, len(words)))
                ids, rids = part["id"].to_pylist(), part["rid"].to_pylist()
                rows = [(ids[doc], rids[doc], index.ids[item], edits, len(index.words[item]), start)
                        for doc, item, edits, start in index.leaks(texts)]
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=[id_name, "rid", "item_id", "edits", "item_words", "start_word"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, edit_share: float = 0.2, min_words: int = 8,
               recall: float = 0.95, block_chars: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row (id, rid, item_id, edits, item_words, start_word) per document row and item that it leaks.

    ``edits`` is the fewest word edits, ``start_word`` about where the passage
    begins. Items under ``min_words`` words count only word for word, items
    without words and null texts never; null ids stay null; repeated rows and
    repeated items are reported each; either table empty gives no row; other
    columns are not read. Items are taken in blocks of about ``block_chars``
    characters, each against all documents, so that what a task holds is bounded.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("item_text"))
    size = items.agg(F.sum(F.length("item_text"))).first()[0] or 0
    n_blocks = -(-size // block_chars)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), common.row_hash(text_col).alias("rid"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"`{id_col}` long, rid long, item_id long, edits long, item_words long, start_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in range(n_blocks):
        own = items.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).orderBy("item").collect()
        index = ItemIndex([(r["item"], r["item_text"]) for r in own], edit_share, min_words, recall)
        found = rows.mapInArrow(_search(index, id_col), schema)
        out = found if n_blocks == 1 else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **limits) -> DataFrame:
    """``docs`` without the rows that leak an item."""
    bad = (find_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **limits)
           .select(F.col(id_col).alias("__id"), F.col("rid").alias("__rid")).distinct())
    return docs.join(checked_broadcast(bad), F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
                     & (common.row_hash(text_col) == F.col("__rid")), "left_anti")


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    leaks = find_leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "edits", "item_words", "start_word")
