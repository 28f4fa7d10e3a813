"""Quality rules: fixed base rules, then an isolation forest on the rule statistics.

One pass over the texts counts the statistics. The forest is fitted on the
driver from at most ``trees * rows_per_tree`` labelled good rows (that bound
is the parameter), chosen by the smallest hash of their ids. Its cuts also fall
beyond what a tree has seen, so what good rows never have, such as symbols, is
parted from them early. Every document is scored, and the threshold comes from
all labelled rows of both classes: of those that reject at most ``good_loss`` of
the good documents, the one that rejects most bad ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize
from . import common

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_SYMBOLS = b"#*$%&|<>"
_BINS = 10_000
#: A feature that is the same in all rows of a fit is cut within so much of its value.
_LEAST_SPREAD = 0.1


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that the text has twice or more, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    grams = codes[:n]
    for k in range(1, window):  # renumbered after each word, so that no product overflows
        _, grams = np.unique(grams * len(index) + codes[k:k + n], return_inverse=True)
    again = np.flatnonzero(np.bincount(grams)[grams] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[again + k] = True
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    words = text.split()
    chars = len(text.decode()) - (len(text) - sum(map(len, words)))  # what lies between words is ASCII
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in text.split(b"\n"):
        if line.strip(common.SPACE):
            lines += 1
            repeats += line in seen
            seen.add(line)
    return (len(words), chars, sum(text.count(bytes([b])) for b in _SYMBOLS), repeats, repeated_words(words), lines)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        rows = [text_counts(t) for t in batch["text"].to_pylist()]
        columns = list(zip(*rows)) or [[]] * len(_COUNTS)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["rid"], *(pa.array(c, pa.int64()) for c in columns)],
                                         names=["id", "rid", *_COUNTS])


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rid, counts..., base_failed) per row; a null text counts as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), common.row_hash(text_col).alias("rid"),
                       common.utf8(text_col).alias("text"))
    counts = rows.mapInArrow(_count, "id long, rid long, " + ", ".join(f"{c} long" for c in _COUNTS))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Symbols count in three scales, so that trees cut by them often, at low shares too."""
    words = np.maximum(c["n_words"], 1)
    symbols = c["n_symbols"] / np.maximum(c["word_chars"], 1)
    return np.stack([np.log1p(c["n_words"]), c["word_chars"] / words, symbols,
                     c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words,
                     np.sqrt(symbols), np.log1p(c["n_symbols"] / words)], axis=1)


def _expected_path(n) -> np.ndarray:
    """Mean path of an unsuccessful search among n rows: what a leaf of n rows still hides."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1),
                    (n == 2) * 1.0)


class IsolationForest:
    """Trees of random splits, each over its own rows, as flat arrays."""

    def __init__(self, rows: np.ndarray, trees: int, rows_per_tree: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = max(2, min(rows_per_tree, len(rows)))
        self.depth = math.ceil(math.log2(self.size))
        nodes = 2 ** (self.depth + 1)
        self.spread = np.maximum(rows.max(axis=0) - rows.min(axis=0), _LEAST_SPREAD)
        self.feature = np.full((trees, nodes), -1, np.int8)
        self.split = np.zeros((trees, nodes))
        self.path = np.zeros((trees, nodes))
        for t in range(trees):
            self._grow(t, 1, rows[rng.permutation(len(rows))[:self.size]], 0, rng)

    def _grow(self, t: int, node: int, rows: np.ndarray, depth: int, rng) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        if depth == self.depth or not (high > low).any():
            self.path[t, node] = depth + _expected_path(len(rows))
            return
        f = rng.integers(rows.shape[1])
        # The cut is drawn a little beyond the rows too, so a value outside all
        # that was seen can part from them; also where they have one value only.
        margin = 0.1 * (high[f] - low[f]) or self.spread[f]
        cut = rng.uniform(low[f] - margin, high[f] + margin)
        self.feature[t, node], self.split[t, node] = f, cut
        for child, part in ((2 * node, rows[rows[:, f] < cut]), (2 * node + 1, rows[rows[:, f] >= cut])):
            if len(part):
                self._grow(t, child, part, depth + 1, rng)
            else:
                self.path[t, child] = depth + 1

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path), in 0 to 1; high is anomalous."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                goes = 2 * node + (rows[every, np.maximum(f, 0)] >= split[node])
                node = np.where(f < 0, node, goes)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / float(_expected_path(self.size)))


def _threshold(bins: list[tuple[int, int, int]], good_loss: float) -> int:
    """The lowest bin to reject, of sorted (bin, good rows, bad rows) with a good row at least.

    At most ``good_loss`` of the good rows are lost, and of these cuts the one
    that rejects most bad rows, then loses fewest good ones, then is lowest.
    Without bad rows it is the lowest one.
    """
    allowed, any_bad = good_loss * sum(g for _, g, _ in bins), any(b for _, _, b in bins)
    lost = rejected = 0
    cuts = []
    for i in range(len(bins), -1, -1):  # reject bins[i:]
        if i < len(bins):
            lost, rejected = lost + bins[i][1], rejected + bins[i][2]
        if lost > allowed:
            break
        cut = bins[i - 1][0] + 1 if i else bins[0][0]
        cuts.append((rejected, -lost, -cut) if any_bad else (-cut,))
    return -max(cuts)[-1]


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = 100,
          rows_per_tree: int = 256, good_loss: float = 0.002, seed: int = 17) -> DataFrame:
    """(id, rid, counts..., base_failed, anomaly, kept) per row of ``docs``.

    ``labels`` has (id, quality 0/1); ids with several labels count as good
    only if all say so, null ids and labels are left out. Without good labels
    there is no forest: anomaly is null and the base rules alone decide. Null
    and empty texts have no words and fail; repeated rows are each judged; an
    empty table gives no row; columns other than the two named are not read.
    """
    stats = materialize(rule_statistics(docs, id_col, text_col), "rule-statistics")
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
             .dropna().groupBy("id").agg(F.min("quality").alias("quality")))
    marked = stats.filter(~F.col("base_failed")).join(known, "id")
    sample = (marked.filter("quality = 1").orderBy(F.xxhash64("id", F.lit(seed)), "id", "rid")
              .limit(trees * rows_per_tree).select(*_COUNTS).toPandas())
    if sample.empty:
        return (stats.withColumn("anomaly", F.lit(None).cast("double"))
                .withColumn("kept", ~F.col("base_failed")))
    forest = IsolationForest(features({c: sample[c].to_numpy(float) for c in _COUNTS}), trees, rows_per_tree, seed)

    def score(batches):
        for batch in batches:
            x = features({c: batch[c].to_numpy().astype(float) for c in _COUNTS})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(x))],
                                             names=[*batch.schema.names, "anomaly"])

    schema = "id long, rid long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, anomaly double"
    scored = materialize(stats.mapInArrow(score, schema), "anomaly-scores")
    bins = (scored.filter(~F.col("base_failed")).join(known, "id")
            .groupBy(F.floor(F.col("anomaly") * _BINS).cast("int").alias("bin"))
            .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
            .orderBy("bin").collect())  # at most _BINS + 1 rows
    threshold = _threshold([(r["bin"], r["good"], r["bad"]) for r in bins], good_loss)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("anomaly") * _BINS) < threshold))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **settings) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    bad = (judge(docs, labels, id_col, text_col, **settings).filter(~F.col("kept"))
           .select(F.col("id").alias("__id"), F.col("rid").alias("__rid")).distinct())
    return docs.join(checked_broadcast(bad), F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
                     & (common.row_hash(text_col) == F.col("__rid")), "left_anti")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the forest's verdict for every document."""
    judged = judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "anomaly")
