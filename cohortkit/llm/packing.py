"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents in id order. In each window a queue may
send its target share of the window's tokens; what a share leaves over as a
fraction of a token stays with the queue as its deficit and counts in the next
window. Documents are cut where a queue's turn ends, so windows hold the target
proportions to the token. Queues that run dry leave their share to the others.

The deficits after any number of windows follow from the queue totals alone:
``taken(k)`` is in closed form, and so a task can place its documents without
the windows before it. Texts are tokenized once, in range partitions by id; the
totals of each (partition, source) give every document its place in its queue.
Sources that have no token for every window share one queue, in which each
source's documents stand where their part of the source does, so that every
stretch of it holds all of them alike.
The windows form one stream that is cut every ``length`` tokens; what remains
at the end is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize
from . import common, tokens

#: A task keeps the queues' numbers after some windows: about so many numbers.
_KEPT = 500_000


class Schedule:
    """What each queue has sent after k windows, in whole numbers throughout."""

    def __init__(self, sizes: Sequence[int], weights: Sequence[int], window: int):
        self.sizes, self.window = list(sizes), window
        self.phases: list[tuple[int, list[int], list[int], int]] = []  # begin, sent by then, active weights, their sum
        clock, sent = 0, [0] * len(sizes)
        while any(s < t for s, t in zip(sent, sizes)):
            active = [w if s < t else 0 for w, s, t in zip(weights, sent, sizes)]
            if not any(active):  # only queues of weight 0 are left: by size
                active = [t - s for s, t in zip(sent, sizes)]
            total = sum(active)
            self.phases.append((clock, sent, active, total))
            step = min(-(-(t - s) * total // a) for s, t, a in zip(sent, sizes, active) if a)
            sent = [min(t, s + step * a // total) for s, t, a in zip(sent, sizes, active)]
            clock += step
        self.windows = -(-clock // window)
        self._begins = [p[0] for p in self.phases]
        self._kept: dict[int, tuple[list[int], list[int]]] = {}

    def taken(self, k: int) -> tuple[list[int], list[int]]:
        """Tokens of each queue in the first k windows, and the sums of these up to each queue."""
        if k not in self._kept:
            if len(self._kept) * len(self.sizes) >= _KEPT:
                self._kept.clear()
            out = self.sizes
            if k < self.windows:
                begin, sent, active, total = self._phase(k * self.window)
                gone = k * self.window - begin
                out = [min(n, s + gone * a // total) for n, s, a in zip(self.sizes, sent, active)]
            self._kept[k] = out, [0, *accumulate(out)]
        return self._kept[k]

    def _phase(self, clock: int) -> tuple[int, list[int], list[int], int]:
        return self.phases[max(0, bisect_left(self._begins, clock + 1) - 1)]

    def of(self, q: int, k: int) -> int:
        if k >= self.windows:
            return self.sizes[q]
        clock = k * self.window
        begin, sent, active, total = self._phase(clock)
        return min(self.sizes[q], sent[q] + (clock - begin) * active[q] // total)

    def places(self, q: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(start, length, place in the stream) of the parts of the queue's tokens start to start + n - 1."""
        k = bisect_left(range(1, self.windows + 1), True, key=lambda k: self.of(q, k) > start) + 1
        end = start + n
        while start < end:
            (before, sums), (after, sums_after) = self.taken(k - 1), self.taken(k)
            size = min(end, after[q]) - start
            if size > 0:
                yield start, size, sums[-1] + (sums_after[q] - sums[q]) + start - before[q]
                start += size
            k += 1


def cut(place: int, n: int, total: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(sequence, offset, tokens) of the stream's tokens place to place + n - 1."""
    full = total // length * length
    while n > 0:
        if place < full:
            seq, offset = divmod(place, length)
            room = length - offset
        else:
            rest, seq, begin = total - full, full // length, full
            size = 1 << (rest.bit_length() - 1)
            while place >= begin + size:  # at most log2(length) sequences
                begin, rest, seq = begin + size, rest - size, seq + 1
                size = 1 << (rest.bit_length() - 1)
            offset, room = place - begin, begin + size - place
        size = min(n, room)
        yield seq, offset, size
        place, n = place + size, n - size


def _tokenize(tokenizer: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, seen = tokens.encoder(tokenizer), TaskContext.get().partitionId(), {}
        tail = np.array([] if end_id is None else [end_id], enc.dtype)
        for batch in batches:
            for some in common.by_bytes(batch, tokens.TOGETHER):
                ids = [np.concatenate([x, tail]) for x in enc.encode(some["text"].to_pylist())]
                sources, starts = some["source"].to_pylist(), []
                for source, x in zip(sources, ids):
                    starts.append(seen.get(source, 0))
                    seen[source] = starts[-1] + len(x)
                yield pa.RecordBatch.from_arrays(
                    [some["id"], some["source"], pa.array(np.full(len(ids), part, np.int32)),
                     pa.array(starts, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["id", "source", "part", "local", "n", "ids"])
    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the tokens before each row in it."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch["n"].to_numpy()
        ends = seen + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["n"], batch["ids"], pa.array(np.full(len(n), part, np.int32)),
                                          pa.array(ends - n)], names=["id", "n", "ids", "part", "local"])
        seen = int(ends[-1]) if len(n) else seen


def _pooled(rows: DataFrame, queue: int) -> DataFrame:
    """(id, queue, start, n, ids) of the rows (id, n, ids, source, at, source_n) in one queue: each document
    at a point, given by its hash, of its own part of its source. Only sums of partitions are gathered."""
    point = F.pmod(F.xxhash64("source", "id", "at"), F.lit(1 << 20)) / float(1 << 20)
    key = (F.col("at") + point * F.col("n")) / F.greatest("source_n", F.lit(1))
    dealt = (rows.withColumn("key", key).select("key", "id", "n", "ids").repartitionByRange("key", "id")
             .sortWithinPartitions("key", "id").select("id", "n", "ids"))
    ranked = materialize(dealt.mapInArrow(_running, "id long, n long, ids binary, part int, local long"), "pooled-tokens")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (ranked.groupBy("part").agg(F.sum("n").alias("n"))  # a row per partition
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (ranked.join(checked_broadcast(starts), "part")
            .select("id", F.lit(queue).alias("queue"), (F.col("base") + F.col("local")).alias("start"), "n", "ids"))


def _place(schedule: Schedule, total: int, length: int, dtype: str, id_name: str, with_ids: bool):
    names = [id_name, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            out: list[list] = [[] for _ in names]
            data = []
            for doc, q, start, n, raw in zip(*(batch[c].to_pylist() for c in ("id", "queue", "start", "n", "ids"))):
                ids = np.frombuffer(raw, dtype).astype("<u4")
                for at, size, place in schedule.places(q, start, n):
                    at -= start
                    for seq, offset, m in cut(place, size, total, length):
                        row = (doc, at, m, tokens.crc32(ids[at:at + m]), n, seq, offset)
                        for column, value in zip(out, row):
                            column.append(value)
                        if with_ids:
                            data.append(ids[at:at + m].tobytes())
                        at += m
            arrays = [pa.array(c, pa.int64()) for c in out]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(data, pa.binary())] * with_ids,
                                             names=names + ["ids"] * with_ids)
    return run


def pack(docs: DataFrame, length: int = 1024, window: int = 64 * 1024, mixture: Mapping[str, float] | None = None,
         tokenizer: str | None = None, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start and length in its document, checksum of its
    ids, the document's tokens, sequence and offset; with its ids on request.

    ``mixture`` gives sources their target proportions (numbers in any unit;
    sources not named get 0 and follow when the others run dry); without it
    the targets are the sources' own parts of the corpus, and all queues end
    together. Nothing is dropped or repeated. Null texts are empty documents
    (the end id alone; none without one), a null source is the source '', null
    ids come first in their queues and stay null, repeated rows are packed each, an empty
    table gives no row, other columns are not read.
    """
    tokenizer = tokenizer or tokens.default_tokenizer()
    text, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, source_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), source.alias("source"), text.alias("text"))
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", common.row_hash(), "source")
    encoded = materialize(dealt.mapInArrow(_tokenize(tokenizer, end_id),
                                           "id long, source string, part int, local long, n long, ids binary"), "tokens")
    totals = materialize(encoded.groupBy("part", "source").agg(F.sum("n").alias("n")), "token-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    by_source = materialize(totals.groupBy("source").agg(F.sum("n").alias("n")), "source-totals")
    named = list(mixture or {})
    large = (by_source.filter((F.col("n") * window >= total) | F.col("source").isin(named))
             .orderBy("source").collect())  # at most a row per token of a window and those named
    sizes = [r["n"] for r in large]
    pooled = total - sum(sizes)
    scale = 2 ** 20 / max([*mixture.values(), 1e-300]) if mixture else 0
    weights = ([round(mixture.get(r["source"], 0) * scale) for r in large] + [0] if mixture else [*sizes, pooled])
    schedule = Schedule([*sizes, pooled], weights, window)
    numbers = docs.sparkSession.createDataFrame([(r["source"], i) for i, r in enumerate(large)], "source string, queue int")
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (totals.select("part", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
              .join(checked_broadcast(numbers), "source", "left"))
    own = starts.filter(F.col("queue").isNotNull())
    placed = (encoded.join(checked_broadcast(own), ["part", "source"])
              .select("id", "queue", (F.col("base") + F.col("local")).alias("start"), "n", "ids"))
    if pooled:
        shared = starts.filter(F.col("queue").isNull()).drop("queue").join(by_source.withColumnRenamed("n", "source_n"), "source")
        rows = (encoded.join(checked_broadcast(shared), ["part", "source"])
                .select("id", "source", (F.col("base") + F.col("local")).alias("at"), "n", "source_n", "ids"))
        placed = placed.unionByName(_pooled(rows, len(large)))
    dtype = tokens.encoder(tokenizer).dtype.str
    schema = (f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    return placed.mapInArrow(_place(schedule, total, length, dtype, id_col, with_ids), schema)


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, every window with the corpus's own proportions of sources."""
    return pack(common.table(spark, sf_dir, "documents"))
