"""Delimited files with line breaks in quoted fields, read by many tasks.

A line of such a file may be the middle of a record, and whether it is depends on
all quotes before it. So a first pass over the blocks of the files notes,
for each block, where it would end (inside a quoted field or not) if it began
outside one, and if it began inside one. Block after block these compose to the
state in which every block really begins: one row per block and a window. The
second pass then cuts each block into records. Only the pieces at block edges
(the end of a record that began before, the begin of one that goes on) are
shuffled, to be put together; whole records stay in their task. Both passes must
see the same blocks; where executors that came or went changed the splits
between them, which marks in the second pass tell, they are done again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import spec
from ..session import discard, materialize

#: Where a row stands: its file, the begin of its block there, and its place in the block.
FILE, BLOCK, AT = "__file", "__block", "__at"
_TRIES = 3
_WHOLE, _TAIL, _HEAD, _MARK = 0, 1, 2, 3


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted field is open after the line. A quote opens a field at its begin only; a doubled
    one stands for itself."""
    if '"' not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if not inside:
            if at >= n or line[at] != '"':
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
            inside, at = True, at + 1
        close = line.find('"', at)
        if close < 0:
            return True
        if line[close + 1:close + 2] == '"':
            at = close + 2
            continue
        inside, at = False, line.find(sep, close + 1)
        if at < 0:
            return False
        at += len(sep)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator]]:
    """The rows of a task block by block: ((file, block), rows of the batch that belong to it)."""
    for batch in batches:
        files, blocks = batch["file"].to_pylist(), batch["block"].to_pylist()
        begin = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or blocks[i] != blocks[begin] or files[i] != files[begin]:
                yield (files[begin], blocks[begin]), batch.slice(begin, i - begin)
                begin = i


def _states(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, states, rows = None, (False, True), []
        for own, some in _blocks(batches):
            if own != key:
                if key:
                    rows.append((*key, *states))
                key, states = own, (False, True)
            for line in some["line"].to_pylist():
                if '"' in line:
                    first = ends_inside(line, states[0], sep)
                    states = first, first if states[0] == states[1] else ends_inside(line, states[1], sep)
        if key:
            rows.append((*key, *states))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=["file", "block", "out", "in"])
    return run


def _cut(sep: str):
    names = ["file", "block", "at", "kind", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, kind, at = None, False, [], _WHOLE, 0

        def left() -> list[tuple]:
            """What the block's end leaves open."""
            return [(*key, at, _HEAD if kind == _WHOLE else _TAIL, "\n".join(held))] if held else []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        for own, some in _blocks(batches):
            rows = []
            if own != key:
                if key:
                    rows += left()
                key, inside, held, at = own, bool(some["inside"][0].as_py()), [], 0
                kind = _TAIL if inside else _WHOLE
                rows.append((*key, -1, _MARK, ""))
            for line in some["line"].to_pylist():
                inside = ends_inside(line, inside, sep)
                held.append(line[:-1] if line.endswith("\r") else line)
                if not inside:
                    if len(held) > 1 or held[0] or kind == _TAIL:
                        rows.append((*key, at, kind, "\n".join(held)))
                        at += 1
                    held, kind = [], _WHOLE
            yield batch_of(rows)
        if key:
            yield batch_of(left())
    return run


def quoted_records(spark: SparkSession, files: str | Sequence[str], sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """(file, block, at, text): the records of the files, line breaks within quotes kept (as ``\\n``), empty
    lines left out. ``at`` counts the records that begin in a block."""
    raw = spark.read.option("lineSep", "\n").text(files if isinstance(files, str) else list(files))
    line = F.decode(F.col("value").cast("binary"), encoding) if encoding != "UTF-8" else F.col("value")
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))
    for _ in range(_TRIES):
        states = materialize(lines.mapInArrow(_states(sep), "file string, block long, out boolean, in boolean"), "block-states")
        pieces = _pieces(lines, states, sep)
        cut = pieces.where(F.col("kind") == _MARK).select("file", "block")
        seen = states.select("file", "block")
        if cut.exceptAll(seen).isEmpty() and seen.exceptAll(cut).isEmpty():
            return _mended(pieces)
        discard(states, pieces)
    raise RuntimeError("the files were split in another way in each pass: set spark.sql.files.minPartitionNum")


def _pieces(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """The records and pieces of records of each block, and a mark for the block."""
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row per block
    turns = F.col("out") & ~F.col("in")  # the block's end is the other state than its begin
    known = F.when(F.col("out") == F.col("in"), F.struct(F.col("out").alias("state"), F.col("turned")))
    begun = (states.withColumn("turned", F.coalesce(F.sum(turns.cast("long")).over(before), F.lit(0)))
             .withColumn("last", F.last(known, ignorenulls=True).over(before))
             .withColumn("since", F.col("turned") - F.coalesce(F.col("last.turned"), F.lit(0)))
             .withColumn("inside", (F.coalesce(F.col("last.state"), F.lit(False)).cast("int") + F.col("since")) % 2 == 1))
    open_at = materialize(begun.where("inside").select("file", "block", "inside"), "open-blocks")
    if open_at.count() <= spec.BROADCAST_ROWS:
        told = lines.join(F.broadcast(open_at), ["file", "block"], "left")
    else:  # a join by sorting: lines are put in their order again
        told = (lines.withColumn("place", F.monotonically_increasing_id()).join(open_at, ["file", "block"], "left")
                .sortWithinPartitions("file", "block", "place"))
    told = told.select("file", "block", "line", F.coalesce("inside", F.lit(False)).alias("inside"))
    return materialize(told.mapInArrow(_cut(sep), "file string, block long, at long, kind int, text string"), "records")


def _mended(pieces: DataFrame) -> DataFrame:
    edges = pieces.where(F.col("kind").isin(_TAIL, _HEAD))
    upto = W.partitionBy("file").orderBy("block", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)  # two rows per block
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))), lambda p: p["text"])
    mended = (edges.withColumn("record", F.sum((F.col("kind") == _HEAD).cast("long")).over(upto)).groupBy("file", "record")
              .agg(F.min_by(F.struct("block", "at"), F.struct("block", "kind")).alias("first"), F.array_join(texts, "\n").alias("text"))
              .select("file", "first.block", "first.at", "text"))
    return pieces.where(F.col("kind") == _WHOLE).select("file", "block", "at", "text").unionByName(mended)
