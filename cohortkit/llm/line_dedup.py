"""Line dedup across documents.

The long lines of all documents become (hash, document, position) rows. They
are range-partitioned by (hash, document) and sorted within partitions with
the largest document first, so that one pass over a partition meets each
hash's keeper first and knows, at the end of the hash's run, how many
documents hold it. A range boundary can cut a run (a line found in a third of
all documents fills many partitions): the two runs at a partition's ends are
reported as counts, at most two rows per partition, and settled by summing
those. The decisions come back as one compressed keep bitmap per document that
loses lines; texts are not moved to find them.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize
from . import common

_LOWEST = -(2 ** 63)
_LINES = "h1 long, h2 long, id long, rid long, pos int, n_lines int"
_MARKS = "kind int, h1 long, h2 long, id long, rid long, pos int, n_lines int, n_docs long"
_DROP, _OPEN, _RUN = 0, 1, 2


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in common.slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for i, rid, text in zip(batch["id"].to_pylist(), batch["rid"].to_pylist(), batch["text"].to_pylist()):
                lines = text.split(b"\n")
                for pos, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = line.strip(common.SPACE).lower()
                    if len(key) < min_chars or len(key.decode()) < min_chars:
                        continue
                    a, b = struct.unpack("<qq", xxhash.xxh3_128_digest(key))
                    for column, value in zip(out, (a, b, i, rid, pos, len(lines))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int32() if k > 3 else pa.int64()) for k, x in enumerate(out)],
                names=["h1", "h2", "id", "rid", "pos", "n_lines"])
    return run


def _mark(min_docs: int):
    """Stream a sorted partition run by run. A run that touches neither end
    of the partition is decided here; the others leave their rows and counts."""
    names = ["h1", "h2", "id", "rid", "pos", "n_lines"]

    def emit(kind: int, c: dict, n_docs: int = 0) -> pa.RecordBatch:
        n = len(c["h1"])
        arrays = [pa.array(np.full(n, kind, np.int32))] + [pa.array(c[k]) for k in names]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(n, n_docs, np.int64))],
                                          names=["kind", *names, "n_docs"])

    def open_run(c: dict) -> Iterator[pa.RecordBatch]:
        yield emit(_OPEN, c)
        yield emit(_RUN, {k: v[:1] for k, v in c.items()}, len(np.unique(c["id"])))

    def closed(c: dict, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """c: whole runs, beginning at starts."""
        n = len(c["h1"])
        run = np.zeros(n, np.int64)
        run[starts[1:]] = 1
        run = np.cumsum(run)
        new_doc = np.ones(n, bool)
        new_doc[1:] = (c["id"][1:] != c["id"][:-1]) | (run[1:] != run[:-1])
        docs = np.add.reduceat(new_doc.astype(np.int64), starts)
        drop = (docs[run] >= min_docs) & (c["id"] != c["id"][starts][run])
        if drop.any():
            yield emit(_DROP, {k: v[drop] for k, v in c.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # the rows of the run that is not over
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: batch[k].to_numpy(zero_copy_only=False) for k in names}
            same = (c["h1"][1:] == c["h1"][:-1]) & (c["h2"][1:] == c["h2"][:-1])
            starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
            goes_on = bool(held) and held[-1]["h1"][-1] == c["h1"][0] and held[-1]["h2"][-1] == c["h2"][0]
            if len(starts) == 1 and (goes_on or not held):
                held.append(c)
                continue
            cut = starts[1] if goes_on else 0
            if held:
                if cut:
                    held.append({k: v[:cut] for k, v in c.items()})
                whole = {k: np.concatenate([x[k] for x in held]) for k in names}
                yield from open_run(whole) if first else closed(whole, np.array([0]))
                first = False
            last = starts[-1]
            inner = {k: v[cut:last] for k, v in c.items()}
            at = starts[(starts >= cut) & (starts < last)] - cut
            if len(at) and first:
                end = at[1] if len(at) > 1 else last - cut
                yield from open_run({k: v[:end] for k, v in inner.items()})
                inner, at, first = {k: v[end:] for k, v in inner.items()}, at[1:] - end, False
            if len(at):
                yield from closed(inner, at)
            held = [{k: v[last:] for k, v in c.items()}]
        if held:
            yield from open_run({k: np.concatenate([x[k] for x in held]) for k in names})
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bitmaps = []
        for n, gone in zip(batch["n_lines"].to_pylist(), batch["gone"].to_pylist()):
            keep = np.ones(n, np.uint8)
            keep[gone] = 0
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["rid"], batch["n_lines"], batch["n_dropped"], pa.array(bitmaps, pa.binary())],
            names=["id", "rid", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                 min_docs: int = 5) -> DataFrame:
    """One row (id, rid, n_lines, n_dropped, keep) for every text that loses lines.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. Keys of at least ``min_chars`` code points found under at
    least ``min_docs`` ids lose all lines except those of the largest id.
    ``rid`` is the text's hash, so that rows which share an id have bitmaps of
    their own; ``keep`` is a deflated bit per line, 1 for kept. Null texts
    have no line that counts, a null id is one id below all others, repeated
    rows share one bitmap, an empty table gives no row, and other columns are
    not read.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
                       common.row_hash(text_col).alias("rid"), common.utf8(text_col).alias("text"))
    lines = materialize(rows.mapInArrow(_hash_lines(min_chars), _LINES), "lines")
    dealt = (lines.repartitionByRange("h1", "h2", "id")
             .sortWithinPartitions("h1", "h2", F.col("id").desc(), "rid", "pos"))
    marks = materialize(dealt.mapInArrow(_mark(min_docs), _MARKS), "line-marks")
    open_runs = (marks.filter(F.col("kind") == _RUN).groupBy("h1", "h2")
                 .agg(F.sum("n_docs").alias("n_docs"), F.max("id").alias("keeper"))
                 .filter(F.col("n_docs") >= min_docs).drop("n_docs"))
    settled = (marks.filter(F.col("kind") == _OPEN).join(checked_broadcast(open_runs), ["h1", "h2"])
               .filter(F.col("id") != F.col("keeper")))
    cols = ["id", "rid", "pos", "n_lines"]
    gone = marks.filter(F.col("kind") == _DROP).select(*cols).unionByName(settled.select(*cols))
    per_text = gone.groupBy("id", "rid").agg(F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone"))
    return (per_text.withColumn("n_dropped", F.size("gone"))
            .mapInArrow(_pack, "id long, rid long, n_lines int, n_dropped int, keep binary"))


def kept_lines(text: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the kept lines joined."""
    lines = text.split(b"\n")
    if keep is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    kept = [x for x, k in zip(lines, bits) if k]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    b = bitmaps.select(F.col("id").alias("__id"), F.col("rid").alias("__rid"), F.col("keep").alias("__keep"))
    return (docs.withColumn("__own", F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)))
            .withColumn("__text_hash", common.row_hash(text_col))
            .join(checked_broadcast(b), (F.col("__own") == F.col("__id")) & (F.col("__text_hash") == F.col("__rid")), "left")
            .drop("__own", "__text_hash", "__id", "__rid"))


def line_digests(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256) per row of ``docs``."""
    def run(batches):
        for batch in common.slices(batches):
            out = [kept_lines(t, k) for t, k in zip(batch["text"].to_pylist(), batch["keep"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch[id_col], pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string())],
                names=[id_col, "n_lines", "n_dropped", "kept_sha256"])

    rows = _with_bitmaps(docs.select(id_col, text_col), bitmaps, id_col, text_col)
    rows = rows.select(id_col, common.utf8(text_col).alias("text"), F.col("__keep").alias("keep"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with the dropped lines gone from its texts; all other columns stay."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, **limits)

    @F.pandas_udf("string")
    def cut(text, keep):
        import pandas as pd
        return pd.Series([t if k is None else kept_lines(t.encode(), k)[2].decode() for t, k in zip(text, keep)],
                         dtype=object)

    rows = _with_bitmaps(docs, bitmaps, id_col, text_col)
    # Texts that keep all lines do not go through Python.
    changed = F.when(F.col("__keep").isNotNull(), F.col(text_col))
    return rows.withColumn(text_col, F.when(F.col("__keep").isNull(), F.col(text_col))
                           .otherwise(cut(changed, "__keep"))).select(*docs.columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more, found in 5 documents or more, stay only in the largest doc_id."""
    docs = common.table(spark, sf_dir, "documents")
    return line_digests(docs, keep_bitmaps(docs))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, pos, line, repeated.line_key IS NOT NULL AND doc_id <> keeper AS gone
  FROM keyed LEFT JOIN repeated USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
