"""Helpers the operators share: projections that cannot clash, and whole-file access on the shared store."""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that end a word, as in ``[^\x20\x09-\x0D]+``; bytes.split() and bytes.strip() use the same six.
SPACE = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: str) -> Column:
    """The column's UTF-8 bytes, empty for null."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def row_hash(text: str = "text") -> Column:
    """Tells apart the texts of rows that share an id; equal rows get equal values."""
    return F.xxhash64(F.col(text))


def slices(batches, rows: int = 256):
    """Smaller record batches: what a task makes of texts at once stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        give_back()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From here on the session's Arrow batches have at most so many rows: they hold whole texts, and a
    batch is in an executor's memory twice, in its JVM outside the heap and in the Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def by_bytes(batch, size: int):
    """Parts of a batch, of about so many bytes of text each; a longer text is a part of its own."""
    import numpy as np
    import pyarrow.compute as pc

    part = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            yield batch.slice(i, j - i)


def give_back() -> None:
    """Returns the memory of freed buffers to the system: a Python worker lives on after its task, and
    what it keeps would add to what the next stage needs."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim:
        trim(0)


@lru_cache(maxsize=1)
def _libc():
    import ctypes

    return ctypes.CDLL(None)


def open_store(uri: str):
    """The pyarrow file system and path of a file on the shared store."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """An output stream for a new file, its folder made first."""
    store, path = open_store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path, compression=None)


def task_file(folder: str, suffix: str) -> str:
    """A file name that no other attempt of this task writes; readers go by
    the manifest rows of the attempts that succeeded."""
    from pyspark import TaskContext

    t = TaskContext.get()
    return f"{folder}/part-{t.partitionId():06d}-{t.taskAttemptId()}{suffix}"
