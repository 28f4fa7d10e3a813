"""Sinks: typed tables under one output root (local path, HDFS or s3a://)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The column that says why a table was set aside.
QUARANTINE_REASON = "quarantine_reason"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a table; CSV gets a header. Returns the path."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def quarantine(df: DataFrame, root: str, name: str, fmt: str = "parquet", reason: str | None = None) -> str:
    """Set aside a table that failed its key contract, for inspection; with a ``reason``, each row
    carries it in ``QUARANTINE_REASON``. A column that has this name already gets ``_x`` behind it."""
    if reason is not None:
        taken = {c.lower() for c in df.columns}
        if QUARANTINE_REASON in taken:
            old, new = next(c for c in df.columns if c.lower() == QUARANTINE_REASON), QUARANTINE_REASON + "_x"
            while new in taken:
                new += "_x"
            df = df.withColumnRenamed(old, new)
        df = df.withColumn(QUARANTINE_REASON, F.lit(reason))
    return write_table(df, f"{root.rstrip('/')}/quarantine/{name}", fmt)
