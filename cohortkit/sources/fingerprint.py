"""What a stored table was made from, so that it is used again only while that holds.

The fingerprint covers the input files (path, size, modification time), the
schema of input DataFrames and parameters. The files are listed and hashed by a
Spark job over their metadata; contents are not read, and no list of files
comes to the driver for inputs given as paths.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Spark's readers pass over names that begin so.
_NAME = "_fingerprint"


def _files(spark: SparkSession, paths: str | list[str]) -> list:
    """[files, bytes, hash] of all files at the paths: sums, whatever their order."""
    if not paths:
        return [0, 0, "0"]
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
                 .select("path", "length", "modificationTime"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return ["absent", str(paths)]
    row = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)),
                    F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0))).first()
    return [row[0], int(row[1]), str(row[2])]


def input_fingerprint(spark: SparkSession, inputs: Iterable[str | DataFrame], params: Mapping | None = None) -> str:
    """Of paths (files or folders) and DataFrames (their files and schema), in their order, and parameters
    that JSON can hold. A path where nothing is counts as absent."""
    seen = []
    for x in inputs:
        if isinstance(x, DataFrame):
            seen.append([_files(spark, sorted(unquote(f) for f in x.inputFiles())), x.schema.json()])
        else:
            seen.append([str(x), _files(spark, str(x))])
    return hashlib.sha256(json.dumps([seen, dict(params or {})], sort_keys=True).encode()).hexdigest()


def stored_fingerprint(spark: SparkSession, table: str) -> str | None:
    return store.read_text(spark, f"{table.rstrip('/')}/{_NAME}")


def store_fingerprint(spark: SparkSession, table: str, fingerprint: str) -> None:
    """To be called when the table is whole: a write that fails before leaves none, as writing the
    table removes the old one."""
    store.write_text(spark, f"{table.rstrip('/')}/{_NAME}", fingerprint)
