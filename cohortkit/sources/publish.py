"""Sets of tables that change in one step.

A version's tables are written to a folder of their own; then a manifest with the
next number is put beside the older ones by one rename, and that is the
step by which readers change over. A writer that is lost before it leaves the
last version as it was; :func:`clear_unpublished` removes its folder. Readers
hold on to the files of their version until ``keep`` newer ones are there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from . import store
from .sinks import write_table

_VERSIONS, _MANIFESTS = "versions", "manifests"


def _published(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    """(number, manifest) of the published versions, the newest last."""
    folder = f"{root.rstrip('/')}/{_MANIFESTS}"
    found = [n for n in store.names(spark, folder) if n.endswith(".json") and n[:-5].isdigit()]
    return [(int(n[:-5]), json.loads(store.read_text(spark, f"{folder}/{n}"))) for n in sorted(found)]


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet", keep: int = 2) -> int:
    """Writes all tables, then makes them the current version; returns its number.

    Nothing changes for readers where a table cannot be written. Of two writers
    at a time both succeed, one version after the other. ``keep`` versions stay.
    """
    root = root.rstrip("/")
    version = f"{root}/{_VERSIONS}/{uuid.uuid4().hex}"
    for name, df in tables.items():
        write_table(df, f"{version}/{name}", fmt)
    manifest = json.dumps({"version": version, "format": fmt, "tables": sorted(tables)})
    while True:
        number = max([n for n, _ in _published(spark, root)], default=0) + 1
        draft = f"{root}/{_MANIFESTS}/_{uuid.uuid4().hex}"
        store.write_text(spark, draft, manifest)
        if store.move(spark, draft, f"{root}/{_MANIFESTS}/{number:012d}.json"):
            break
        store.delete(spark, draft)
    for n, old in _published(spark, root)[:-keep]:
        store.delete(spark, f"{root}/{_MANIFESTS}/{n:012d}.json")
        store.delete(spark, old["version"])
    return number


def clear_unpublished(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders of versions that were begun and never published (their writers must be
    gone); returns their names."""
    root = root.rstrip("/")
    live = {m["version"].rpartition("/")[2] for _, m in _published(spark, root)}
    gone = [n for n in store.names(spark, f"{root}/{_VERSIONS}") if n not in live]
    for n in gone:
        store.delete(spark, f"{root}/{_VERSIONS}/{n}")
    return gone


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the current version, or of a numbered one that is still kept."""
    found = [(n, m) for n, m in _published(spark, root) if version in (None, n)]
    if not found or name not in found[-1][1]["tables"]:
        raise ValueError(f"no published table {name!r} under {root}" + (f" in version {version}" if version else ""))
    m = found[-1][1]
    df = spark.read.format(m["format"])
    return (df.option("header", True) if m["format"] == "csv" else df).load(f"{m['version']}/{name}")
