"""Filters, dedupe, unions and joins with the source project's semantics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..functions.columns import rename_clashes
from ..session import materialize


def drop_empty(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where every column (of ``subset``) is NULL."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; NULLs compare equal. Map-side partial dedupe keeps a
    hot duplicate group from reaching one task whole."""
    return df.dropDuplicates()


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple.

    Spark has no file row order, so the order is a required argument; give a
    unique tail (an id) for a total order. Written as ``min(struct(...))`` per
    key rather than a ``row_number`` window: the aggregate combines map-side,
    so a key holding a third of all rows never lands in one task whole.
    NULL order values sort first. Rows with a NULL key form one group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not order_by:
        raise ValueError("order_by is required: Spark rows have no inherent order")
    payload = [c for c in df.columns if c not in keys]
    order_fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
    packed = F.struct(*order_fields, *[F.col(c) for c in payload])
    best = df.groupBy(*keys).agg(F.min(packed).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload]).select(*df.columns)


def union_sources(frames: Mapping[str, DataFrame], origin_col: str | None = None) -> DataFrame:
    """Bag union by column name, missing columns NULL, each row tagged with
    its source name in ``origin_col``."""
    if not frames:
        raise ValueError("no sources to union")
    out = None
    for name, df in frames.items():
        tagged = df.withColumn(origin_col, F.lit(name)) if origin_col else df
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Routed:
    """Several sources that are parts of one table: per source a condition on its rows and its columns by
    name. As many sources as there are, the table is scanned once."""

    frame: DataFrame
    routes: Mapping[str, tuple[Column, Mapping[str, Column]]]

    def rename(self, sources: Callable[[str], str] | None = None,
               columns: Callable[[dict[str, Column]], dict[str, Column]] | None = None) -> Routed:
        """With other source names, or other columns of each."""
        return Routed(self.frame, {sources(n) if sources else n: (where, columns(dict(cols)) if columns else cols)
                                   for n, (where, cols) in self.routes.items()})

    def frames(self) -> dict[str, DataFrame]:
        """The sources as frames of their own, each with a scan."""
        return {n: self.frame.where(where).select(*[v.alias(c) for c, v in cols.items()]) for n, (where, cols) in self.routes.items()}

    def union(self, origin_col: str) -> DataFrame:
        """As :func:`union_sources` of the sources without their all-NULL rows: a row is in every
        source whose condition it meets."""
        types: dict[str, T.DataType] = {}
        for _, cols in self.routes.values():
            for f in self.frame.select(*[v.alias(c) for c, v in cols.items()]).schema.fields:
                types.setdefault(f.name, f.dataType)

        def row(name: str, cols: Mapping[str, Column]) -> Column:
            return F.struct(*[cols.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()], F.lit(name).alias(origin_col))

        rows = [F.when(where & reduce(Column.__or__, [v.isNotNull() for v in cols.values()]), row(n, cols))
                for n, (where, cols) in self.routes.items()]
        return self.frame.select(F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
              null_safe: bool = False, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left join on key column(s); clashing non-key columns get suffixes.

    By default NULL keys never match (SQL). ``null_safe=True`` matches NULL
    with NULL, as a pandas merge does.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left, right = rename_clashes(left, right, keys, suffixes)
    if not null_safe:
        return left.join(right, keys, "left")
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def stored_bytes(written: DataFrame) -> int:
    """Size of the files that a just written table reads."""
    return int(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def checked_broadcast(small: DataFrame, limit: int = spec.BROADCAST_ROWS,
                      max_bytes: int = spec.BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a side whose rows and bytes were just checked.

    For per-cohort tables (one row per cluster): joining them on the cohort
    key by shuffle would put each cohort's rows in one task, so they are
    broadcast when within the bounds; beyond them the plain join stands and
    AQE handles skew. The side is written as a table, so that it is computed
    once and nothing stays cached.
    """
    small = materialize(small, "side")
    return F.broadcast(small) if stored_bytes(small) <= max_bytes and small.count() <= limit else small
