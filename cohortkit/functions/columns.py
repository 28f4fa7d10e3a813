"""Name-level operators: resolved on the driver from ``df.columns`` (metadata,
no job), except ``numeric_columns`` which runs one aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec
from .numbers import to_double
from .text import fold_name


def unify_key(df: DataFrame, key: str = spec.KEY,
              aliases: Sequence[str] = spec.KEY_ALIASES) -> DataFrame:
    """Copy the first alias present (in preference order) to ``key``.

    No-op when ``key`` already exists or no alias is present. The alias
    column itself is kept, as the source project does.
    """
    source = key_source(df.columns, key, aliases)
    return df if source is None else df.withColumn(key, F.col(source))


def key_source(columns: Sequence[str], key: str = spec.KEY, aliases: Sequence[str] = spec.KEY_ALIASES) -> str | None:
    """The alias that ``key`` is to be copied from; None if there is none, or the key is there."""
    present = [a for a in aliases if a in columns]
    return present[0] if present and key not in columns else None


def resolve_score(df: DataFrame, aliases: Iterable[str] = spec.SCORE_ALIASES,
                  target: str = spec.SCORE) -> DataFrame:
    """Rename the first column (in table order) whose lower-case name is an
    alias to ``target``. Two candidates that would collide raise."""
    first = score_source(df.columns, aliases, target)
    return df if first is None else df.withColumnRenamed(first, target)


def score_source(columns: Sequence[str], aliases: Iterable[str] = spec.SCORE_ALIASES, target: str = spec.SCORE) -> str | None:
    """The column that is to be named ``target``; None if there is none, or it has the name."""
    wanted = {a.lower() for a in aliases}
    candidates = [c for c in columns if c.lower() in wanted]
    if not candidates or candidates[0] == target:
        return None
    first = candidates[0]
    clash = [c for c in columns if c.lower() == target.lower() and c != first]
    if clash:
        raise ValueError(f"score column {first!r} would collide with existing {clash[0]!r}")
    return first


def find_duration_column(columns: Iterable[str], stem: str = spec.DURATION_STEM,
                         words: Sequence[str] = spec.DURATION_WORDS) -> str | None:
    """First column whose folded name contains ``stem`` or all of ``words``."""
    for c in columns:
        norm = fold_name(c)
        if stem in norm or all(w in norm for w in words):
            return c
    return None


def select_present(df: DataFrame, wanted: Sequence[str], order: str = "table",
                   fallback: Sequence[str] | None = (spec.KEY,)) -> DataFrame:
    """Project the wanted columns that exist.

    ``order='table'`` keeps the table's column order, ``'list'`` the order of
    ``wanted``. With no match, ``fallback`` is selected (it must exist).
    """
    if order == "table":
        cols = [c for c in df.columns if c in wanted]
    elif order == "list":
        cols = [c for c in wanted if c in df.columns]
    else:
        raise ValueError("order must be 'table' or 'list'")
    if not cols:
        if fallback is None:
            raise ValueError(f"none of {list(wanted)} present")
        cols = list(fallback)
    return df.select(*cols)


def require_columns(df: DataFrame, *names: str, what: str = "input") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required column(s) {missing}; has {df.columns}")
    return df


def rename_clashes(left: DataFrame, right: DataFrame, on: Sequence[str],
                   suffixes: tuple[str, str] = ("_x", "_y")) -> tuple[DataFrame, DataFrame]:
    """Suffix non-key columns present on both sides, so a join stays unambiguous."""
    on = set(on)
    clash = [c for c in left.columns if c in right.columns and c not in on]
    for c in clash:
        left = left.withColumnRenamed(c, c + suffixes[0])
        right = right.withColumnRenamed(c, c + suffixes[1])
    return left, right


def numeric_column_counts(df: DataFrame, exclude: Iterable[str] = (), style: str = "br") -> DataFrame:
    """(column_name, n_numeric): how many values of each column parse as a
    number (text through ``parse_number``); one aggregate pass, long form."""
    exclude = set(exclude)
    cands = [c for c in df.columns if c not in exclude]
    if not cands:
        return df.sparkSession.createDataFrame([], "column_name string, n_numeric long")
    counts = df.agg(*[F.count(to_double(df, c, style)).alias(f"_{i}") for i, c in enumerate(cands)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_numeric"))
        for i, c in enumerate(cands)])).alias("r")).select("r.*")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), style: str = "br") -> list[str]:
    """Columns where at least one value parses as a number (one row of counts
    per column comes back)."""
    rows = numeric_column_counts(df, exclude, style).collect()
    return [r["column_name"] for r in rows if r["n_numeric"] > 0]
