"""Feature preparation: tenure, numeric typing, median fill, one-hot, scaling.

Every statistic is one distributed aggregate whose result is a handful of
numbers per column (medians, means, deviations, sorted levels); they come back
as literals and the per-row work stays a single projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..session import materialize
from ..functions.dates import parse_date, tenure_months
from ..functions.numbers import to_double
from .quantiles import quantile_literals


def impute_median(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict, list[str]]:
    """Fill NULLs of each column with its exact whole-table median.

    An all-NULL column has no median: it is dropped and reported, instead of
    carrying NaN into the model.
    """
    cols = list(cols)
    if not cols:
        return df, {}, []
    med = {c: v[0] for c, v in quantile_literals(df, cols, [0.5]).items()}
    dropped = [c for c in cols if med[c] is None]
    out = df.select(*[F.coalesce(F.col(c), F.lit(med[c])).alias(c) if c in med and med[c] is not None
                      else F.col(c) for c in df.columns if c not in dropped])
    return out, {c: v for c, v in med.items() if v is not None}, dropped


def category_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-NULL text levels per column: the model has a column
    for each, so the model's own width bounds what is gathered."""
    cols = list(cols)
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(j).alias("c"), F.col(c).cast("string").alias("v")) for j, c in enumerate(cols)
    ])).alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in pairs.collect():  # one row per model column
        levels[cols[r["c"]]].append(r["v"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = True,
            levels: dict[str, list[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """0/1 DOUBLE columns ``<col>_<level>`` per sorted level, first level
    dropped; NULL gives all zeros (same as the dropped level). With ``levels``
    those are used, and other values give all zeros, too."""
    names: list[str] = []
    exprs = []
    all_levels = category_levels(df, cols) if levels is None else levels
    for c in cols:
        levels = all_levels[c]
        for lv in (levels[1:] if drop_first else levels):
            name = f"{c}_{lv}"
            names.append(name)
            exprs.append(F.when(F.col(c).cast("string") == F.lit(lv), 1.0).otherwise(0.0).alias(name))
    return df.select("*", *exprs), names


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "",
                shift: dict | None = None) -> tuple[DataFrame, dict]:
    """(x - mean) / population sd; a constant column maps to 0.

    With ``suffix`` the scaled columns are added as ``<col><suffix>``;
    without, they replace the originals in place. ``shift`` (column -> a
    typical value such as the median) makes each mean ``shift + avg(x -
    shift)``: the summed terms are small, so the mean carries far less
    rounding error and depends far less on the summation order.
    """
    cols = list(cols)
    if not cols:
        return df, {}
    shift = shift or {}
    means = [(F.lit(float(shift[c])) + F.avg(F.col(c) - F.lit(float(shift[c])))) if c in shift
             else F.avg(c) for c in cols]
    row = df.agg(*[m.alias(f"m{j}") for j, m in enumerate(means)],
                 *[F.stddev_pop(c).alias(f"s{j}") for j, c in enumerate(cols)]).first()
    stats = {c: (row[f"m{j}"], row[f"s{j}"]) for j, c in enumerate(cols)}
    return scale(df, stats, suffix), stats


def scale(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    """Columns scaled by given (mean, sd); see :func:`standardise`."""
    scaled = {}
    for c, (m, s) in stats.items():
        if m is None:
            scaled[c] = F.lit(None).cast("double")
        elif not s:
            scaled[c] = F.lit(0.0)
        else:
            scaled[c] = (F.col(c) - F.lit(m)) / F.lit(s)
    if suffix:
        return df.select("*", *[v.alias(c + suffix) for c, v in scaled.items()])
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


@dataclass
class Features:
    frame: DataFrame              # key, business columns, filled features, dummies, scaled vector
    names: list[str]              # feature columns in model order
    dropped: list[str] = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    scaling: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)


def prepare_features(base: DataFrame, as_of: str, key: str = spec.KEY,
                     numeric: Sequence[str] = spec.FEATURES,
                     categorical: Sequence[str] = spec.CATEGORICAL,
                     number_style: str = "br", vector: str = "features") -> Features:
    """Tenure from the signing date, typed numerics, median fill, one-hot of
    the categorical columns present, population-sd scaling, vector column."""
    # Several statistic passes follow (medians, levels, moments): read the
    # base once and cut its lineage, so they do not each re-run the ETL joins.
    df = typed_features(materialize(base), as_of, numeric, number_style)
    num = [c for c in numeric if c in df.columns]
    df, medians, dropped = impute_median(df, num)
    num = [c for c in num if c not in dropped]
    cats = [c for c in categorical if c in df.columns]
    levels = category_levels(df, cats)
    df, dummies = one_hot(df, cats, levels=levels)
    names = num + dummies
    df, scaling = standardise(df, names, suffix="__z", shift=medians)
    scaled = [c + "__z" for c in names]
    df = assemble(df, scaled, vector).drop(*scaled)
    return Features(df, names, dropped, medians, scaling, levels)


def typed_features(df: DataFrame, as_of: str, numeric: Sequence[str] = spec.FEATURES, number_style: str = "br") -> DataFrame:
    """Tenure from the signing date, and numbers in the numeric columns present."""
    if spec.SIGNED in df.columns:
        df = df.withColumn(spec.SIGNED, parse_date(df, spec.SIGNED))
        df = df.withColumn(spec.TENURE, tenure_months(F.col(spec.SIGNED), as_of))
    else:
        df = df.withColumn(spec.TENURE, F.lit(None).cast("double"))
    return df.select(*[to_double(df, c, number_style).alias(c) if c in numeric else F.col(c) for c in df.columns])
