"""Exact linear-interpolation quantiles with bounded memory per task.

Same definition as pandas ``quantile`` / DuckDB ``quantile_cont`` / Spark
``percentile``: with n non-null values sorted, h = (n-1)p, the result is
x[floor h] + (h - floor h) * (x[floor h + 1] - x[floor h]).

Spark's exact ``percentile`` keeps a value->count map per group and merges it
in one task, so its memory grows with the distinct values of the largest
group. Here:

1. count non-null values per group (one aggregate, combined map-side);
2. if every group has at most ``bracket`` values, gather them (bounded) and
   pick the ranks; otherwise
3. ``percentile_approx`` with an accuracy chosen from the largest count gives,
   per group, two values lo <= x[r] <= hi around the needed ranks; one more
   aggregate counts values below lo, equal to lo, equal to hi, and gathers
   only the values strictly between (at most ~8n/accuracy <= bracket of
   them). Ties are counted, never gathered, so a value repeated a billion
   times costs one counter.

The picked ranks are checked against the bracket; should a bracket ever miss
(it cannot within the sketch's error bound), Spark's exact ``percentile``
recomputes the result, so the answer is exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..session import materialize


def _default_name(c: str, p: float) -> str:
    return f"{c}_q{p:g}".replace(".", "_")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (),
                    name: Callable[[str, float], str] = _default_name,
                    bracket: int = spec.QUANTILE_BRACKET,
                    broadcast_rows: int = spec.BROADCAST_ROWS) -> DataFrame:
    """One row per group: group columns plus one DOUBLE per (column, prob).

    Groups whose column is all NULL get NULL. NaN is treated as NULL.
    """
    g = list(group_cols) or ["__g"]
    src = df.select(*[F.col(c) for c in group_cols],
                    *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"__x{j}")
                      for j, c in enumerate(cols)])
    if not group_cols:
        src = src.withColumn("__g", F.lit(0))
    # Two or three passes read this projection: compute the input once, as a table.
    src = materialize(src, "quantile-input")

    counts = src.groupBy(*g).agg(*[F.count(f"__x{j}").alias(f"__n{j}") for j in range(len(cols))])
    counts = materialize(counts, "quantile-counts")
    st = counts.agg(F.count(F.lit(1)).alias("groups"),
                    *[F.max(f"__n{j}").alias(f"m{j}") for j in range(len(cols))]).first()
    n_groups = st["groups"]
    n_max = max([st[f"m{j}"] or 0 for j in range(len(cols))] + [0])

    approx = n_max > bracket
    bounds = counts
    if approx:
        accuracy = min(2**31 - 1, max(10_000, math.ceil(8 * n_max / bracket)))
        margin = 3.0 / accuracy
        edge = []
        for p in probs:
            edge += [max(0.0, p - margin), min(1.0, p + margin)]
        sketch = src.groupBy(*g).agg(*[
            F.percentile_approx(f"__x{j}", edge, accuracy).alias(f"__a{j}") for j in range(len(cols))])
        bounds = counts.join(sketch, g)

    side = F.broadcast(bounds) if n_groups <= broadcast_rows else bounds
    joined = src.join(side, g)

    aggs: list[Column] = []
    for j in range(len(cols)):
        x = F.col(f"__x{j}")
        aggs.append(F.first(f"__n{j}").alias(f"__n{j}"))
        for i in range(len(probs)):
            tag = f"{j}_{i}"
            if approx:
                lo = F.col(f"__a{j}")[2 * i]
                hi = F.col(f"__a{j}")[2 * i + 1]
                aggs += [
                    F.count_if(x < lo).alias(f"__below{tag}"),
                    F.count_if(x == lo).alias(f"__eqlo{tag}"),
                    F.count_if((x == hi) & (hi != lo)).alias(f"__eqhi{tag}"),
                    F.array_sort(F.collect_list(F.when((x > lo) & (x < hi), x))).alias(f"__in{tag}"),
                    F.first(lo).alias(f"__lo{tag}"),
                    F.first(hi).alias(f"__hi{tag}"),
                ]
            elif i == 0:
                aggs.append(F.array_sort(F.collect_list(x)).alias(f"__all{j}"))
    picked = joined.groupBy(*g).agg(*aggs)

    out_cols = [F.col(c) for c in group_cols]
    ok_terms = []
    for j, c in enumerate(cols):
        n = F.col(f"__n{j}")
        for i, p in enumerate(probs):
            tag = f"{j}_{i}"
            h = (n - 1).cast("double") * F.lit(float(p))
            r0 = F.floor(h).cast("long")
            r1 = F.least(r0 + 1, n - 1)
            frac = h - r0.cast("double")
            if approx:
                v0 = _rank_value(r0, tag)
                v1 = _rank_value(r1, tag)
            else:
                v0 = F.element_at(F.col(f"__all{j}"), (r0 + 1).cast("int"))
                v1 = F.element_at(F.col(f"__all{j}"), (r1 + 1).cast("int"))
            val = F.when(n > 0, v0 + (v1 - v0) * frac)
            out_cols.append(val.alias(name(c, p)))
            ok_terms.append((n == 0) | (v0.isNotNull() & v1.isNotNull()))
    ok = ok_terms[0]
    for t in ok_terms[1:]:
        ok = ok & t
    result = materialize(picked.select(*out_cols, ok.alias("__ok")), "quantiles")
    missed = result.filter(~F.col("__ok")).limit(1).count() > 0
    if missed:  # bracket missed the ranks: exact rescue with Spark's percentile
        return _builtin(df, cols, probs, group_cols, name)
    return result.drop("__ok")


def _rank_value(r: Column, tag: str) -> Column:
    """Value of global rank r (0-based) from the bracket summary, or NULL if
    r falls outside the bracket."""
    below, eqlo, eqhi = F.col(f"__below{tag}"), F.col(f"__eqlo{tag}"), F.col(f"__eqhi{tag}")
    inner = F.col(f"__in{tag}")
    k = r - below
    n_in = F.size(inner).cast("long")
    return (F.when(k < 0, F.lit(None).cast("double"))
             .when(k < eqlo, F.col(f"__lo{tag}"))
             .when(k < eqlo + n_in, F.element_at(inner, (k - eqlo + 1).cast("int")))
             .when(k < eqlo + n_in + eqhi, F.col(f"__hi{tag}")))


def _builtin(df, cols, probs, group_cols, name):
    aggs = []
    for c in cols:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        arr = F.percentile(x, [float(p) for p in probs])
        aggs += [arr[i].alias(name(c, p)) for i, p in enumerate(probs)]
    if group_cols:
        return df.groupBy(*group_cols).agg(*aggs)
    return df.agg(*aggs)


def quantile_literals(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                      bracket: int = spec.QUANTILE_BRACKET) -> dict[str, list[float | None]]:
    """Whole-table quantiles as Python numbers, in two aggregate jobs.

    Same method as ``exact_quantiles`` without groups: job 1 returns counts
    and a sketch; job 2 gathers either all values (when every column has at
    most ``bracket``) or only the bracket interiors, and picks the ranks in
    the aggregate's projection. One row comes back from each job.
    """
    cols, probs = list(cols), list(probs)
    xs = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    base_acc = 10_000
    margin = 3.0 / base_acc
    edges = []
    for p in probs:
        edges += [max(0.0, p - margin), min(1.0, p + margin)]
    first = df.agg(*[F.count(x).alias(f"n{j}") for j, x in enumerate(xs)],
                   *[F.percentile_approx(x, edges, base_acc).alias(f"a{j}") for j, x in enumerate(xs)]
                   ).first()
    ns = [first[f"n{j}"] for j in range(len(cols))]
    n_max = max(ns + [0])
    if n_max <= bracket:
        row = df.agg(*[F.array_sort(F.collect_list(x)).alias(f"v{j}") for j, x in enumerate(xs)]).select(
            *[_pick_sorted(F.col(f"v{j}"), ns[j], p).alias(f"q{j}_{i}")
              for j in range(len(cols)) for i, p in enumerate(probs)]).first()
        return {c: [row[f"q{j}_{i}"] for i in range(len(probs))] for j, c in enumerate(cols)}
    accuracy = min(2**31 - 1, max(base_acc, math.ceil(8 * n_max / bracket)))
    if accuracy > base_acc:
        margin = 3.0 / accuracy
        edges = []
        for p in probs:
            edges += [max(0.0, p - margin), min(1.0, p + margin)]
        first = df.agg(*[F.percentile_approx(x, edges, accuracy).alias(f"a{j}")
                         for j, x in enumerate(xs)]).first()
    aggs, picks = [], []
    for j, x in enumerate(xs):
        for i, p in enumerate(probs):
            tag = f"{j}_{i}"
            if ns[j] == 0:
                picks.append(F.lit(None).cast("double").alias(f"q{tag}"))
                continue
            lo, hi = first[f"a{j}"][2 * i], first[f"a{j}"][2 * i + 1]
            aggs += [F.count_if(x < F.lit(lo)).alias(f"__below{tag}"),
                     F.count_if(x == F.lit(lo)).alias(f"__eqlo{tag}"),
                     F.count_if((x == F.lit(hi)) & F.lit(hi != lo)).alias(f"__eqhi{tag}"),
                     F.array_sort(F.collect_list(F.when((x > F.lit(lo)) & (x < F.lit(hi)), x))
                                  ).alias(f"__in{tag}"),
                     F.first(F.lit(lo)).alias(f"__lo{tag}"), F.first(F.lit(hi)).alias(f"__hi{tag}")]
            h = (ns[j] - 1) * float(p)
            r0 = math.floor(h)
            r1 = min(r0 + 1, ns[j] - 1)
            v0, v1 = _rank_value(F.lit(r0), tag), _rank_value(F.lit(r1), tag)
            picks.append((v0 + (v1 - v0) * F.lit(h - r0)).alias(f"q{tag}"))
    row = df.agg(*aggs).select(*picks).first()  # n_max > bracket, so aggs is not empty
    out = {c: [row[f"q{j}_{i}"] for i in range(len(probs))] for j, c in enumerate(cols)}
    if any(v is None for j, c in enumerate(cols) if ns[j] > 0 for v in out[c]):
        # a bracket missed its ranks (outside the sketch bound): exact rescue
        r = _builtin(df, cols, probs, (), lambda c, p: f"q{cols.index(c)}_{probs.index(p)}").first()
        out = {c: [r[f"q{j}_{i}"] for i in range(len(probs))] for j, c in enumerate(cols)}
    return out


def _pick_sorted(arr: Column, n: int, p: float) -> Column:
    """Linear-interpolation quantile from a sorted array of the n values."""
    if n == 0:
        return F.lit(None).cast("double")
    h = (n - 1) * float(p)
    r0 = math.floor(h)
    r1 = min(r0 + 1, n - 1)
    v0, v1 = F.element_at(arr, r0 + 1), F.element_at(arr, r1 + 1)
    return v0 + (v1 - v0) * F.lit(h - r0)
