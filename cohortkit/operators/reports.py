"""Cohort reports: the tables behind the source project's charts and sheets.

All are aggregates over the client table joined to its cluster; outputs have
one row per cluster (or per cluster and segment / feature), so they are small
even when the client table is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import require_columns, unify_key
from ..functions.labels import bucket3, persona_label
from ..functions.numbers import to_double
from ..session import materialize
from .quantiles import exact_quantiles, quantile_literals
from .relational import checked_broadcast


def with_clusters(base: DataFrame, clusters: DataFrame, key: str = spec.KEY,
                  cluster_col: str = spec.CLUSTER) -> DataFrame:
    """Client rows left-joined to their cluster (NULL when unassigned)."""
    base = unify_key(base, key)
    require_columns(clusters, key, cluster_col, what="clusters")
    return base.join(clusters.select(key, cluster_col), key, "left")


def cluster_sizes(clusters: DataFrame, cluster_col: str = spec.CLUSTER) -> DataFrame:
    """(cluster, n) ordered by cluster."""
    require_columns(clusters, cluster_col, what="clusters")
    return (clusters.where(F.col(cluster_col).isNotNull()).groupBy(cluster_col)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(cluster_col))


def cluster_profile(df: DataFrame, cols: Sequence[str], cluster_col: str = spec.CLUSTER,
                    number_style: str = "br") -> DataFrame:
    """Mean of each column per (non-NULL) cluster; text columns parsed first."""
    return (df.where(F.col(cluster_col).isNotNull())
            .groupBy(cluster_col)
            .agg(*[F.avg(to_double(df, c, number_style)).alias(c) for c in cols]))


def segment_counts(df: DataFrame, cluster_col: str = spec.CLUSTER, segment: str = spec.SEGMENT,
                   key: str = spec.KEY, qty: str = spec.QTY) -> DataFrame:
    """Non-NULL keys per (cluster, segment); NULL groups dropped."""
    return (df.where(F.col(cluster_col).isNotNull() & F.col(segment).isNotNull())
            .groupBy(cluster_col, segment).agg(F.count(key).alias(qty)))


def score_by_cluster(df: DataFrame, score: str = spec.SCORE_MEAN,
                     cluster_col: str = spec.CLUSTER, number_style: str = "br") -> DataFrame:
    """Mean score per cluster (clients without a score are skipped)."""
    require_columns(df, score, what="base")
    return (df.where(F.col(cluster_col).isNotNull()).groupBy(cluster_col)
            .agg(F.avg(to_double(df, score, number_style)).alias(score)))


def box_stats(df: DataFrame, value: str = spec.MRR, cluster_col: str = spec.CLUSTER,
              whisker: float = spec.BOX_WHISKER, number_style: str = "br") -> DataFrame:
    """Per cluster with at least one value: q1, median, q3 (linear), and the
    whiskers: the most extreme values within ``whisker`` x IQR of the box. A
    whisker whose nearest value lies inside the box ends at the box's edge."""
    require_columns(df, value, what="base")
    vals = (df.where(F.col(cluster_col).isNotNull())
            .select(cluster_col, to_double(df, value, number_style).alias("__v"))
            .where(F.col("__v").isNotNull()))
    vals = materialize(vals, "box-values")  # read for the quantiles and for the whiskers
    q = exact_quantiles(vals, ["__v"], [0.25, 0.5, 0.75], [cluster_col],
                        name=lambda c, p: {0.25: "q1", 0.5: "median", 0.75: "q3"}[p])
    iqr = F.col("q3") - F.col("q1")
    fences = q.select("*", (F.col("q1") - whisker * iqr).alias("__lo"),
                      (F.col("q3") + whisker * iqr).alias("__hi"))
    w = (vals.join(checked_broadcast(fences), cluster_col)  # one row per cohort
         .groupBy(cluster_col)
         .agg(F.min(F.when(F.col("__v") >= F.col("__lo"), F.col("__v"))).alias("whisker_low"),
              F.max(F.when(F.col("__v") <= F.col("__hi"), F.col("__v"))).alias("whisker_high"),
              F.count(F.lit(1)).alias("n")))
    return q.join(w, cluster_col).select(
        cluster_col, "n", F.least("whisker_low", "q1").alias("whisker_low"), "q1", "median", "q3",
        F.greatest("whisker_high", "q3").alias("whisker_high"))


def segment_mix(df: DataFrame, cluster_col: str = spec.CLUSTER, segment: str = spec.SEGMENT,
                wide: bool = False) -> DataFrame:
    """Clients per (cluster, segment) and their share within the cluster.

    Long form: (cluster, segment, n, share). ``wide=True`` pivots shares to
    one column per segment, 0 where a segment is absent.
    """
    counts = (df.where(F.col(cluster_col).isNotNull() & F.col(segment).isNotNull())
              .groupBy(cluster_col, segment).agg(F.count(F.lit(1)).alias("n")))
    long = counts.withColumn(
        "share", F.col("n") / F.sum("n").over(Window.partitionBy(cluster_col)))
    if not wide:
        return long
    return long.groupBy(cluster_col).pivot(segment).agg(F.first("share")).fillna(0.0)


def top_features(profile: DataFrame, cols: Sequence[str], n: int = spec.TOP_N_FEATURES,
                 cluster_col: str = spec.CLUSTER) -> DataFrame:
    """Features whose cluster means vary most (sample variance), top ``n``.
    With no variance defined (one cluster), all features are returned."""
    cols = [c for c in cols if c != cluster_col]
    if not cols:
        return profile.sparkSession.createDataFrame([], "feature string, variance double")
    var = profile.agg(*[F.var_samp(c).alias(c) for c in cols])
    long = var.unpivot([], cols, "feature", "variance")
    return long.orderBy(F.col("variance").desc_nulls_last(), F.col("feature")).limit(n)


def personas(base: DataFrame, clusters: DataFrame, key: str = spec.KEY,
             cluster_col: str = spec.CLUSTER, metrics: Sequence[str] = spec.PERSONA_METRICS,
             parts=spec.PERSONA_PARTS, probs=spec.TERCILES, label: str = spec.LABEL,
             number_style: str = "br") -> DataFrame:
    """(key, cluster, label): each cluster's mean of a metric is bucketed
    low / middle / high against the terciles of those means over clusters."""
    df = with_clusters(base, clusters, key, cluster_col)
    cols = [c for c in metrics if c in df.columns]
    profile = cluster_profile(df, cols, cluster_col, number_style)
    used = [(c, prefix) for c, prefix in parts if c in cols]
    if used:
        # one row per cohort, read by the thresholds and the labels
        profile = materialize(profile, "profile")
        t = quantile_literals(profile, [c for c, _ in used], list(probs))  # two numbers per metric
        pieces = [(prefix, bucket3(F.col(c), F.lit(t[c][0]).cast("double"),
                                   F.lit(t[c][1]).cast("double")))
                  for c, prefix in used]
        labels = profile.select(cluster_col, persona_label(pieces).alias(label))
    else:
        labels = profile.select(cluster_col, F.lit("").alias(label))
    return (df.select(key, cluster_col)
            .join(checked_broadcast(labels), cluster_col, "left")  # one row per cohort
            .select(key, cluster_col, label))
