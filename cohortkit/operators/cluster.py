"""K-means cohorts: model choice over a k grid by silhouette, nearest-centre
assignment, and a column-wise silhouette.

Spark ML k-means (k-means|| init, distributed Lloyd steps) does the fitting.
The silhouette is the squared-Euclidean form Spark's ``ClusteringEvaluator``
computes: it decomposes into per-cluster sums, so it costs one pass and a
k-row broadcast. The plain Euclidean silhouette, which takes all pairs of rows, is
in ``silhouette.py``; ``fit_best_k`` chooses by either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..session import materialize
from .relational import checked_broadcast
from .silhouette import euclidean_silhouette, overall


def kmeans_input(df: DataFrame, key: str, vector: str, partitions: int | None = None,
                 rows_per_partition: int = spec.KMEANS_ROWS_PER_PARTITION) -> DataFrame:
    """Hash partitions by key, sorted inside each: the fit then sees the same
    layout whatever order the input arrived in (repeatable seeds).

    The partition count comes from the row count (``rows_per_partition``)
    unless given, so it depends on the data only, never on the cluster. The
    layout must be the last thing before the fit: a table that is written and
    read again is packed into partitions by the cluster's core count.
    """
    if partitions is None:
        partitions = max(spec.KMEANS_LEAST_PARTITIONS, math.ceil(df.count() / rows_per_partition))
    return (df.select(key, vector).repartition(partitions, key)
            .sortWithinPartitions(key, F.xxhash64(vector_to_array(vector))))


@dataclass
class BestK:
    model: KMeansModel
    k: int
    scores: list[dict]           # one dict per k tried: k, silhouette, cost, sizes / skipped reason
    assignments: DataFrame       # key, cluster (renumbered: size desc, then first centre coordinate)
    labelled: DataFrame | None = None  # the fitted rows with all their columns, and their cluster
    centres: list | None = None  # by renumbered cluster


def fit_best_k(features: DataFrame, key: str = spec.KEY, vector: str = "features",
               ks: Sequence[int] = spec.K_GRID, seed: int = spec.SEED,
               partitions: int | None = None, max_iter: int = 100,
               n_starts: int = 1, cluster_col: str = spec.CLUSTER, silhouette: str = "squared",
               points: int = spec.SILHOUETTE_POINTS) -> BestK:
    """Fit k-means for each k, score by silhouette, keep the first best (strict >).

    A k is skipped (and reported) when the data has fewer than k+1 rows or the
    fit yields a single non-empty cluster: the silhouette is undefined there.
    ``n_starts`` > 1 tries seeds seed, seed+1, ... and keeps the lowest cost.
    ``silhouette`` is 'squared' or 'euclidean' (all pairs of rows; ``points`` is taken and changes nothing).
    """
    if silhouette not in ("squared", "euclidean"):
        raise ValueError("silhouette must be 'squared' or 'euclidean'")
    stored = materialize(features.drop(cluster_col), "kmeans-features")
    n = stored.count()
    data = kmeans_input(stored, key, vector, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _choose(stored, data, n, key, vector, ks, seed, max_iter, n_starts, cluster_col,
                       points if silhouette == "euclidean" else None)
    finally:
        data.unpersist()


def _choose(stored, data, n, key, vector, ks, seed, max_iter, n_starts, cluster_col, points) -> BestK:
    evaluator = ClusteringEvaluator(featuresCol=vector, predictionCol="__pred",
                                    metricName="silhouette", distanceMeasure="squaredEuclidean")
    data.count()  # stored once, before the fits share it

    # A fit keeps its own points where its input is not kept itself: over the stored columns alone, each of its
    # steps would decode all of them again. The layout is that of the stored input.
    points_of = data.select(vector)

    def fit(k: int, s: int) -> KMeansModel:
        return KMeans(k=k, seed=s, maxIter=max_iter, featuresCol=vector, predictionCol="__pred").fit(points_of)

    def score(model: KMeansModel) -> float:
        labelled = model.transform(data)
        if points is None:
            return evaluator.evaluate(labelled)
        rows = labelled.select(key, vector_to_array(vector).alias("__x"), "__pred")
        return overall(euclidean_silhouette(rows, ["__x"], "__pred", key, points, seed)).first()["silhouette"]

    # All fits are independent jobs over one stored input: they run side by side and fill the cluster.
    spark, usable = data.sparkSession, [k for k in ks if n > k]
    with ThreadPoolExecutor(spec.PARALLEL_FITS) as pool:
        run = lambda f, *args: pool.submit(inheritable_thread_target(spark)(f), *args)
        fits = {k: [run(fit, k, s) for s in range(seed, seed + max(1, n_starts))] for k in usable}
        starts = {k: [f.result() for f in fits[k]] for k in usable}
        models = {k: min(starts[k], key=lambda m: m.summary.trainingCost) for k in usable}  # the first of equal costs
        scored = {k: run(score, m) for k, m in models.items() if sum(1 for z in m.summary.clusterSizes if z > 0) >= 2}
        found = {k: f.result() for k, f in scored.items()}
    best, best_score, best_k, scores = None, -1.0, None, []
    for k in ks:
        if k not in models:
            scores.append({"k": k, "silhouette": None, "cost": None, "skipped": f"{n} rows <= k"})
            continue
        model = models[k]
        row = {"k": k, "silhouette": found.get(k), "cost": model.summary.trainingCost,
               "starts": [m.summary.trainingCost for m in starts[k]]}
        if k not in found:
            scores.append(row | {"skipped": "single cluster"})
            continue
        scores.append(row | {"sizes": list(model.summary.clusterSizes)})
        if found[k] > best_score:
            best, best_score, best_k = model, found[k], k
    if best is None:
        raise ValueError(f"no k in {list(ks)} could be scored: {scores}")
    labelled = renumber(best, best.transform(stored), cluster_col)
    centres = [best.clusterCenters()[i] for i in _order(best)]
    return BestK(best, best_k, scores, labelled.select(key, cluster_col), labelled, centres)


def _order(model: KMeansModel) -> list[int]:
    sizes, centres = model.summary.clusterSizes, model.clusterCenters()
    return sorted(range(len(sizes)), key=lambda i: (-sizes[i], float(centres[i][0]), i))


def renumber(model: KMeansModel, labelled: DataFrame, cluster_col: str = spec.CLUSTER) -> DataFrame:
    """Stable cluster ids: by size descending, then first centre coordinate."""
    new_id = {old: new for new, old in enumerate(_order(model))}
    mapping = F.create_map(*[x for old, new in new_id.items() for x in (F.lit(old), F.lit(new))])
    return labelled.select(*[c for c in labelled.columns if c != "__pred"],
                           mapping[F.col("__pred")].cast("int").alias(cluster_col))


def _one_row(rows: DataFrame, to_side: DataFrame, *fields: Column) -> DataFrame:
    """``to_side`` with all rows of a checked small table as one array column ``__all``.

    The table has a row per cluster; what is attached grows with clusters and
    columns in data, never in the size of the plan.
    """
    packed = rows.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__all")).withColumn("__one", F.lit(1))
    return to_side.withColumn("__one", F.lit(1)).join(checked_broadcast(packed), "__one").drop("__one")


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def nearest_centre(df: DataFrame, cols: Sequence[str], centres: DataFrame,
                   cluster_col: str = spec.CLUSTER, out: str = spec.CLUSTER) -> DataFrame:
    """Label each row with its nearest centre (squared Euclidean; ties go to
    the smaller id)."""
    point = F.array(*[F.col(c).cast("double") for c in cols])
    own = centres.select(F.col(cluster_col).alias("c"), point.alias("v"))
    joined = _one_row(own, df.withColumn("__x", point), F.col("c"), F.col("v"))

    def far(r: Column) -> Column:
        return F.aggregate(F.zip_with(F.col("__x"), r["v"], lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda s, v: s + v)

    best = F.array_min(F.transform("__all", lambda r: F.struct(far(r).alias("d"), r["c"].alias("c"))))["c"]
    return joined.select(*[F.col(c) for c in df.columns if c != out], best.alias(out))


def silhouette(df: DataFrame, cols: Sequence[str], cluster_col: str = spec.CLUSTER) -> DataFrame:
    """Mean squared-Euclidean silhouette over rows, from per-cluster sums.

    For row x and cluster C: D(x, C) = |x|^2 + sum|y|^2/n_C - 2 x.sum(y)/n_C.
    Own cluster: a = D * n/(n-1); others: b = min D; s = 1-a/b, b/a-1 or 0;
    singleton clusters score 0. Same definition as Spark's ClusteringEvaluator.
    The sums are one Summarizer aggregate. Returns one row: silhouette,
    n_rows, n_clusters.
    """
    point = F.array(*[F.col(c).cast("double") for c in cols])
    pts = materialize(df.select(F.col(cluster_col).alias("__c"), point.alias("__x"))
                      .withColumn("__sq", _dot(F.col("__x"), F.col("__x"))), "points")
    stats = (pts.groupBy("__c").agg(F.count(F.lit(1)).alias("n"), F.sum("__sq").alias("psi"),
                                    Summarizer.sum(array_to_vector("__x")).alias("s"))
             .select("__c", "n", "psi", vector_to_array("s").alias("s")))
    joined = _one_row(stats, pts, F.col("__c").alias("c"), F.col("n").cast("double").alias("n"), F.col("psi"),
                      F.col("s"))

    def dist(r: Column) -> Column:
        return F.col("__sq") + r["psi"] / r["n"] - F.lit(2.0) * _dot(F.col("__x"), r["s"]) / r["n"]

    far = F.transform("__all", lambda r: F.struct(r["c"].eqNullSafe(F.col("__c")).alias("own"), dist(r).alias("d"),
                                                  r["n"].alias("n")))
    parts = joined.select(F.filter(far, lambda r: r["own"])[0].alias("own"), F.size("__all").alias("k"),
                          F.array_min(F.transform(F.filter(far, lambda r: ~r["own"]), lambda r: r["d"])).alias("b"))
    n, b = F.col("own.n"), F.col("b")
    a = F.when(n > 1, F.col("own.d") * n / (n - 1))
    s = F.when(n <= 1, 0.0).when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(0.0)
    return parts.select(s.alias("s"), "k").agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n_rows"),
                                               F.max("k").cast("long").alias("n_clusters"))
