"""In-cohort popularity and "top products you do not own yet".

Shape of the work (no per-client Python loop):

1. ownership rows (client, product) are pre-aggregated to one row per pair
   with a row count (map-side combine: a client holding a third of all rows
   shrinks to at most one row per product before any shuffle);
2. popularity = pairs joined to the client->cluster map, summed per
   (cluster, product), ranked by quantity desc then product asc through a
   range partitioning, so that neither a cluster nor a tie is sorted in one task;
3. a client owning m products finds its n suggestions among the first n + m
   ranked products of its cluster -- exact, not a cap;
4. when the rankings' heads are small by a check of their size, they are
   broadcast as one ordered array per cluster and each client takes
   ``slice(array_except(first n + m, owned), 1, n)``. Otherwise each client
   makes its n + m (cluster, rank) rows, which join the ranking (the first n
   ranks salted), lose the owned pairs and keep the n best: rows follow the
   clients' holdings, and no row or task holds a catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import require_columns
from ..functions.text import join_list
from ..session import materialize
from .relational import checked_broadcast

RANK = "rank_in_cluster"
# Upper bound on the text broadcast with the ranking arrays (characters).
BROADCAST_CHARS = 32 * 1024 * 1024


def ownership_pairs(ownership: DataFrame, key: str = spec.KEY,
                    product: str = spec.PRODUCT) -> DataFrame:
    """Distinct (key, product-as-text) pairs with their row count ``n``;
    rows with a NULL key or product are dropped."""
    require_columns(ownership, key, product, what="ownership")
    return (ownership.select(F.col(key), F.col(product).cast("string").alias(product))
            .dropna(how="any", subset=[key, product])
            .groupBy(key, product).agg(F.count(F.lit(1)).alias("n")))


def owned_sets(ownership: DataFrame, key: str = spec.KEY, product: str = spec.PRODUCT,
               out: str = "owned", pairs: DataFrame | None = None) -> DataFrame:
    """(key, sorted distinct products, their count). Works from the pairs, so
    a per-client set never exceeds the product catalogue."""
    if pairs is None:
        pairs = ownership_pairs(ownership, key, product)
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list(product)).alias(out),
                                  F.count(F.lit(1)).alias("n_owned"))


def popularity(clusters: DataFrame, ownership: DataFrame, key: str = spec.KEY,
               product: str = spec.PRODUCT, cluster_col: str = spec.CLUSTER,
               qty: str = spec.QTY, count_mode: str = "rows",
               pairs: DataFrame | None = None) -> DataFrame:
    """(cluster, product, qty, rank): complete ranking per cluster.

    ``count_mode='rows'`` counts ownership rows (the source project's
    behaviour, so fan-out upstream inflates it); ``'clients'`` counts
    distinct clients.
    """
    if count_mode not in ("rows", "clients"):
        raise ValueError("count_mode must be 'rows' or 'clients'")
    if pairs is None:
        pairs = ownership_pairs(ownership, key, product)
    cl = clusters.select(key, cluster_col).dropna(subset=[key, cluster_col])
    j = pairs.join(cl, key)
    measure = F.sum("n") if count_mode == "rows" else F.count(F.lit(1))
    agg = j.groupBy(cluster_col, product).agg(measure.cast("long").alias(qty))
    return rank_by_quantity(agg, cluster_col, product, qty)


def rank_by_quantity(agg: DataFrame, cluster_col: str = spec.CLUSTER, product: str = spec.PRODUCT,
                     qty: str = spec.QTY) -> DataFrame:
    """Rank products in each cluster by quantity desc, then product asc.

    The rows are range-partitioned and sorted by (cluster, quantity, product).
    A row's rank is its place among the cluster's rows of its partition, plus
    the rows of the cluster in the partitions before.
    """
    order = [F.col(cluster_col), F.col(qty).desc(), F.col(product)]
    ids = F.monotonically_increasing_id()  # partition and place in it
    rows = materialize(agg.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", ids), "ranking")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    before = Window.partitionBy(cluster_col).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(cluster_col, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
              .select(cluster_col, "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__above")))
    return (rows.join(checked_broadcast(starts), [cluster_col, "__part"])  # a row per partition and cluster in it
            .select(cluster_col, product, qty,
                    (F.col("__above") + F.col("__at") - F.col("__first") + 1).cast("long").alias(RANK)))


def top_products(ranking: DataFrame, n: int = spec.TOP_N_CLUSTER,
                 qty: str = spec.QTY) -> DataFrame:
    """First ``n`` products per cluster (NULL quantity counts as 0)."""
    require_columns(ranking, qty, RANK, what="ranking")
    return ranking.withColumn(qty, F.coalesce(F.col(qty), F.lit(0).cast("long"))).where(F.col(RANK) <= n)


def top_unowned(clusters: DataFrame, ownership: DataFrame, n: int = spec.TOP_N_CLIENT,
                key: str = spec.KEY, product: str = spec.PRODUCT,
                cluster_col: str = spec.CLUSTER, out: str = spec.RECOMMENDATIONS,
                ranking: DataFrame | None = None, count_mode: str = "rows",
                broadcast_rows: int = spec.BROADCAST_ROWS, salt: int = 64,
                pairs: DataFrame | None = None) -> DataFrame:
    """(key, cluster, 'p1, p2, p3'): the cluster's best-ranked products the
    client does not own, in rank order; '' when there are none. Every client
    of ``clusters`` appears once. ``pairs`` (from ``ownership_pairs``) may be
    passed when the caller already has them."""
    # The pairs feed both the ranking and the owned sets: aggregate them once.
    if pairs is None:
        pairs = materialize(ownership_pairs(ownership, key, product), "pairs")
    if ranking is None:
        ranking = popularity(clusters, ownership, key, product, cluster_col,
                             count_mode=count_mode, pairs=pairs)
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n_owned"))
    cl = materialize(clusters.select(key, cluster_col).join(counts, key, "left")
                     .select(key, cluster_col, F.coalesce("n_owned", F.lit(0).cast("long")).alias("n_owned")), "clients")
    need = cl.groupBy(cluster_col).agg(F.max("n_owned").alias("max_owned"))
    trimmed = materialize(ranking.join(checked_broadcast(need), cluster_col)  # one row per cohort
                          .where(F.col(RANK) <= F.lit(n) + F.col("max_owned"))
                          .select(cluster_col, product, RANK), "ranking-heads")
    st = trimmed.agg(F.count(F.lit(1)).alias("entries"), F.sum(F.length(product)).alias("chars")).first()
    if st["entries"] <= broadcast_rows and (st["chars"] or 0) <= BROADCAST_CHARS:
        return _pick_from_arrays(cl, pairs, trimmed, n, key, product, cluster_col, out)
    return _pick_from_rows(cl, pairs, trimmed, n, key, product, cluster_col, out, salt)


def _pick_from_arrays(cl, pairs, trimmed, n, key, product, cluster_col, out):
    none = F.array().cast("array<string>")
    owned = pairs.groupBy(key).agg(F.collect_list(product).alias("owned"))
    lists = (trimmed.groupBy(cluster_col)
             .agg(F.array_sort(F.collect_list(F.struct(F.col(RANK), F.col(product)))).alias("r"))
             .select(cluster_col, F.col("r")[product].alias("ranked")))
    joined = cl.join(owned, key, "left").join(F.broadcast(lists), cluster_col, "left")  # its size was checked
    head = F.slice(F.coalesce("ranked", none), F.lit(1), (F.lit(n) + F.col("n_owned")).cast("int"))
    picked = F.slice(F.array_except(head, F.coalesce("owned", none)), 1, n)
    return joined.select(key, cluster_col, join_list(picked).alias(out))


def _pick_from_rows(cl, pairs, trimmed, n, key, product, cluster_col, out, salt):
    known = cl.where(F.col(key).isNotNull())
    wanted = known.select(key, cluster_col, F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n) + F.col("n_owned")))
                          .alias(RANK))
    # The first n ranks are wanted by every client of a cohort: they are salted.
    hot, zero = F.col(RANK) <= n, F.lit(0).cast("long")
    wanted = wanted.withColumn("__s", F.when(hot, F.pmod(F.xxhash64(key), F.lit(salt))).otherwise(zero))
    copies = trimmed.withColumn("__s", F.explode(F.when(hot, F.sequence(zero, F.lit(salt - 1).cast("long")))
                                                 .otherwise(F.array(zero))))
    left = wanted.join(copies, [cluster_col, RANK, "__s"]).join(pairs.select(key, product), [key, product], "left_anti")
    best = (left.groupBy(key, cluster_col)
            .agg(F.slice(F.array_sort(F.collect_list(F.struct(F.col(RANK), F.col(product)))), 1, n).alias("r"))
            .select(key, F.col(cluster_col).alias("__c"), F.col("r")[product].alias("picked")))
    none = F.array().cast("array<string>")
    joined = cl.join(best.withColumnRenamed(key, "__k"), (F.col(key) == F.col("__k")) & (F.col(cluster_col) == F.col("__c")), "left")
    return joined.select(key, cluster_col, join_list(F.coalesce("picked", none)).alias(out))
