"""Entry points B (clustering + recommendations) and C (reports), plus the
driver-table ETL that feeds them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..operators.cluster import BestK, fit_best_k
from ..operators.features import Features, prepare_features
from ..operators.recommend import ownership_pairs, popularity, top_products, top_unowned
from ..operators.reports import (box_stats, cluster_profile, cluster_sizes, personas,
                                 score_by_cluster, segment_counts, segment_mix, top_features,
                                 with_clusters)
from ..functions.columns import require_columns
from ..session import materialize
from ..sources import tables as T
from ..sources.sinks import write_table
from . import jobs


@dataclass
class DriverETL:
    clients: DataFrame     # master + since + history (one row per client and product)
    sales: DataFrame
    surveys: DataFrame
    base: DataFrame        # one row per client


def driver_etl(spark: SparkSession, sf_dir: str, as_of: str = T.AS_OF) -> DriverETL:
    master, since, hist = (T.client_master(spark, sf_dir), T.client_since(spark, sf_dir),
                           T.history(spark, sf_dir))
    cl = jobs.clients(master, since, hist).frame
    sa = jobs.sales(T.revenue(spark, sf_dir, as_of), T.contracts(spark, sf_dir)).frame
    sv = jobs.surveys(T.survey_sources(spark, sf_dir))
    # The history side only adds product rows; when it carries no profile
    # column, the base (first row per client over profile columns) is the same
    # without it, and skipping it saves a line-item-sized join.
    profile_cols = set(spec.CLIENT_COLUMNS) - {spec.KEY}
    if profile_cols.isdisjoint(hist.columns):
        cl_base = jobs.clients(master, since, None).frame
    else:
        cl_base = cl
    return DriverETL(cl, sa, sv, jobs.analytic_base(cl_base, sa, sv))


@dataclass
class CohortRun:
    """A fit and what follows from it; each table is made when it is asked for."""

    features: Features
    best: BestK
    ownership: DataFrame
    count_mode: str = "rows"

    @cached_property
    def clusters(self) -> DataFrame:
        """key, cluster"""
        return self.best.assignments

    @cached_property
    def profile(self) -> DataFrame:
        """cluster, mean of every model feature (unscaled, dummies included)"""
        return cluster_profile(self.best.labelled, self.features.names)

    @cached_property
    def segments(self) -> DataFrame | None:
        """cluster, segment, QTD"""
        labelled = self.best.labelled
        return segment_counts(labelled) if spec.SEGMENT in labelled.columns else None

    @cached_property
    def pairs(self) -> DataFrame:
        """key, product, n: the distinct ownership pairs, worked out once and read from a table after that"""
        return materialize(ownership_pairs(self.ownership), "pairs")

    @cached_property
    def ranking(self) -> DataFrame:
        """cluster, product, QTD, rank"""
        return popularity(self.clusters, self.ownership, count_mode=self.count_mode, pairs=self.pairs)

    @cached_property
    def recommendations(self) -> DataFrame:
        """key, cluster, RECOMENDACOES"""
        return top_unowned(self.clusters, self.ownership, ranking=self.ranking, pairs=self.pairs)

    @cached_property
    def scores(self) -> DataFrame:
        """k, silhouette, cost and why a k was skipped"""
        rows = [(s["k"], s.get("silhouette"), s.get("cost"), s.get("skipped")) for s in self.best.scores]
        return self.ownership.sparkSession.createDataFrame(
            rows, "k int, silhouette double, cost double, skipped string")


def run_clustering(base: DataFrame, ownership: DataFrame, as_of: str,
                   ks=spec.K_GRID, seed: int = spec.SEED, count_mode: str = "rows",
                   partitions: int | None = None) -> CohortRun:
    """Entry B: features -> k chosen by silhouette -> cluster tables ->
    in-cohort recommendations. ``ownership`` has (key, product) rows: the
    cleaned clients table (one row per client and product after the full-row
    dedupe), as the source project reads it. Labels stay on the fitted rows,
    so a client with a NULL key keeps its own."""
    feats = prepare_features(base, as_of)
    best = fit_best_k(feats.frame, ks=ks, seed=seed, partitions=partitions)
    return CohortRun(feats, best, ownership, count_mode)


def write_cohorts(run: CohortRun, out_root: str, fmt: str = "parquet") -> dict[str, str]:
    """The tables of entry B; the ranking in its own order."""
    out = out_root.rstrip("/")
    tables = {"clusters_clientes": run.clusters, "cluster_summary/metricas_medias": run.profile,
              "cluster_summary/segmento_contagem": run.segments,
              "recomendacoes_por_cluster": run.ranking.orderBy(spec.CLUSTER, F.col(spec.QTY).desc(), spec.PRODUCT),
              "recomendacoes_por_cliente": run.recommendations, "k_scores": run.scores}
    return {name.rpartition("/")[2]: write_table(df, f"{out}/{name}", fmt)
            for name, df in tables.items() if df is not None}


def stored_profile(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The profile that entry B stored, or None where there is none; one
    without its cluster column raises."""
    try:
        profile = spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    require_columns(profile, spec.CLUSTER, what="stored profile")
    return profile


def run_reports(base: DataFrame, clusters: DataFrame, ranking: DataFrame,
                profile: DataFrame | None = None) -> dict[str, DataFrame]:
    """Entry C: the tables behind every chart and sheet, one DataFrame each."""
    df = with_clusters(base, clusters)
    out = {"cluster_sizes": cluster_sizes(clusters),
           "top_products": top_products(ranking),
           "personas": personas(base, clusters)}
    if profile is None:  # recompute from the base's numeric columns
        from ..functions.columns import numeric_columns
        cols = numeric_columns(df, exclude=(spec.KEY, spec.CLUSTER))
        profile = cluster_profile(df, cols)
    out["top_features"] = top_features(profile, [c for c in profile.columns if c != spec.CLUSTER])
    if spec.SCORE_MEAN in df.columns:
        out["score_by_cluster"] = score_by_cluster(df)
    if spec.MRR in df.columns:
        out["box_stats"] = box_stats(df, spec.MRR)
    if spec.SEGMENT in df.columns:
        out["segment_mix"] = segment_mix(df)
    return out


def driver_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.ownership_rows(spark, sf_dir).select(spec.KEY, F.col(spec.PRODUCT))


def run_all(spark: SparkSession, sf_dir: str, out_root: str, as_of: str = T.AS_OF,
            ks=spec.K_GRID, seed: int = spec.SEED, fmt: str = "parquet") -> dict[str, str]:
    """Driver tables -> analytic base -> cohorts -> recommendations -> reports,
    every output written under ``out_root`` (local, HDFS or s3a:// path).
    Returns {table: path}."""
    out = out_root.rstrip("/")
    paths: dict[str, str] = {}
    etl = driver_etl(spark, sf_dir, as_of)
    paths["clientes_tratado"] = write_table(etl.clients, f"{out}/clientes_tratado", fmt)
    paths["base_analitica"] = write_table(etl.base, f"{out}/base_analitica", fmt)
    base = spark.read.format(fmt).load(paths["base_analitica"])
    clients = spark.read.format(fmt).load(paths["clientes_tratado"])
    run = run_clustering(base, clients, as_of, ks=ks, seed=seed)
    paths |= write_cohorts(run, out, fmt)
    clusters = spark.read.format(fmt).load(paths["clusters_clientes"])
    profile = stored_profile(spark, paths["metricas_medias"], fmt)
    for name, df in run_reports(base, clusters, run.ranking, profile).items():
        paths[name] = write_table(df, f"{out}/reports/{name}", fmt)
    return paths
