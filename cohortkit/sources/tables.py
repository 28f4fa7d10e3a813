"""Driver tables (TPC-H-like parquet) mapped onto the source project's inputs.

  client master   customer + nation: key, segment, revenue band, state, contract value
  client since    first order date per customer (key under the alias IdCliente)
  history         one row per line item: (CD_CLI, product name)
  revenue         orders of the 12 months before ``as_of``: MRR = total / 12 (alias CLIENTE)
  contracts       orders per customer, of all years: count and total value (alias
                  ID_CLIENTE), under the column names of the 12-month extract
  survey extracts events, one extract per event type, each with its own key
                  and score column names; the sixth holds all other events
  tickets         events: ticket id, type as status, value as resolution time,
                  organisation = the customer's nation
  telemetry       events split per type into numbered extracts, 6 to 11 by the
                  length of any other type

Scans name their columns, so Parquet reads only those.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..operators.relational import Routed

AS_OF = "2002-01-01"

# Survey extracts: event type -> (extract name, key alias, score column name).
# None stands for every other type, and for no type.
SURVEY_LAYOUT = {
    "view": ("nps_relacional", "CD_CLIENTE", "nps"),
    "click": ("nps_transacional_aquisicao", "IdCliente", "NOTA_NPS"),
    "purchase": ("nps_transacional_produto", "CLIENTE", "resposta_nps"),
    "signup": ("nps_transacional_onboarding", "metadata_codcliente", "Nps"),
    "error": ("nps_transacional_suporte", "COD_CLIENTE", "nota_nps"),
    None: ("nps_transacional_implantacao", "CD_CLI", "NPS"),
}
# Telemetry extracts: event type -> (extract name, key alias).
TELEMETRY_LAYOUT = {
    "click": ("telemetria_1", "CD_CLIENTE"),
    "view": ("telemetria_2", "ID_CLIENTE"),
    "purchase": ("telemetria_3", "CODIGO_CLIENTE"),
    "signup": ("telemetria_4", "CD_CLI"),
    "error": ("telemetria_5", "metadata_codcliente"),
}
# All other events, by the length of their type: extracts 6 to 11.
TELEMETRY_REST = [(f"telemetria_{6 + i}", "CLIENTE") for i in range(6)]
TICKET_OPEN = "error"
DURATION_NAME = "Tempo de Resolução"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def revenue_band(acctbal) -> F.Column:
    return (F.when(acctbal < 0, F.lit("neg"))
             .when(acctbal < 5000, F.lit("low"))
             .when(acctbal.isNotNull(), F.lit("high")))


def client_master(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation is a fixed 25-row dimension at every scale factor
    n = F.broadcast(table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias(spec.KEY),
                    F.col("c_mktsegment").alias(spec.SEGMENT),
                    revenue_band(F.col("c_acctbal")).alias(spec.BAND),
                    F.col("n_name").alias("UF"),
                    F.col("c_acctbal").alias(spec.CONTRACT_VALUE)))


def client_since(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    return (o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias(spec.SIGNED))
            .withColumnRenamed("o_custkey", "IdCliente"))


def ownership_rows(spark, sf_dir, key: str = spec.KEY) -> DataFrame:
    """One row per line item: (customer key, product name)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, F.col("l_partkey") == p.p_partkey)
            .select(F.col("o_custkey").alias(key), F.col("p_name").alias(spec.PRODUCT)))


def history(spark, sf_dir) -> DataFrame:
    return ownership_rows(spark, sf_dir, key="CD_CLI")


def revenue(spark, sf_dir, as_of: str = AS_OF) -> DataFrame:
    end = _dt.date.fromisoformat(as_of)
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    recent = o.where((F.col("o_orderdate") >= F.add_months(F.lit(end), -12).cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz")))
    return (recent.groupBy("o_custkey").agg((F.sum("o_totalprice") / 12).alias(spec.MRR))
            .withColumnRenamed("o_custkey", "CLIENTE"))


def contracts(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    return (o.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias(spec.N_CONTRACTS),
                 F.sum("o_totalprice").alias(spec.CONTRACTS_VALUE))
            .withColumnRenamed("o_custkey", "ID_CLIENTE"))


def _events(spark, sf_dir, *cols) -> DataFrame:
    return table(spark, sf_dir, "events", *cols)


def _of_type(etype, layout) -> F.Column:
    if etype is not None:
        return F.col("event_type") == etype
    return ~F.coalesce(F.col("event_type").isin([t for t in layout if t]), F.lit(False))


def survey_sources(spark, sf_dir) -> Routed:
    ev = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value")
    return Routed(ev, {name: (_of_type(etype, SURVEY_LAYOUT),
                              {"event_id": F.col("event_id"), "ts": F.col("ts"), key_alias: F.col("user_id"), score_name: F.col("value")})
                       for etype, (name, key_alias, score_name) in SURVEY_LAYOUT.items()})


def tickets_raw(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir, "event_id", "user_id", "event_type", "value")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return (ev.join(c, ev.user_id == c.c_custkey, "left")
            .select(F.col("c_nationkey").alias(spec.ORG), F.col("event_id").alias(spec.TICKET),
                    F.col("event_type").alias(spec.STATUS), F.col("value").alias(DURATION_NAME),
                    F.col("user_id").alias("IdCliente")))


def telemetry_sources(spark, sf_dir) -> Routed:
    ev = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    out = {name: (alias, _of_type(etype, TELEMETRY_LAYOUT)) for etype, (name, alias) in TELEMETRY_LAYOUT.items()}
    size = F.coalesce(F.length("event_type"), F.lit(0)) % len(TELEMETRY_REST)
    for i, (name, alias) in enumerate(TELEMETRY_REST):
        out[name] = (alias, _of_type(None, TELEMETRY_LAYOUT) & (size == i))
    return Routed(ev, {name: (own, {"event_id": F.col("event_id"), "ts": F.col("ts"), alias: F.col("user_id"), "props": F.col("props")})
                       for name, (alias, own) in out.items()})


def region_cohorts(spark, sf_dir, key: str = spec.KEY, cluster_col: str = spec.CLUSTER) -> DataFrame:
    """A given cohort map: each customer's region (for checks that must not
    depend on k-means)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = F.broadcast(table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias(key), F.col("n_regionkey").alias(cluster_col)))
