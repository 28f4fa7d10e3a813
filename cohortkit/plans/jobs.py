"""ETL jobs: extracts -> cleaned tables -> one analytic base (one row per client).

Each job is DataFrame in, DataFrame out; reading and writing are the
caller's (see ``run_etl``). Differences from the source project, on purpose:
the key is unified per extract before a union (else rows keyed by a later
alias lose their key); all-NULL rows are dropped before the provenance column
is added (after it, nothing is ever all-NULL); NULL keys never join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import (find_duration_column, key_source, require_columns, resolve_score,
                                 score_source, select_present, unify_key)
from ..functions.numbers import to_double
from ..functions.text import is_open_status
from ..operators.relational import (Routed, distinct_rows, drop_empty, first_per_key, left_join,
                                    union_sources)
from ..sources.fingerprint import input_fingerprint, store_fingerprint, stored_fingerprint
from ..sources.sinks import quarantine, write_table


@dataclass
class JobResult:
    frame: DataFrame | None
    quarantined: dict[str, DataFrame] = field(default_factory=dict)
    #: Why each of the quarantined was set aside.
    reasons: dict[str, str] = field(default_factory=dict)


def _unkeyed(df: DataFrame) -> str:
    return "no client key among its columns " + ", ".join(df.columns)


def _keyed(columns: dict[str, Column]) -> dict[str, Column]:
    source = key_source(list(columns))
    return columns if source is None else columns | {spec.KEY: columns[source]}


def _scored(columns: dict[str, Column]) -> dict[str, Column]:
    source = score_source(list(columns))
    return {spec.SCORE if c == source else c: v for c, v in columns.items()}


def surveys(frames: Mapping[str, DataFrame] | Routed, origin_col: str = spec.SURVEY_ORIGIN,
            score_style: str = "plain") -> DataFrame:
    """Union of survey extracts, keyed and with a numeric ``NPS`` column. Extracts that are parts of one
    table (``Routed``) are read in one scan."""
    if isinstance(frames, Routed):
        out = distinct_rows(frames.rename(columns=lambda c: _scored(_keyed(c))).union(origin_col))
    else:
        prepared = {name: resolve_score(unify_key(drop_empty(df))) for name, df in frames.items()}
        out = distinct_rows(union_sources(prepared, origin_col))
    if spec.SCORE in out.columns:
        out = out.withColumn(spec.SCORE, to_double(out, spec.SCORE, score_style))
    return out


def tickets(df: DataFrame, on_missing: str = "zero", number_style: str = "plain") -> DataFrame:
    """Cleaned tickets with a numeric ``TempoResolucao``.

    The duration column is found by name; a missing value (or a missing
    column) becomes 0 with ``on_missing='zero'`` or stays NULL with 'null'.
    """
    if on_missing not in ("zero", "null"):
        raise ValueError("on_missing must be 'zero' or 'null'")
    df = distinct_rows(drop_empty(df))
    found = find_duration_column(df.columns)
    v = to_double(df, found, number_style) if found else F.lit(None).cast("double")
    if on_missing == "zero":
        v = F.coalesce(v, F.lit(0.0))
    return unify_key(df.withColumn(spec.DURATION, v))


def tickets_by_org(df: DataFrame, open_status: str = spec.OPEN_STATUS) -> DataFrame:
    """Per organisation: tickets (non-NULL ids), open tickets, mean duration."""
    require_columns(df, spec.ORG, spec.TICKET, spec.STATUS, spec.DURATION, what="tickets")
    n, n_open, mean_dur = spec.TICKETS_OUT
    return (df.where(F.col(spec.ORG).isNotNull()).groupBy(spec.ORG)
            .agg(F.count(spec.TICKET).alias(n),
                 F.count_if(is_open_status(F.col(spec.STATUS), open_status)).cast("long").alias(n_open),
                 F.avg(spec.DURATION).alias(mean_dur)))


def sales(revenue: DataFrame, contracts: DataFrame, number_style: str = "comma") -> JobResult:
    """Revenue left-joined to contracts on the client key (n:m kept).

    ``number_style`` types the text amounts: 'comma' as the source project
    does, 'br' where they carry thousands separators. Without a key on either
    side nothing is joined; both go to quarantine.
    """
    revenue, contracts = unify_key(revenue), unify_key(contracts)
    if spec.MRR in revenue.columns:
        revenue = revenue.withColumn(spec.MRR, to_double(revenue, spec.MRR, number_style))
    for c in (spec.N_CONTRACTS, spec.CONTRACTS_VALUE):
        if c in contracts.columns:
            contracts = contracts.withColumn(c, to_double(contracts, c, number_style))
    if spec.KEY not in revenue.columns or spec.KEY not in contracts.columns:
        sides = {"mrr": revenue, "contratacoes": contracts}
        reasons = {name: _unkeyed(df) if spec.KEY not in df.columns else "nothing to join: no client key in "
                   + next(n for n in sides if n != name) for name, df in sides.items()}
        return JobResult(None, sides, reasons)
    # distinct(A join B) == distinct(A) join distinct(B) for an equi-join; deduping
    # the inputs first keeps duplicate rows from fanning out through the join.
    joined = left_join(_distinct(revenue), _distinct(contracts, "_1"), spec.KEY)
    return JobResult(_drop_empty(joined))


def _order_columns(df: DataFrame) -> list[str]:
    """Columns of the rows' places in their extracts, if the extracts were read with them."""
    return sorted(c for c in df.columns if c.startswith(spec.ROW_ORDER))


def _distinct(df: DataFrame, suffix: str = "") -> DataFrame:
    """Full-row distinct; where rows have a place, the first of equal rows keeps its own, under a name of its side."""
    if spec.ROW_ORDER not in df.columns:
        return distinct_rows(df)
    rest = [c for c in df.columns if c != spec.ROW_ORDER]
    return df.groupBy(*[F.col(f"`{c}`") for c in rest]).agg(F.min(spec.ROW_ORDER).alias(spec.ROW_ORDER + suffix))


def _drop_empty(df: DataFrame) -> DataFrame:
    return drop_empty(df, [c for c in df.columns if c not in _order_columns(df)])


def clients(master: DataFrame, since: DataFrame | None, history: DataFrame | None,
            number_style: str = "comma") -> JobResult:
    """Client master left-joined to client-since and history, each only when
    keyed; an unkeyed side is quarantined. No key on the master: no result.
    A side passed as None is left out. A text contract value is typed here,
    once: later stages see a number and never guess its style."""
    master = unify_key(master)
    if spec.CONTRACT_VALUE in master.columns:
        master = master.withColumn(spec.CONTRACT_VALUE, to_double(master, spec.CONTRACT_VALUE, number_style))
    if spec.KEY not in master.columns:
        return JobResult(None, {"dados_clientes": master}, {"dados_clientes": _unkeyed(master)})
    q: dict[str, DataFrame] = {}
    df = _distinct(master)
    for i, (name, side) in enumerate((("clientes_desde", since), ("historico", history)), 1):
        if side is None:
            continue
        side = unify_key(side)
        if spec.KEY in side.columns:
            df = left_join(df, _distinct(side, f"_{i}"), spec.KEY)
        else:
            q[name] = side
    return JobResult(_drop_empty(df), q, {name: _unkeyed(side) for name, side in q.items()})


def telemetry(frames: Mapping[str, DataFrame] | Routed, origin_col: str = spec.TELEMETRY_ORIGIN) -> DataFrame:
    """Union of telemetry extracts, each keyed on its own, tagged by its file name."""
    if isinstance(frames, Routed):
        return distinct_rows(frames.rename(lambda name: f"{name}{spec.EXTRACT_SUFFIX}", _keyed).union(origin_col))
    prepared = {f"{name}{spec.EXTRACT_SUFFIX}": unify_key(drop_empty(df)) for name, df in frames.items()}
    return distinct_rows(union_sources(prepared, origin_col))


def score_by_client(surveys_df: DataFrame, key: str = spec.KEY) -> DataFrame:
    """Mean score per client (plain mean). Without key or score: empty table."""
    if spec.SCORE in surveys_df.columns and key in surveys_df.columns:
        return (surveys_df.where(F.col(key).isNotNull()).groupBy(key)
                .agg(F.avg(to_double(surveys_df, spec.SCORE)).alias(spec.SCORE_MEAN)))
    return surveys_df.sparkSession.createDataFrame([], f"`{key}` string, `{spec.SCORE_MEAN}` double")


def analytic_base(clients_df: DataFrame, sales_df: DataFrame | None, surveys_df: DataFrame | None,
                  order_by: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per client: profile columns, sales columns, mean score.

    Duplicate clients keep their first row under ``order_by[table]`` (default: as
    the rows stand in their extracts, where these were read with row numbers;
    else all kept columns, i.e. the smallest row).
    """
    order_by = dict(order_by or {})

    def first(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
        df = unify_key(df)
        kept, places = select_present(df, columns, "table").columns, _order_columns(df)
        order = order_by.get(table) or [*places, *kept]
        return first_per_key(df.select(*kept, *places), spec.KEY, order).select(*kept)

    base = first(clients_df, spec.CLIENT_COLUMNS, "clients")
    if sales_df is not None:
        sa = first(sales_df, spec.SALES_COLUMNS, "sales")
        base = base.join(sa.where(F.col(spec.KEY).isNotNull()), spec.KEY, "left")
    if surveys_df is not None:
        base = base.join(score_by_client(unify_key(surveys_df)), spec.KEY, "left")
    else:
        base = base.withColumn(spec.SCORE_MEAN, F.lit(None).cast("double"))
    return base


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = True,
                  fmt: str = "parquet", inputs: Sequence[str | DataFrame] | None = None,
                  params: Mapping | None = None) -> DataFrame:
    """Read the table at ``path`` if it may be used again (and ``reuse``), else
    build, write and read it back.

    With ``inputs`` (paths or DataFrames that ``build`` reads) and ``params`` (what else its
    result depends on) a table is used again only if their fingerprint is the
    one stored with it: changed, added or removed files, another schema or
    another parameter lead to building, as does a table without a fingerprint.
    Without ``inputs`` any table that is there is used; only an absent path leads to
    building. A table that is there and cannot be read raises, and is not
    overwritten, unless its inputs have changed."""
    if inputs is not None:
        now = input_fingerprint(spark, inputs, params)
        if not (reuse and stored_fingerprint(spark, path) == now):
            write_table(build(), path, fmt)
            store_fingerprint(spark, path, now)
        return spark.read.format(fmt).load(path)
    if reuse:
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    write_table(build(), path, fmt)
    return spark.read.format(fmt).load(path)


def run_etl(spark: SparkSession, raw_root: str, out_root: str, reader=None,
            number_style: str = "comma", file_order: bool = False) -> dict[str, str]:
    """Entry A: every extract under ``raw_root`` -> cleaned tables and the
    analytic base under ``out_root``. Returns {table: path or reason}: each
    extract that is absent or unreadable is named as ``skipped:<name>`` with
    the reason, and each table that cannot be built without it as
    ``missing:<table>``; all others are built.

    ``file_order``: of several rows of a client the base keeps the first as they stand in
    the extracts, not the smallest; the client and sales tables then have the
    rows' places in columns beginning with ``spec.ROW_ORDER``."""
    from ..sources.delimited import read_delimited, read_sources
    reader = reader or read_delimited
    placed = (lambda *a, **kw: reader(*a, row_number=spec.ROW_ORDER, **kw)) if file_order else reader
    done: dict[str, str] = {}
    why: dict[str, str] = {}
    out = out_root.rstrip("/")

    def read(names: Sequence[str], reader=reader) -> dict[str, DataFrame]:
        frames, skipped = read_sources(spark, raw_root, names, reader=reader)
        done.update({f"skipped:{name}": reason for name, reason in skipped.items()})
        return frames

    sv = read(spec.SURVEY_SOURCES)
    sv_df = surveys(sv) if sv else None
    if sv_df is not None:
        done["nps_tratado"] = write_table(sv_df, f"{out}/nps_tratado")

    tk = read(["tickets"])
    if tk:
        t = tickets(tk["tickets"])
        done["tickets_tratado"] = write_table(t, f"{out}/tickets_tratado")
        if spec.ORG in t.columns:
            done["tickets_agg_organizacao"] = write_table(tickets_by_org(t),
                                                          f"{out}/tickets_agg_organizacao")

    sa = read(spec.SALES_SOURCES, placed)
    sales_df = None
    if len(sa) < 2:
        done["missing:vendas_tratado"] = "needs " + " and ".join(spec.SALES_SOURCES)
    else:
        r = sales(*[sa[name] for name in spec.SALES_SOURCES], number_style=number_style)
        for name, q in r.quarantined.items():
            done[f"quarantine:{name}"] = quarantine(q, out, name, reason=r.reasons[name])
            why[f"quarantine:{name}"] = r.reasons[name]
        if r.frame is not None:
            sales_df = r.frame
            done["vendas_tratado"] = write_table(sales_df, f"{out}/vendas_tratado")

    master, since, history = spec.CLIENT_SOURCES
    cl = read(spec.CLIENT_SOURCES, placed)
    if master not in cl:
        done["missing:clientes_tratado"] = f"needs {master}"
    else:
        r = clients(cl[master], cl.get(since), cl.get(history), number_style)
        for name, q in r.quarantined.items():
            done[f"quarantine:{name}"] = quarantine(q, out, name, reason=r.reasons[name])
            why[f"quarantine:{name}"] = r.reasons[name]
        if r.frame is not None:
            done["clientes_tratado"] = write_table(r.frame, f"{out}/clientes_tratado")

    te = read(spec.TELEMETRY_SOURCES)
    if te:
        done["telemetria_tratado"] = write_table(telemetry(te), f"{out}/telemetria_tratado")

    if "clientes_tratado" in done:
        base = analytic_base(spark.read.parquet(done["clientes_tratado"]),
                             spark.read.parquet(done["vendas_tratado"]) if "vendas_tratado" in done else None,
                             spark.read.parquet(done["nps_tratado"]) if "nps_tratado" in done else None)
        done["base_analitica"] = write_table(base, f"{out}/base_analitica")
    else:
        done["missing:base_analitica"] = "needs clientes_tratado"
    # What was not read or not built, and what was set aside, as a table: kind, name, reason (for what is set
    # aside, its place follows).
    told = [(*k.split(":", 1), f"{why[k]}: {v}" if k in why else v) for k, v in done.items() if ":" in k]
    report = spark.createDataFrame(told, "kind string, name string, reason string")
    done["extract_report"] = write_table(report.coalesce(1), f"{out}/extract_report")
    return done
