"""DuckDB SQL for each registered query (same column names and types).

Written independently of the Spark code path: plain joins, GROUP BY,
window functions and quantile_cont over the same parquet views.
"""

from __future__ import annotations

from .. import spec

AS_OF = "2002-01-01"
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # sorted levels after the first
BANDS = ["low", "neg"]
NUMERIC = list(spec.FEATURES)
DUMMIES = [f"DS_SEGMENTO_{s}" for s in SEGMENTS] + [f"FAT_FAIXA_{b}" for b in BANDS]
MODEL = NUMERIC + DUMMIES

CL = """cl AS (SELECT c.c_custkey AS CD_CLIENTE, n.n_regionkey AS cluster
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
OWN = """own AS (SELECT o.o_custkey AS CD_CLIENTE, p.p_name AS DS_PROD
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
              JOIN part p ON l.l_partkey = p.p_partkey
              WHERE o.o_custkey IS NOT NULL AND p.p_name IS NOT NULL)"""
POP_ROWS = """pop AS (SELECT cl.cluster, own.DS_PROD, CAST(count(*) AS BIGINT) AS QTD
              FROM own JOIN cl ON own.CD_CLIENTE = cl.CD_CLIENTE
              WHERE cl.cluster IS NOT NULL GROUP BY cl.cluster, own.DS_PROD)"""
POP_CLIENTS = """pop AS (SELECT cl.cluster, own.DS_PROD, CAST(count(DISTINCT own.CD_CLIENTE) AS BIGINT) AS QTD
              FROM own JOIN cl ON own.CD_CLIENTE = cl.CD_CLIENTE
              WHERE cl.cluster IS NOT NULL GROUP BY cl.cluster, own.DS_PROD)"""
RANKED = """rk AS (SELECT cluster, DS_PROD, QTD,
                 row_number() OVER (PARTITION BY cluster ORDER BY QTD DESC, DS_PROD) AS rank_in_cluster
             FROM pop)"""

MASTER = """master AS (
  SELECT c.c_custkey AS CD_CLIENTE, c.c_mktsegment AS DS_SEGMENTO,
         CASE WHEN c.c_acctbal < 0 THEN 'neg' WHEN c.c_acctbal < 5000 THEN 'low'
              WHEN c.c_acctbal IS NOT NULL THEN 'high' END AS FAT_FAIXA,
         n.n_name AS UF, c.c_acctbal AS VL_TOTAL_CONTRATO
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
SINCE = """since AS (SELECT o_custkey AS IdCliente, o_custkey AS CD_CLIENTE,
                  CAST(min(o_orderdate) AS DATE) AS DT_ASSINATURA_CONTRATO
           FROM orders GROUP BY o_custkey)"""
HIST = """hist AS (SELECT DISTINCT o.o_custkey AS CD_CLI, o.o_custkey AS CD_CLIENTE, p.p_name AS DS_PROD
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN part p ON l.l_partkey = p.p_partkey)"""
REVENUE = f"""revenue AS (SELECT o_custkey AS CLIENTE, o_custkey AS CD_CLIENTE, sum(o_totalprice) / 12 AS MRR_12M
             FROM orders
             WHERE o_orderdate >= CAST(DATE '{AS_OF}' - INTERVAL 12 MONTH AS TIMESTAMP)
               AND o_orderdate < CAST(DATE '{AS_OF}' AS TIMESTAMP)
             GROUP BY o_custkey)"""
CONTRACTS = """contracts AS (SELECT o_custkey AS ID_CLIENTE, o_custkey AS CD_CLIENTE,
                      CAST(count(*) AS DOUBLE) AS QTD_CONTRATACOES_12M,
                      sum(o_totalprice) AS VLR_CONTRATACOES_12M
               FROM orders GROUP BY o_custkey)"""
SALES = """sales AS (SELECT r.CLIENTE, r.MRR_12M, r.CD_CLIENTE, c.ID_CLIENTE, c.QTD_CONTRATACOES_12M,
                  c.VLR_CONTRATACOES_12M
           FROM revenue r LEFT JOIN contracts c ON r.CD_CLIENTE = c.CD_CLIENTE)"""
NPS = """nps AS (SELECT user_id AS CD_CLIENTE, avg(value) AS NPS_MEDIO FROM events
         WHERE user_id IS NOT NULL GROUP BY user_id)"""
BASE = """base AS (
  SELECT m.CD_CLIENTE, m.DS_SEGMENTO, m.FAT_FAIXA, m.UF, m.VL_TOTAL_CONTRATO, s.DT_ASSINATURA_CONTRATO,
         sa.MRR_12M, sa.QTD_CONTRATACOES_12M, sa.VLR_CONTRATACOES_12M, nps.NPS_MEDIO
  FROM master m LEFT JOIN since s ON m.CD_CLIENTE = s.CD_CLIENTE
  LEFT JOIN sales sa ON m.CD_CLIENTE = sa.CD_CLIENTE
  LEFT JOIN nps ON m.CD_CLIENTE = nps.CD_CLIENTE)"""
BASE_CHAIN = ",\n".join([MASTER, SINCE, REVENUE, CONTRACTS, SALES, NPS, BASE])

TYPED = f"""typed AS (
  SELECT CD_CLIENTE, DS_SEGMENTO, FAT_FAIXA, MRR_12M, QTD_CONTRATACOES_12M, VLR_CONTRATACOES_12M,
         NPS_MEDIO, VL_TOTAL_CONTRATO,
         round_even(date_diff('day', DT_ASSINATURA_CONTRATO, DATE '{AS_OF}') / 30.44::DOUBLE, 1)
           AS ANTIGUIDADE_MESES
  FROM base)"""
MED = "med AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM typed)"
FILLED = ("filled AS (SELECT t.CD_CLIENTE, t.DS_SEGMENTO, t.FAT_FAIXA, "
          + ", ".join(f"coalesce(t.{c}, med.m_{c}) AS {c}" for c in NUMERIC)
          + " FROM typed t, med)")
DUMMY_EXPRS = ([f"CASE WHEN DS_SEGMENTO = '{s}' THEN 1.0 ELSE 0.0 END AS DS_SEGMENTO_{s}" for s in SEGMENTS]
               + [f"CASE WHEN FAT_FAIXA = '{b}' THEN 1.0 ELSE 0.0 END AS FAT_FAIXA_{b}" for b in BANDS])
FEATS = ("feats AS (SELECT CD_CLIENTE, " + ", ".join(NUMERIC) + ", "
         + ", ".join(f"CAST({e.split(' AS ')[0]} AS DOUBLE) AS {e.split(' AS ')[1]}" for e in DUMMY_EXPRS)
         + " FROM filled)")
Z = ("z AS (SELECT CD_CLIENTE, "
     + ", ".join(f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
                 f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS z_{c}" for c in MODEL)
     + " FROM feats)")
FEATURE_CHAIN = ",\n".join([BASE_CHAIN, TYPED, MED, FILLED, FEATS, Z])
BC = "bc AS (SELECT b.*, cl.cluster FROM base b LEFT JOIN cl ON b.CD_CLIENTE = cl.CD_CLIENTE)"
REPORT_METRICS = ["MRR_12M", "QTD_CONTRATACOES_12M", "VLR_CONTRATACOES_12M", "NPS_MEDIO",
                  "VL_TOTAL_CONTRATO"]


def r6(expr: str, digits: int = 12) -> str:
    """``digits`` significant digits (12 by default), the same rule as the Spark side."""
    e = f"({expr})"
    scale = f"pow(10.0, floor(log10(abs({e}))))"
    return f"(CASE WHEN {e} IS NULL OR {e} = 0 THEN {e} ELSE round({e} / {scale}, {digits - 1}) * {scale} END)"


def _sources(layout: list[tuple[str, str, str]], key_aliases: list[str], extra: str,
             origin: str, score: str | None) -> str:
    parts = []
    named = ", ".join(f"'{etype}'" for etype, _, _ in layout if etype and "(" not in etype)
    for etype, name, alias in layout:
        cols = ["event_id", "ts", f"user_id AS {spec.KEY}"]
        if score:
            cols.append(f"{r6('value')} AS {score}")
        cols.append(f"'{name}' AS {origin}")
        cols += [(f"user_id AS {a}" if a == alias else f"CAST(NULL AS BIGINT) AS {a}") for a in key_aliases]
        if extra:
            cols.append(extra)
        own = f"event_type = '{etype}'"
        if etype is None or "(" in etype:
            own = f"(event_type IS NULL OR event_type NOT IN ({named}))" + (f" AND {etype}" if etype else "")
        parts.append(f"SELECT {', '.join(cols)} FROM events WHERE {own}")
    return "SELECT DISTINCT * FROM (" + "\nUNION ALL\n".join(parts) + ")"


SURVEYS_SQL = _sources(
    [("view", "nps_relacional", "CD_CLIENTE"), ("click", "nps_transacional_aquisicao", "IdCliente"),
     ("purchase", "nps_transacional_produto", "CLIENTE"),
     ("signup", "nps_transacional_onboarding", "metadata_codcliente"),
     ("error", "nps_transacional_suporte", "COD_CLIENTE"), (None, "nps_transacional_implantacao", "CD_CLI")],
    ["IdCliente", "CLIENTE", "metadata_codcliente", "COD_CLIENTE", "CD_CLI"], "", "origem_nps", "NPS")
TELEMETRY_SQL = _sources(
    [("click", "telemetria_1.csv", "CD_CLIENTE"), ("view", "telemetria_2.csv", "ID_CLIENTE"),
     ("purchase", "telemetria_3.csv", "CODIGO_CLIENTE"), ("signup", "telemetria_4.csv", "CD_CLI"),
     ("error", "telemetria_5.csv", "metadata_codcliente")]
    + [(f"coalesce(length(event_type), 0) % 6 = {i}", f"telemetria_{6 + i}.csv", "CLIENTE") for i in range(6)],
    ["ID_CLIENTE", "CODIGO_CLIENTE", "CD_CLI", "metadata_codcliente", "CLIENTE"], "props", "fonte", None)


def _var_union(table: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, var_samp({c}) AS variance FROM {table}"
                                for c in cols)


def _persona_case(v: str, lo: str, hi: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN 'Médio' WHEN {v} <= {lo} THEN 'Baixo' "
            f"WHEN {v} >= {hi} THEN 'Alto' ELSE 'Médio' END")


SQL: dict[str, str] = {
    "q_recommend": f"""WITH {CL}, {OWN}, {POP_ROWS}, {RANKED},
cand AS (SELECT cl.CD_CLIENTE, rk.DS_PROD, rk.rank_in_cluster AS r FROM cl JOIN rk ON cl.cluster = rk.cluster
         WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.CD_CLIENTE = cl.CD_CLIENTE AND own.DS_PROD = rk.DS_PROD)),
top AS (SELECT CD_CLIENTE, DS_PROD, r, row_number() OVER (PARTITION BY CD_CLIENTE ORDER BY r) AS k FROM cand)
SELECT cl.CD_CLIENTE, cl.cluster,
       coalesce(string_agg(top.DS_PROD, ', ' ORDER BY top.r), '') AS RECOMENDACOES
FROM cl LEFT JOIN top ON top.CD_CLIENTE = cl.CD_CLIENTE AND top.k <= 3
GROUP BY cl.CD_CLIENTE, cl.cluster""",

    "q_popularity": f"WITH {CL}, {OWN}, {POP_ROWS}, {RANKED} SELECT * FROM rk",
    "q_popularity_clients": f"WITH {CL}, {OWN}, {POP_CLIENTS}, {RANKED} SELECT * FROM rk",
    "q_top_products": f"WITH {CL}, {OWN}, {POP_ROWS}, {RANKED} SELECT * FROM rk WHERE rank_in_cluster <= 10",
    "q_owned_set": f"""WITH {OWN}
SELECT CD_CLIENTE, array_to_string(list_sort(list_distinct(list(DS_PROD))), ', ') AS owned,
       CAST(count(DISTINCT DS_PROD) AS BIGINT) AS n_owned
FROM own GROUP BY CD_CLIENTE""",

    "q_locale_number": f"""SELECT o_orderkey, translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') AS price_text,
       {r6('o_totalprice')} AS value_br,
       CASE WHEN o_orderkey % 5 = 0 THEN 'n.d.' ELSE ' ' || format('{{:.2f}}', o_totalprice) END AS plain_text,
       {r6('CASE WHEN o_totalprice < 1000 THEN o_totalprice END')} AS value_comma,
       CAST(NULL AS DOUBLE) AS value_none,
       {r6('CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END')} AS value_plain
FROM orders""",

    "q_tenure": f"""SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')
            WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE 'x' || strftime(o_orderdate, '%d%m%Y') END AS date_text,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS signed,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN
         round_even(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 30.44::DOUBLE, 1) END
         AS tenure_months
FROM orders""",

    "q_surveys": SURVEYS_SQL,
    "q_telemetry": TELEMETRY_SQL,

    "q_tickets": f"""SELECT DISTINCT c.c_nationkey AS CODIGO_ORGANIZACAO, e.event_id AS BK_TICKET,
       e.event_type AS STATUS_TICKET, {r6('e.value')} AS "Tempo de Resolução", e.user_id AS IdCliente,
       {r6('coalesce(e.value, 0.0)')} AS TempoResolucao, e.user_id AS CD_CLIENTE
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""",

    "q_tickets_by_org": f"""SELECT c.c_nationkey AS CODIGO_ORGANIZACAO, count(e.event_id) AS QTD_CHAMADOS,
       CAST(count_if(upper(e.event_type) = 'ERROR') AS BIGINT) AS CHAMADOS_ABERTOS,
       {r6('avg(coalesce(e.value, 0.0))')} AS TEMPO_MEDIO_RES
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
WHERE c.c_nationkey IS NOT NULL GROUP BY c.c_nationkey""",

    "q_sales": f"""WITH {REVENUE}, {CONTRACTS}, {SALES}
SELECT CLIENTE, {r6('MRR_12M')} AS MRR_12M, CD_CLIENTE, ID_CLIENTE,
       {r6('QTD_CONTRATACOES_12M')} AS QTD_CONTRATACOES_12M,
       {r6('VLR_CONTRATACOES_12M')} AS VLR_CONTRATACOES_12M FROM sales""",

    "q_clients": f"""WITH {MASTER}, {SINCE}, {HIST}
SELECT m.CD_CLIENTE, m.DS_SEGMENTO, m.FAT_FAIXA, m.UF, {r6('m.VL_TOTAL_CONTRATO')} AS VL_TOTAL_CONTRATO,
       s.IdCliente, s.DT_ASSINATURA_CONTRATO, h.CD_CLI, h.DS_PROD
FROM master m LEFT JOIN since s ON m.CD_CLIENTE = s.CD_CLIENTE
LEFT JOIN hist h ON m.CD_CLIENTE = h.CD_CLIENTE""",

    "q_score_by_client": f"WITH {NPS} SELECT CD_CLIENTE, {r6('NPS_MEDIO')} AS NPS_MEDIO FROM nps",

    "q_first_per_key": f"""SELECT o_orderkey, o_custkey, o_orderdate, {r6('o_totalprice')} AS o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""",

    "q_analytic_base": f"""WITH {BASE_CHAIN}
SELECT CD_CLIENTE, DS_SEGMENTO, FAT_FAIXA, UF, {r6('VL_TOTAL_CONTRATO')} AS VL_TOTAL_CONTRATO,
       DT_ASSINATURA_CONTRATO, {r6('MRR_12M')} AS MRR_12M, {r6('QTD_CONTRATACOES_12M')} AS QTD_CONTRATACOES_12M,
       {r6('VLR_CONTRATACOES_12M')} AS VLR_CONTRATACOES_12M, {r6('NPS_MEDIO')} AS NPS_MEDIO
FROM base""",

    "q_drop_empty": f"""WITH {BASE_CHAIN}
SELECT CD_CLIENTE, {r6('MRR_12M')} AS MRR_12M, {r6('QTD_CONTRATACOES_12M')} AS QTD_CONTRATACOES_12M,
       {r6('VLR_CONTRATACOES_12M')} AS VLR_CONTRATACOES_12M, {r6('NPS_MEDIO')} AS NPS_MEDIO
FROM base
WHERE NOT (MRR_12M IS NULL AND QTD_CONTRATACOES_12M IS NULL AND VLR_CONTRATACOES_12M IS NULL
           AND NPS_MEDIO IS NULL)""",

    "q_drop_incomplete": f"""WITH {BASE_CHAIN}
SELECT CD_CLIENTE, {r6('MRR_12M')} AS MRR_12M, {r6('NPS_MEDIO')} AS NPS_MEDIO
FROM base WHERE MRR_12M IS NOT NULL AND NPS_MEDIO IS NOT NULL""",

    "q_impute_median": f"""WITH {BASE_CHAIN}, {TYPED}, {MED}, {FILLED}
SELECT CD_CLIENTE, {', '.join(f"{r6(c)} AS {c}" for c in NUMERIC)} FROM filled""",

    "q_one_hot": f"""WITH {MASTER}
SELECT CD_CLIENTE, {', '.join(f"CAST({e.split(' AS ')[0]} AS DOUBLE) AS {e.split(' AS ')[1]}"
                               for e in DUMMY_EXPRS)} FROM master""",

    "q_one_hot_wide": f"""WITH lv AS (
  SELECT 0 AS c, c_name AS v, count(*) AS n FROM customer WHERE c_name IS NOT NULL GROUP BY c_name
  UNION ALL SELECT 1, c_mktsegment, count(*) FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY v) - 2 AS i, n / (SELECT count(*) FROM customer) AS p FROM lv),
l AS (SELECT c, v, CASE WHEN c = 0 THEN i ELSE i + (SELECT count(*) - 1 FROM lv WHERE c = 0) END AS place,
             1 / sqrt(p * (1 - p)) AS w FROM r WHERE i >= 0)
SELECT c_custkey, a.place AS c_name__place, {r6('a.w')} AS c_name__weight, b.place AS c_mktsegment__place,
       {r6('b.w')} AS c_mktsegment__weight, (SELECT count(*) FROM lv) - 2 AS width
FROM customer LEFT JOIN l a ON a.c = 0 AND a.v = c_name LEFT JOIN l b ON b.c = 1 AND b.v = c_mktsegment""",

    "q_standardise": f"""WITH {FEATURE_CHAIN}
SELECT CD_CLIENTE, {', '.join(f"round(z_{c}, 9) AS z_{c}" for c in MODEL)} FROM z""",

    "q_cluster_sizes": f"""WITH {CL}
SELECT cluster, count(*) AS n FROM cl WHERE cluster IS NOT NULL GROUP BY cluster""",

    "q_cluster_profile": f"""WITH {BASE_CHAIN}, {CL}, {BC}
SELECT cluster, {', '.join(f"{r6(f'avg({c})')} AS {c}" for c in REPORT_METRICS)}
FROM bc WHERE cluster IS NOT NULL GROUP BY cluster""",

    "q_segment_counts": f"""WITH {BASE_CHAIN}, {CL}, {BC}
SELECT cluster, DS_SEGMENTO, count(CD_CLIENTE) AS QTD FROM bc
WHERE cluster IS NOT NULL AND DS_SEGMENTO IS NOT NULL GROUP BY cluster, DS_SEGMENTO""",

    "q_segment_mix": f"""WITH {BASE_CHAIN}, {CL}, {BC},
cnt AS (SELECT cluster, DS_SEGMENTO, count(*) AS n FROM bc
        WHERE cluster IS NOT NULL AND DS_SEGMENTO IS NOT NULL GROUP BY cluster, DS_SEGMENTO)
SELECT cluster, DS_SEGMENTO, n, {r6('n / sum(n) OVER (PARTITION BY cluster)')} AS share FROM cnt""",

    "q_segment_mix_wide": f"""WITH {BASE_CHAIN}, {CL}, {BC},
cnt AS (SELECT cluster, DS_SEGMENTO, count(*) AS n FROM bc
        WHERE cluster IS NOT NULL AND DS_SEGMENTO IS NOT NULL GROUP BY cluster, DS_SEGMENTO),
sh AS (SELECT cluster, DS_SEGMENTO, n / sum(n) OVER (PARTITION BY cluster) AS share FROM cnt)
SELECT cluster, {', '.join(f"{r6(f'coalesce(max(CASE WHEN DS_SEGMENTO = {chr(39)}{s}{chr(39)} THEN share END), 0.0)')} AS {s}"
                           for s in ['AUTOMOBILE'] + SEGMENTS)}
FROM sh GROUP BY cluster""",

    "q_score_by_cluster": f"""WITH {BASE_CHAIN}, {CL}, {BC}
SELECT cluster, {r6('avg(NPS_MEDIO)')} AS NPS_MEDIO FROM bc WHERE cluster IS NOT NULL GROUP BY cluster""",

    "q_box_stats": f"""WITH {BASE_CHAIN}, {CL}, {BC},
v AS (SELECT cluster, MRR_12M AS x FROM bc WHERE cluster IS NOT NULL AND MRR_12M IS NOT NULL),
q AS (SELECT cluster, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3, count(*) AS n FROM v GROUP BY cluster)
SELECT q.cluster, q.n,
       {r6('least(min(CASE WHEN v.x >= q.q1 - 1.5 * (q.q3 - q.q1) THEN v.x END), q.q1)')} AS whisker_low,
       {r6('q.q1')} AS q1, {r6('q.median')} AS median, {r6('q.q3')} AS q3,
       {r6('greatest(max(CASE WHEN v.x <= q.q3 + 1.5 * (q.q3 - q.q1) THEN v.x END), q.q3)')} AS whisker_high
FROM q JOIN v ON q.cluster = v.cluster GROUP BY q.cluster, q.n, q.q1, q.median, q.q3""",

    "q_top_features": f"""WITH {FEATURE_CHAIN}, {CL},
prof AS (SELECT cl.cluster, {', '.join(f'avg(f.{c}) AS {c}' for c in MODEL)}
         FROM feats f JOIN cl ON f.CD_CLIENTE = cl.CD_CLIENTE WHERE cl.cluster IS NOT NULL GROUP BY cl.cluster),
var AS ({_var_union('prof', MODEL)})
SELECT feature, {r6('variance', 9)} AS variance FROM var ORDER BY variance DESC NULLS LAST, feature LIMIT 8""",

    "q_personas": f"""WITH {BASE_CHAIN}, {CL}, {BC},
prof AS (SELECT cluster, avg(MRR_12M) AS m, avg(NPS_MEDIO) AS s, avg(QTD_CONTRATACOES_12M) AS a
         FROM bc WHERE cluster IS NOT NULL GROUP BY cluster),
t AS (SELECT quantile_cont(m, 0.33) AS m1, quantile_cont(m, 0.67) AS m2,
             quantile_cont(s, 0.33) AS s1, quantile_cont(s, 0.67) AS s2,
             quantile_cont(a, 0.33) AS a1, quantile_cont(a, 0.67) AS a2 FROM prof),
lab AS (SELECT cluster,
          'Receita ' || {_persona_case('m', 'm1', 'm2')} || ', Satisfação ' || {_persona_case('s', 's1', 's2')}
          || ', Aquisição ' || {_persona_case('a', 'a1', 'a2')} AS cluster_label FROM prof, t)
SELECT bc.CD_CLIENTE, bc.cluster, lab.cluster_label FROM bc LEFT JOIN lab ON bc.cluster = lab.cluster""",

    "q_numeric_columns": f"""WITH {BASE_CHAIN},
br AS (SELECT {', '.join(f"TRY_CAST(replace(replace(regexp_replace(CAST({c} AS VARCHAR), '\\s+', '', 'g'), '.', ''), ',', '.') AS DOUBLE) AS {c}"
                          for c in ['DS_SEGMENTO', 'FAT_FAIXA', 'UF', 'DT_ASSINATURA_CONTRATO'])},
              VL_TOTAL_CONTRATO, MRR_12M, QTD_CONTRATACOES_12M, VLR_CONTRATACOES_12M, NPS_MEDIO FROM base)
{chr(10).join(
    ('UNION ALL ' if i else '') + f"SELECT '{c}' AS column_name, count({c}) AS n_numeric FROM br"
    for i, c in enumerate(['DS_SEGMENTO', 'FAT_FAIXA', 'UF', 'VL_TOTAL_CONTRATO', 'DT_ASSINATURA_CONTRATO',
                           'MRR_12M', 'QTD_CONTRATACOES_12M', 'VLR_CONTRATACOES_12M', 'NPS_MEDIO']))}""",

    "q_assign_nearest": f"""WITH {FEATURE_CHAIN}, {CL},
zc AS (SELECT z.*, cl.cluster FROM z JOIN cl ON z.CD_CLIENTE = cl.CD_CLIENTE),
cen AS (SELECT cluster AS c, {', '.join(f'avg(z_{c}) AS c_{c}' for c in MODEL)} FROM zc GROUP BY cluster),
d AS (SELECT zc.CD_CLIENTE, zc.cluster, cen.c,
             {' + '.join(f'(zc.z_{c} - cen.c_{c}) * (zc.z_{c} - cen.c_{c})' for c in MODEL)} AS dist
      FROM zc, cen),
r AS (SELECT *, row_number() OVER (PARTITION BY CD_CLIENTE ORDER BY dist, c) AS rn FROM d)
SELECT CD_CLIENTE, cluster, c AS nearest FROM r WHERE rn = 1""",

    "q_silhouette": f"""WITH {FEATURE_CHAIN}, {CL},
pts AS (SELECT z.*, cl.cluster, {' + '.join(f'z_{c} * z_{c}' for c in MODEL)} AS sq
        FROM z JOIN cl ON z.CD_CLIENTE = cl.CD_CLIENTE),
st AS (SELECT cluster AS c, count(*) AS n, sum(sq) AS psi, {', '.join(f'sum(z_{c}) AS s_{c}' for c in MODEL)}
       FROM pts GROUP BY cluster),
d AS (SELECT p.CD_CLIENTE, p.cluster, st.c, st.n,
             p.sq + st.psi / st.n - 2.0 * ({' + '.join(f'p.z_{c} * st.s_{c}' for c in MODEL)}) / st.n AS dist
      FROM pts p, st),
ab AS (SELECT CD_CLIENTE, max(CASE WHEN c = cluster THEN dist * n / (n - 1.0) END) AS a,
              max(CASE WHEN c = cluster THEN n END) AS own_n,
              min(CASE WHEN c <> cluster THEN dist END) AS b FROM d GROUP BY CD_CLIENTE),
s AS (SELECT CASE WHEN own_n <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s
      FROM ab)
SELECT {r6('avg(s)')} AS silhouette, count(*) AS n_rows, CAST((SELECT count(*) FROM st) AS BIGINT) AS n_clusters
FROM s""",

    "q_silhouette_euclidean": f"""WITH {FEATURE_CHAIN}, {CL},
pts AS (SELECT z.*, cl.cluster FROM z JOIN cl ON z.CD_CLIENTE = cl.CD_CLIENTE),
n AS (SELECT cluster AS c, count(*) AS n FROM pts GROUP BY cluster),
d AS (SELECT p.CD_CLIENTE, p.cluster, q.cluster AS c,
             sum(sqrt({' + '.join(f'(p.z_{c} - q.z_{c}) * (p.z_{c} - q.z_{c})' for c in MODEL)})) AS total
      FROM pts p, pts q GROUP BY p.CD_CLIENTE, p.cluster, q.cluster),
ab AS (SELECT CD_CLIENTE, cluster, max(CASE WHEN d.c = cluster THEN total / (n.n - 1.0) END) AS a,
              max(CASE WHEN d.c = cluster THEN n.n END) AS own_n,
              min(CASE WHEN d.c <> cluster THEN total / n.n END) AS b FROM d JOIN n ON d.c = n.c GROUP BY CD_CLIENTE, cluster),
s AS (SELECT cluster, CASE WHEN own_n <= 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
SELECT cluster, {r6('avg(s)', 9)} AS silhouette, count(*) AS n_rows FROM s GROUP BY cluster""",

    "q_cohort_model": f"""WITH {BASE_CHAIN}, {TYPED}, {CL},
learn AS (SELECT * FROM typed WHERE MRR_12M IS NOT NULL),
med AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in NUMERIC)} FROM learn), {FILLED}, {FEATS},
fl AS (SELECT f.* FROM feats f JOIN learn l ON f.CD_CLIENTE = l.CD_CLIENTE),
st AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}' for c in MODEL)} FROM fl),
z AS (SELECT f.CD_CLIENTE, {', '.join(f'CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - a_{c}) / s_{c} END AS z_{c}' for c in MODEL)}
      FROM feats f, st),
zc AS (SELECT z.*, cl.cluster, l.CD_CLIENTE IS NOT NULL AS learned FROM z JOIN cl ON z.CD_CLIENTE = cl.CD_CLIENTE
       LEFT JOIN learn l ON z.CD_CLIENTE = l.CD_CLIENTE),
cen AS (SELECT cluster AS c, {', '.join(f'avg(z_{c}) AS c_{c}' for c in MODEL)} FROM zc WHERE learned GROUP BY cluster),
d AS (SELECT zc.CD_CLIENTE, zc.cluster, cen.c,
             {' + '.join(f'(zc.z_{c} - cen.c_{c}) * (zc.z_{c} - cen.c_{c})' for c in MODEL)} AS dist
      FROM zc, cen WHERE NOT learned),
r AS (SELECT *, row_number() OVER (PARTITION BY CD_CLIENTE ORDER BY dist, c) AS rn FROM d)
SELECT CD_CLIENTE, cluster, c AS nearest FROM r WHERE rn = 1""",

    "q_delimited": """SELECT CAST(c_custkey AS VARCHAR) AS k,
       CASE WHEN c_custkey % 10 = 5 THEN NULL WHEN c_custkey % 10 = 6 THEN 'São;' || c_name ELSE 'São ' || c_name END AS name,
       CASE WHEN c_custkey % 10 IN (4, 5, 7) THEN NULL ELSE c_mktsegment END AS segment
FROM customer WHERE c_custkey % 10 <> 3""",

    "q_broken_extract": """SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name, origin,
       'absent,historico,mrr/zz-truncated.csv.gz' AS reported FROM customer, (VALUES ('mrr'), ('tickets')) o(origin)""",
    "q_first_in_file": f"""WITH r AS (
  SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_number FROM orders),
f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY row_number) AS rn FROM r)
SELECT CAST(o_custkey AS VARCHAR) AS CD_CLIENTE, CAST(o_orderkey AS VARCHAR) AS pedido, o_orderstatus AS DS_SEGMENTO,
       {r6('round(o_totalprice, 2)')} AS VL_TOTAL_CONTRATO, row_number FROM f WHERE rn = 1""",
    "q_quoted_breaks": """SELECT CAST(c_custkey AS VARCHAR) AS k,
       CASE WHEN c_custkey % 3 = 0 THEN 'said "' || c_name || '";' || chr(10) || chr(10) || ' k=' || c_custkey || ';' || chr(10)
            ELSE c_name END AS name, c_mktsegment AS segment FROM customer""",
    "q_load_or_build": """SELECT c_custkey AS k, c_name AS name, CAST(2 AS INTEGER) AS builds FROM customer
UNION ALL SELECT -s_suppkey, s_name, 2 FROM supplier""",
    "q_quarantine": f"""SELECT 'built' AS name, NULL AS reason, c_custkey AS who, {r6('c_acctbal')} AS amount
FROM (SELECT DISTINCT c_custkey, c_acctbal FROM customer)
UNION ALL SELECT 'clientes_desde', 'no client key among its columns person, amount', c_custkey, {r6('c_acctbal')} FROM customer
UNION ALL SELECT 'contratacoes', 'no client key among its columns buyer, VLR_CONTRATACOES_12M', o_custkey, {r6('o_totalprice')} FROM orders
UNION ALL SELECT 'mrr', 'nothing to join: no client key in contratacoes', o_custkey, {r6('o_totalprice')} FROM orders""",

    "q_columns_in_list_order": """SELECT c_nationkey, c_name, c_custkey, 'c_nationkey,c_name,c_custkey' AS "order",
'customer lacks required column(s) [''lost'', ''gone'']' AS refused FROM customer""",

    "q_stored_profile": f"""WITH {BASE_CHAIN}, {CL}, {BC},
prof AS (SELECT cluster, {', '.join(f'avg({c}) AS {c}' for c in REPORT_METRICS)} FROM bc WHERE cluster IS NOT NULL GROUP BY cluster),
var AS ({_var_union('prof', REPORT_METRICS)}),
top AS (SELECT feature, {r6('variance', 9)} AS variance FROM var ORDER BY variance DESC NULLS LAST, feature LIMIT 8)
SELECT feature, variance, profile FROM top, (VALUES ('stored'), ('computed')) p(profile)""",

    "q_published": """WITH j AS (SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT c_custkey, n_name, CASE WHEN n_name IS NOT NULL THEN count(*) OVER (PARTITION BY n_name) END AS clients FROM j""",

    "q_sales_many": f"""WITH r AS (SELECT DISTINCT o_custkey AS CLIENTE, o_orderstatus, o_totalprice AS MRR_12M FROM orders
                   WHERE o_orderstatus = 'F'),
c AS (SELECT DISTINCT o_custkey AS ID_CLIENTE, o_orderstatus, o_totalprice AS VLR_CONTRATACOES_12M FROM orders
      WHERE o_orderstatus IS DISTINCT FROM 'F')
SELECT r.CLIENTE, r.CLIENTE AS CD_CLIENTE, r.o_orderstatus AS o_orderstatus_x, {r6('r.MRR_12M')} AS MRR_12M,
       c.ID_CLIENTE, c.o_orderstatus AS o_orderstatus_y, {r6('c.VLR_CONTRATACOES_12M')} AS VLR_CONTRATACOES_12M
FROM r LEFT JOIN c ON r.CLIENTE = c.ID_CLIENTE""",

    "q_tickets_no_duration": f"""SELECT event_id AS BK_TICKET, CAST(0 AS DOUBLE) AS without,
       {r6('CASE WHEN event_id % 3 > 0 THEN coalesce(value, 0.0) ELSE 0.0 END')} AS filled,
       {r6('CASE WHEN event_id % 3 > 0 THEN value END')} AS kept FROM events""",

    "q_quantiles_bracketed": f"""SELECT o_orderstatus, {r6('quantile_cont(o_totalprice, 0.25)')} AS o_totalprice_q0_25,
       {r6('quantile_cont(o_totalprice, 0.5)')} AS o_totalprice_q0_5,
       {r6('quantile_cont(o_totalprice, 0.67)')} AS o_totalprice_q0_67 FROM orders GROUP BY o_orderstatus""",

    "q_kmeans_clusters": """SELECT c_custkey AS CD_CLIENTE, CAST(1 AS BIGINT) AS n_labels, true AS labelled,
       true AS in_range, true AS nearest_own FROM customer""",
    "q_kmeans_scores": """SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM customer) AS clients, true AS consistent
FROM (VALUES (3), (4), (5), (6)) t(k)""",
    "q_kmeans_recommend": """SELECT c_custkey AS CD_CLIENTE, CAST(0 AS BIGINT) AS already_owned,
       CAST(0 AS BIGINT) AS twice, true AS within_n FROM customer""",
    "q_kmeans_profile": f"""WITH {FEATURE_CHAIN}
SELECT {', '.join(f"{r6(f'avg({c})', 9)} AS {c}" for c in MODEL)} FROM feats""",
    "q_kmeans_segments": """SELECT c_mktsegment AS DS_SEGMENTO, count(*) AS QTD FROM customer
WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""",
    "q_kmeans_personas": """SELECT c_custkey AS CD_CLIENTE, 'Receita, Satisfação, Aquisição' AS parts FROM customer""",
    "q_kmeans_top_products": f"""WITH {HIST}
SELECT DS_PROD, count(*) AS QTD FROM hist JOIN customer c ON hist.CD_CLIENTE = c.c_custkey
WHERE DS_PROD IS NOT NULL GROUP BY DS_PROD""",
}
SQL["q_recommend_rows"] = SQL["q_recommend"]
