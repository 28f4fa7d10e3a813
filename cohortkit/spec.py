"""Column contract and defaults.

Everything in the FIXED VALUES block must equal the source project's names and
constants for outputs to line up with it; every function takes them as
parameters, so other deployments can pass their own.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source project's for matching results)
# ---------------------------------------------------------------------------

# Canonical client key and its aliases, in preference order.
KEY = "CD_CLIENTE"
KEY_ALIASES = (
    "CD_CLIENTE",
    "CLIENTE",
    "IdCliente",
    "ID_CLIENTE",
    "COD_CLIENTE",
    "CODIGO_CLIENTE",
    "CD_CLI",
    "metadata_codcliente",
)

# Survey score: any column whose lower-case name is one of these is the score.
SCORE_ALIASES = ("nps", "resposta_nps", "nota_nps")
SCORE = "NPS"
SCORE_MEAN = "NPS_MEDIO"

# Survey and telemetry extracts, and the provenance column each one gets.
SURVEY_SOURCES = (
    "nps_relacional",
    "nps_transacional_aquisicao",
    "nps_transacional_implantacao",
    "nps_transacional_onboarding",
    "nps_transacional_produto",
    "nps_transacional_suporte",
)
SURVEY_ORIGIN = "origem_nps"
TELEMETRY_SOURCES = tuple(f"telemetria_{i}" for i in range(1, 12))
TELEMETRY_ORIGIN = "fonte"
EXTRACT_SUFFIX = ".csv"
SALES_SOURCES = ("mrr", "contratacoes_ultimos_12_meses")
CLIENT_SOURCES = ("dados_clientes", "clientes_desde", "historico")

# Client master columns kept in the analytic base (in this order of preference).
CLIENT_COLUMNS = (
    "CD_CLIENTE",
    "DS_SEGMENTO",
    "DS_SUBSEGMENTO",
    "FAT_FAIXA",
    "UF",
    "CIDADE",
    "VL_TOTAL_CONTRATO",
    "DT_ASSINATURA_CONTRATO",
)
SEGMENT = "DS_SEGMENTO"
BAND = "FAT_FAIXA"
CONTRACT_VALUE = "VL_TOTAL_CONTRATO"
SIGNED = "DT_ASSINATURA_CONTRATO"

# Sales columns kept in the analytic base.
MRR = "MRR_12M"
N_CONTRACTS = "QTD_CONTRATACOES_12M"
CONTRACTS_VALUE = "VLR_CONTRATACOES_12M"
SALES_COLUMNS = ("CD_CLIENTE", MRR, N_CONTRACTS, CONTRACTS_VALUE)

# Tickets.
ORG = "CODIGO_ORGANIZACAO"
TICKET = "BK_TICKET"
STATUS = "STATUS_TICKET"
OPEN_STATUS = "ABERTO"
DURATION = "TempoResolucao"
TICKETS_OUT = ("QTD_CHAMADOS", "CHAMADOS_ABERTOS", "TEMPO_MEDIO_RES")
# Duration column discovery: accent folding pairs, then the name tests
# ("resolucao" in name) or ("tempo" in name and "res" in name).
ACCENT_FROM = "çãõéó"
ACCENT_TO = "caoeo"
DURATION_STEM = "resolucao"
DURATION_WORDS = ("tempo", "res")

# Features for clustering, in this order; tenure is derived from SIGNED.
TENURE = "ANTIGUIDADE_MESES"
DAYS_PER_MONTH = 30.44
FEATURES = (MRR, N_CONTRACTS, CONTRACTS_VALUE, SCORE_MEAN, CONTRACT_VALUE, TENURE)
CATEGORICAL = (SEGMENT, BAND)
# Day-first date text first, ISO second; each also with a time of day.
DATE_FORMATS = (
    "d/M/yyyy",
    "yyyy-MM-dd",
    "d/M/yyyy H:mm[:ss]",
    "yyyy-MM-dd H:mm[:ss][.SSSSSS][.SSS]",
    "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][.SSS]",
)

# Clustering.
CLUSTER = "cluster"
K_GRID = (3, 4, 5, 6)
SEED = 42

# Recommendation.
PRODUCT = "DS_PROD"
QTY = "QTD"
RECOMMENDATIONS = "RECOMENDACOES"
TOP_N_CLIENT = 3
TOP_N_CLUSTER = 10
TOP_N_FEATURES = 8
LIST_SEP = ", "

# Personas: metric columns the profile averages, then the labelled parts.
PERSONA_METRICS = (MRR, SCORE_MEAN, N_CONTRACTS, CONTRACTS_VALUE, CONTRACT_VALUE)
PERSONA_PARTS = (
    (MRR, "Receita"),
    (SCORE_MEAN, "Satisfação"),
    (N_CONTRACTS, "Aquisição"),
)
PERSONA_LEVELS = ("Baixo", "Médio", "Alto")
TERCILES = (0.33, 0.67)
LABEL = "cluster_label"
BOX_WHISKER = 1.5

# ---------------------------------------------------------------------------
# Engineering defaults (not source-project values)
# ---------------------------------------------------------------------------

# Largest side we broadcast by explicit hint, in rows, after counting it.
BROADCAST_ROWS = 200_000
# ... and in bytes as stored.
BROADCAST_BYTES = 32 * 1024 * 1024
# Largest bracket of values gathered per group for an exact quantile.
QUANTILE_BRACKET = 200_000
# K-means input layout: one partition per this many rows, and this many at
# least. The count follows the data, not the cluster, so the same data always
# gets the same layout (repeatable fits) and spreads over many tasks.
KMEANS_ROWS_PER_PARTITION = 50_000
KMEANS_LEAST_PARTITIONS = 16
# Default of ``points``, which the Euclidean silhouette still takes; it counts all rows.
SILHOUETTE_POINTS = 1024
# Columns of a row's place in its extract (prefix: one per joined extract).
ROW_ORDER = "__row"
# K-means fits and scores that run side by side.
PARALLEL_FITS = 4
