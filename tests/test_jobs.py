from pathlib import Path

from pyspark.sql import functions as F

from cohortkit.plans import jobs


def test_tickets_duration_discovery_and_counts(spark):
    t = spark.createDataFrame(
        [("o1", "t1", "aberto", "10"), ("o1", "t2", "ABERTO", None), ("o1", "t3", None, "2"),
         ("o2", "t4", "Fechado", "x"), (None, None, None, None)],
        "CODIGO_ORGANIZACAO string, BK_TICKET string, STATUS_TICKET string, `Tempo de Resolução` string")
    out = jobs.tickets_by_org(jobs.tickets(t))
    got = {r.CODIGO_ORGANIZACAO: (r.QTD_CHAMADOS, r.CHAMADOS_ABERTOS, r.TEMPO_MEDIO_RES) for r in out.collect()}
    assert got == {"o1": (3, 2, 4.0), "o2": (1, 0, 0.0)}
    none = spark.createDataFrame([("o", "t", "aberto")], "CODIGO_ORGANIZACAO string, BK_TICKET string, STATUS_TICKET string")
    assert jobs.tickets(none).first().TempoResolucao == 0.0
    assert jobs.tickets(none, on_missing="null").first().TempoResolucao is None


def test_surveys_key_per_source(spark):
    a = spark.createDataFrame([("1", "9")], "CLIENTE string, nps string")
    b = spark.createDataFrame([("2", "7"), ("2", "7")], "IdCliente string, Nota_NPS string")
    out = jobs.surveys({"s1": a, "s2": b})
    got = sorted((r.CD_CLIENTE, r.NPS, r.origem_nps) for r in out.collect())
    assert got == [("1", 9.0, "s1"), ("2", 7.0, "s2")]


def test_clients_quarantine_and_base(spark):
    master = spark.createDataFrame([("1", "S1", "10,5"), ("1", "S1", "10,5"), ("2", "S2", None)],
                                   "CD_CLIENTE string, DS_SEGMENTO string, VL_TOTAL_CONTRATO string")
    since = spark.createDataFrame([("1", "01/02/2020")], "CD_CLI string, DT_ASSINATURA_CONTRATO string")
    hist = spark.createDataFrame([("p",)], "DS_PROD string")  # no key
    r = jobs.clients(master, since, hist)
    assert list(r.quarantined) == ["historico"] and r.frame.count() == 2
    rev = spark.createDataFrame([("1", "100,5")], "IdCliente string, MRR_12M string")
    con = spark.createDataFrame([("1", "2", "30,0"), ("1", "2", "30,0")],
                                "CD_CLIENTE string, QTD_CONTRATACOES_12M string, VLR_CONTRATACOES_12M string")
    s = jobs.sales(rev, con).frame
    assert s.count() == 1 and s.first().MRR_12M == 100.5
    sv = spark.createDataFrame([("1", 8.0), ("1", 10.0), (None, 1.0)], "CD_CLIENTE string, NPS double")
    base = jobs.analytic_base(r.frame, s, sv)
    rows = {x.CD_CLIENTE: x for x in base.collect()}
    assert set(rows) == {"1", "2"} and rows["1"].NPS_MEDIO == 9.0 and rows["2"].MRR_12M is None


def test_run_etl_from_csv_folder(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    w = lambda n, s: (raw / f"{n}.csv").write_bytes(s.encode("latin-1" if "lat" in n else "utf-8"))
    w("nps_relacional", "CD_CLIENTE;nps\n1;9\n2;7\n")
    w("nps_transacional_suporte", "IdCliente;nota_nps\n1;5\n")
    w("tickets", "CODIGO_ORGANIZACAO;BK_TICKET;STATUS_TICKET;tempo_resolucao\nA;1;Aberto;2,5\nA;2;fechado;3\n")
    w("mrr", "CD_CLIENTE;MRR_12M\n1;100,5\n2;50\n")
    w("contratacoes_ultimos_12_meses", "CLIENTE;QTD_CONTRATACOES_12M;VLR_CONTRATACOES_12M\n1;2;30,0\n")
    w("dados_clientes", "CD_CLIENTE;DS_SEGMENTO;FAT_FAIXA\n1;Varejo;A\n2;Logística;B\n")
    w("clientes_desde", "CD_CLIENTE;DT_ASSINATURA_CONTRATO\n1;01/02/2020\n")
    w("historico", "CD_CLIENTE;DS_PROD\n1;ERP\n2;CRM\n")
    w("telemetria_1", "CD_CLI;evento\n1;login\n")
    out = jobs.run_etl(spark, str(raw), str(tmp_path / "out"))
    assert "skipped:nps_transacional_aquisicao" in out and "base_analitica" in out
    base = spark.read.parquet(out["base_analitica"])
    rows = {r.CD_CLIENTE: r for r in base.collect()}
    assert rows["1"].NPS_MEDIO == 7.0 and rows["1"].MRR_12M == 100.5 and rows["2"].DS_SEGMENTO == "Logística"
    org = spark.read.parquet(out["tickets_agg_organizacao"]).first()
    assert (org.QTD_CHAMADOS, org.CHAMADOS_ABERTOS) == (2, 1)


def test_load_or_build(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3).withColumn("v", F.col("id") * 2)
    p = str(tmp_path / "b")
    assert jobs.load_or_build(spark, p, build).count() == 3
    assert jobs.load_or_build(spark, p, build).count() == 3
    assert len(calls) == 1


def test_run_all_on_driver_tables(spark, tmp_path):
    from cohortkit.plans.cohort_run import run_all
    paths = run_all(spark, "/root/testdata/sf0.001", str(tmp_path / "out"), ks=(3, 4))
    recs = spark.read.parquet(paths["recomendacoes_por_cliente"])
    base = spark.read.parquet(paths["base_analitica"])
    assert recs.count() == base.count() == base.select("CD_CLIENTE").distinct().count()
    for name in ("cluster_sizes", "top_products", "personas", "top_features", "score_by_cluster",
                 "box_stats", "segment_mix", "metricas_medias", "segmento_contagem", "k_scores"):
        assert spark.read.parquet(paths[name]).count() > 0, name


def test_command_line_etl(spark, tmp_path, capsys):
    import json

    from cohortkit.__main__ import main
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "dados_clientes.csv").write_text("CLIENTE;DS_SEGMENTO\n1;A\n2;B\n")
    (raw / "clientes_desde.csv").write_text("CD_CLIENTE;DT_ASSINATURA_CONTRATO\n1;01/02/2020\n")
    (raw / "historico.csv").write_text("CD_CLIENTE;DS_PROD\n1;X\n")
    main(["--master", "local[2]", "etl", str(raw), str(tmp_path / "out")])
    out = json.loads(capsys.readouterr().out)
    assert spark.read.parquet(out["base_analitica"]).count() == 2
    assert "skipped:nps_relacional" in out


def test_absent_extracts_are_reported_and_the_rest_is_built(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "dados_clientes.csv").write_text("CLIENTE;DS_SEGMENTO;VL_TOTAL_CONTRATO\n1;A;1234.5\n2;B;999,9\n")
    (raw / "mrr.csv").write_text("CLIENTE;MRR_12M\n1;10\n")
    (raw / "telemetria_1.csv").write_text("CLIENTE;x\n1;2\n")
    out = jobs.run_etl(spark, str(raw), str(tmp_path / "out"))
    for name in ("historico", "clientes_desde", "contratacoes_ultimos_12_meses", "tickets", "telemetria_2"):
        assert f"skipped:{name}" in out
    assert "missing:vendas_tratado" in out
    base = {r.CD_CLIENTE: r for r in spark.read.parquet(out["base_analitica"]).collect()}
    assert (base["1"].VL_TOTAL_CONTRATO, base["2"].VL_TOTAL_CONTRATO) == (1234.5, 999.9)
    assert [r.fonte for r in spark.read.parquet(out["telemetria_tratado"]).collect()] == ["telemetria_1.csv"]


def test_load_or_build_does_not_overwrite_what_it_cannot_read(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    (tmp_path / "empty").mkdir()  # a folder without a table: there, but of no schema
    with pytest.raises(AnalysisException):
        jobs.load_or_build(spark, str(tmp_path / "empty"), lambda: spark.range(1))
    assert not list((tmp_path / "empty").iterdir())


def test_events_of_other_types_stay(spark):
    from cohortkit.sources import tables as T
    kinds = {None, *T.SURVEY_LAYOUT}
    rows = spark.createDataFrame([(t,) for t in ["view", "other", "longer type", None]], "event_type string")
    found = [rows.where(T._of_type(t, T.SURVEY_LAYOUT)).count() for t in kinds]
    assert sum(found) == 4 and rows.where(T._of_type(None, T.SURVEY_LAYOUT)).count() == 3


def test_one_hot_past_a_thousand_levels(spark):
    from cohortkit.operators.features import one_hot
    df = spark.range(1100).selectExpr("id", "concat('l', id) AS c")
    out, names = one_hot(df, ["c"])
    assert len(names) == 1099 and out.filter("id = 7").first()["c_l7"] == 1.0


def test_each_quarantined_table_has_its_reason(spark):
    keyed = spark.createDataFrame([("1", "5,0")], "CLIENTE string, MRR_12M string")
    other = spark.createDataFrame([("x",)], "produto string")
    r = jobs.sales(keyed, other)
    assert r.frame is None and set(r.reasons) == set(r.quarantined) == {"mrr", "contratacoes"}
    assert r.reasons["contratacoes"] == "no client key among its columns produto" and "contratacoes" in r.reasons["mrr"]
    r = jobs.sales(other, keyed)
    assert r.reasons["mrr"].endswith("produto") and r.reasons["contratacoes"].endswith("no client key in mrr")
    r = jobs.sales(other, other)
    assert all(x.endswith("columns produto") for x in r.reasons.values())
    r = jobs.clients(other, keyed, keyed)
    assert r.frame is None and set(r.reasons) == {"dados_clientes"}
    r = jobs.clients(keyed, keyed, None)
    assert r.reasons == {} and r.frame.count() == 1
