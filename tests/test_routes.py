"""Extracts that are parts of one table, read in one scan; extracts that break off."""

import gzip

from pyspark.sql import functions as F

from cohortkit.operators.cluster import fit_best_k
from cohortkit.operators.relational import Routed, drop_empty, union_sources
from cohortkit.plans import jobs
from cohortkit.sources import read_sources
from cohortkit.sources import tables as T

SF = "/root/testdata/sf0.001"


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_one_scan_and_the_same_rows(spark):
    for job, sources in ((jobs.surveys, T.survey_sources(spark, SF)), (jobs.telemetry, T.telemetry_sources(spark, SF))):
        one, many = job(sources), job(sources.frames())
        assert scans(one) == 1 and scans(many) == len(sources.routes)
        assert set(one.columns) == set(many.columns)
        cols = sorted(one.columns)
        assert one.select(cols).exceptAll(many.select(cols)).isEmpty() and many.select(cols).exceptAll(one.select(cols)).isEmpty()


def test_rows_of_no_source_of_several_and_without_values(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "a", None)], "id int, t string, v double")
    routed = Routed(df, {"x": (F.col("t") == "a", {"CLIENTE": F.col("id"), "w": F.col("v")}),
                         "y": (F.col("t").isin("a", "b"), {"IdCliente": F.col("id").cast("string")})})
    got = sorted(map(tuple, routed.union("o").select("CLIENTE", "w", "IdCliente", "o").collect()), key=repr)
    want = union_sources({n: drop_empty(d) for n, d in routed.frames().items()}, "o").select("CLIENTE", "w", "IdCliente", "o")
    assert got == sorted(map(tuple, want.collect()), key=repr) and len(got) == 3


def test_broken_files_are_reported_and_the_rest_is_read(spark, tmp_path):
    good = gzip.compress(("k;v\n" + "".join(f"{i};x\n" for i in range(5000))).encode())
    (tmp_path / "one.csv").mkdir()
    (tmp_path / "one.csv" / "a.csv.gz").write_bytes(good)
    (tmp_path / "one.csv" / "b.csv.gz").write_bytes(good[:len(good) // 2])
    (tmp_path / "one.csv" / "c.csv").write_text("v;k\ny;9\n")
    (tmp_path / "two.csv").mkdir()
    (tmp_path / "two.csv" / "a.csv.gz").write_bytes(good[:50])
    (tmp_path / "three.csv").write_bytes(b"")
    (tmp_path / "four.csv").write_text("k;v\n1;2\n")
    frames, skipped = read_sources(spark, str(tmp_path), ["one", "two", "three", "four", "five"])
    assert set(frames) == {"one", "four"} and frames["one"].count() == 5001
    assert set(skipped) == {"one/b.csv.gz", "two", "three", "five"}
    assert skipped["three"] == "no lines" and "EOFException" in skipped["one/b.csv.gz"] and "EOFException" in skipped["two"]


def test_etl_writes_what_it_could_not_use(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "dados_clientes.csv").write_text("CLIENTE;DS_SEGMENTO\n1;A\n")
    (raw / "historico.csv").write_text("produto\nx\n")
    out = jobs.run_etl(spark, str(raw), str(tmp_path / "out"))
    report = {(r["kind"], r["name"]): r["reason"] for r in spark.read.parquet(out["extract_report"]).collect()}
    assert ("skipped", "tickets") in report and ("missing", "vendas_tratado") in report
    assert report[("quarantine", "historico")].endswith("quarantine/historico")


def test_starts_are_reported_with_their_costs(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(200).selectExpr("id AS CD_CLIENTE", "cast(id % 7 as double) a", "cast(id % 11 as double) b")
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    best = fit_best_k(feats, ks=(2, 3), n_starts=3, partitions=3)
    for s in best.scores:
        assert len(s["starts"]) == 3 and s["cost"] == min(s["starts"])
