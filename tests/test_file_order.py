"""Row numbers in file order, and records with line breaks read by many tasks."""

import random

import pytest

from cohortkit import spec
from cohortkit.operators.relational import first_per_key
from cohortkit.plans import jobs
from cohortkit.sources import read_delimited
from cohortkit.sources.quoted import ends_inside


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_follow_the_files(spark, tmp_path, small_splits):
    d = tmp_path / "x"
    d.mkdir()
    rng = random.Random(1)
    lines = [f"{rng.randrange(20)};v{i}" + (";long" if i % 11 == 3 else "") for i in range(300)]
    (d / "a.csv").write_text("k;v\n" + "\n".join(lines[:180]) + "\n")
    (d / "b.csv").write_bytes("v;k;w\nv180;São;1\n".encode("latin-1"))
    (d / "c.csv").write_text("k;v\n" + "\n".join(lines[181:]))
    df = read_delimited(spark, str(d), row_number="row")
    kept = [x.split(";")[1] for i, x in enumerate(lines) if i == 180 or i % 11 != 3]
    rows = df.orderBy("row").collect()
    assert [(r.row, r.v) for r in rows] == list(enumerate(kept))
    assert sorted(df.columns) == ["k", "row", "v", "w"]
    assert spark.read.text(str(d)).selectExpr("_metadata.file_block_start AS b").distinct().count() > 5
    first = {r.k: r.v for r in first_per_key(df, "k", ["row"]).collect()}
    want = {}
    for r in rows:
        want.setdefault(r.k, r.v)
    assert first == want


def test_base_keeps_the_first_row_as_read(spark, tmp_path, small_splits):
    raw = tmp_path / "raw"
    raw.mkdir()
    many = "".join(f"{i};S{i};{1000 - i}\n" for i in range(3, 90))
    (raw / "dados_clientes.csv").write_text("CD_CLIENTE;DS_SEGMENTO;VL_TOTAL_CONTRATO\n2;Z;9\n1;Y;8\n" + many + "1;A;1\n2;Z;9\n2;B;2\n")
    (raw / "clientes_desde.csv").write_text("CLIENTE;DT_ASSINATURA_CONTRATO\n1;05/05/2020\n2;01/01/2020\n1;01/01/2010\n")
    (raw / "historico.csv").write_text("CD_CLI;DS_PROD\n1;P\n")
    (raw / "mrr.csv").write_text("CD_CLIENTE;MRR_12M\n1;7\n1;3\n2;5\n")
    (raw / "contratacoes_ultimos_12_meses.csv").write_text("CD_CLIENTE;QTD_CONTRATACOES_12M\n1;9\n1;4\n")
    out = jobs.run_etl(spark, str(raw), str(tmp_path / "out"), file_order=True)
    rows = {r.CD_CLIENTE: r for r in spark.read.parquet(out["base_analitica"]).collect()}
    assert (rows["1"].DS_SEGMENTO, rows["1"].DT_ASSINATURA_CONTRATO, rows["1"].MRR_12M, rows["1"].QTD_CONTRATACOES_12M) == ("Y", "05/05/2020", 7.0, 9.0)
    assert (rows["2"].DS_SEGMENTO, rows["2"].MRR_12M) == ("Z", 5.0) and len(rows) == 89
    assert not [c for c in spark.read.parquet(out["base_analitica"]).columns if c.startswith(spec.ROW_ORDER)]
    plain = jobs.run_etl(spark, str(raw), str(tmp_path / "out2"))
    assert {r.CD_CLIENTE: r.DS_SEGMENTO for r in spark.read.parquet(plain["base_analitica"]).collect()}["1"] == "A"


def test_quote_states():
    for line, out, inside in (("a;b", False, True), ('a;"b', True, False), ('"a;b";c', False, False), ('a;"b""c', True, False),
                              ('a"b;c', False, False), ('"', True, False), ('""', False, True), ('x";"y', True, True), ('""";"', False, True)):
        assert (ends_inside(line, False, ";"), ends_inside(line, True, ";")) == (out, inside), line


def table(rng, n):
    """Records as text: breaks, doubled quotes, separators and empty lines in quotes, some of them long."""
    for i in range(n):
        kind = rng.randrange(8)
        if kind == 0:
            yield f'{i};"a\nb;""q""\n\n{"x" * rng.randrange(200)}\n";c'
        elif kind == 1:
            yield f'{i};"";""""'
        elif kind == 2:
            yield f"{i};only"
        elif kind == 3:
            yield f"{i};too;many;fields"
        elif kind == 4:
            yield f'"{i}";"\n";"\n;\n"'
        elif kind == 5:
            yield ""
        else:
            yield f"{i};plain {i};São"


@pytest.mark.parametrize("seed,newline,encoding", [(1, "\n", "utf-8"), (2, "\r\n", "utf-8"), (3, "\n", "latin-1")])
def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, small_splits, seed, newline, encoding):
    text = "\n".join(["k;v;w", *table(random.Random(seed), 200)]) + "\n"
    path = tmp_path / "t.csv"
    path.write_bytes(text.replace("\n", newline).encode(encoding))
    want = read_delimited(spark, str(path), multi_line=True)
    got = read_delimited(spark, str(path), multi_line="split", row_number="row")
    rows = got.orderBy("row").collect()
    assert [tuple(r)[:3] for r in rows] == [tuple(r) for r in want.collect()]
    assert len(rows) > 100 and any(r.v and "\n\n" in r.v for r in rows)
    assert len({r.row for r in rows}) == len(rows)


@pytest.mark.parametrize("shift", range(0, 256, 51))
def test_breaks_at_every_place_of_a_block_edge(spark, tmp_path, small_splits, shift):
    (tmp_path / "t.csv").write_text("k;v\n" + "p" * shift + ';"' + "\n" * 260 + '""x\n"\n' + "".join(f'{i};"\n"\n' for i in range(20)) + 'end;"open\nend')
    want = [tuple(r) for r in read_delimited(spark, str(tmp_path / "t.csv"), multi_line=True).collect()]
    got = read_delimited(spark, str(tmp_path / "t.csv"), multi_line="split", row_number="row").orderBy("row").collect()
    assert [tuple(r)[:2] for r in got] == want and len(want) == 22


def test_split_reader_of_empty_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("k;v\n")
    assert read_delimited(spark, str(tmp_path / "h.csv"), multi_line="split").count() == 0
    assert read_delimited(spark, str(tmp_path / "h.csv"), multi_line="split", row_number="n").columns == ["k", "v", "n"]
