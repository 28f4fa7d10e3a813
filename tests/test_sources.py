from pathlib import Path

from cohortkit.sources import file_encodings, quarantine, read_delimited, read_sources, write_table


def _write(p: Path, data: bytes) -> str:
    p.write_bytes(data)
    return str(p)


def test_ragged_lines(spark, tmp_path):
    path = _write(tmp_path / "r.csv", b'a;b;c\n1;x;2\n3;;\n4\n5;"q;z";6\n6;w;7;extra\n')
    rows = read_delimited(spark, path).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", "x", "2"), ("3", None, None), ("4", None, None),
                                        ("5", "q;z", "6")]


def test_encoding_split_per_file(spark, tmp_path):
    d = tmp_path / "enc"
    d.mkdir()
    _write(d / "u.csv", "k;city\n1;São Paulo\n".encode("utf-8"))
    _write(d / "l.csv", "k;city\n2;São Paulo\n".encode("latin-1"))
    enc = file_encodings(spark, str(d))
    assert sorted(enc.values()) == ["latin-1", "utf-8"]
    rows = read_delimited(spark, str(d)).orderBy("k").collect()
    assert [r.city for r in rows] == ["São Paulo", "São Paulo"]


def test_missing_sources_are_reported(spark, tmp_path):
    _write(tmp_path / "one.csv", b"k;v\n1;2\n")
    frames, skipped = read_sources(spark, str(tmp_path), ["one", "two"])
    assert list(frames) == ["one"] and list(skipped) == ["two"]
    frames, skipped = read_sources(spark, str(tmp_path), ["x", "y"])
    assert frames == {} and set(skipped) == {"x", "y"}


def test_write_and_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    p = write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(p).count() == 1
    q = quarantine(df, str(tmp_path), "bad")
    assert q.endswith("quarantine/bad") and spark.read.parquet(q).count() == 1
    c = write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", True).csv(c).columns == ["k", "v"]


def test_case_insensitive_header_collisions(spark, tmp_path):
    path = _write(tmp_path / "d.csv", b"k;NPS;nps;k\n1;9;8;x\n")
    df = read_delimited(spark, path)
    assert df.columns == ["k", "NPS", "nps__2", "k__2"]
    r = df.first()
    assert (r["NPS"], r["nps__2"], r["k__2"]) == ("9", "8", "x")


def test_missing_words_and_quoted_empties(spark, tmp_path):
    path = _write(tmp_path / "n.csv", b'k;v;w\n1;NA;null\n2;"";N/A\n3;nan;x\n4;Nada;NAN\n')
    rows = read_delimited(spark, path).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("1", None, None), ("2", None, None), ("3", None, "x"), ("4", "Nada", "NAN")]


def test_long_line_with_empty_tail_is_skipped(spark, tmp_path):
    path = _write(tmp_path / "t.csv", b'k;v;w\n1;a;b\n3;x;y;\n4;"p;q";r\n5;"p;q";r;\n6;;\n7\n')
    assert [r.k for r in read_delimited(spark, path).orderBy("k").collect()] == ["1", "4", "6", "7"]


def test_header_order_per_file(spark, tmp_path):
    d = tmp_path / "orders"
    d.mkdir()
    _write(d / "a.csv", b"k;v\n1;x\n")
    _write(d / "b.csv", b"v;k;z\ny;2;9\n")
    rows = sorted(tuple(r) for r in read_delimited(spark, str(d)).select("k", "v", "z").collect())
    assert rows == [("1", "x", None), ("2", "y", "9")]


def test_rows_do_not_depend_on_the_columns_asked_for(spark, tmp_path):
    path = _write(tmp_path / "r.csv", b'a;b;c\n1;x;2\n3;;\n4\n5;"q;z";6\n6;w;7;extra\n')
    for mode in (False, True, "split"):
        df = read_delimited(spark, path, multi_line=mode)
        assert df.count() == 4 and [r.a for r in df.select("a").orderBy("a").collect()] == ["1", "3", "4", "5"]
        assert df.where("b IS NOT NULL").select("c").count() == 2


def test_quarantined_rows_say_why(spark, tmp_path):
    df = spark.createDataFrame([(1, "mine"), (2, None)], "k long, Quarantine_Reason string")
    back = spark.read.parquet(quarantine(df, str(tmp_path), "bad", reason="no key"))
    assert back.columns == ["k", "quarantine_reason_x", "quarantine_reason"]
    assert sorted(map(tuple, back.collect())) == [(1, "mine", "no key"), (2, None, "no key")]
    none = spark.read.parquet(quarantine(df.limit(0), str(tmp_path), "none", reason="no key"))
    assert none.count() == 0 and "quarantine_reason" in none.columns
