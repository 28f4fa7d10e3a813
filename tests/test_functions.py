import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortkit.functions import (bucket3, find_duration_column, is_open_status, parse_date,
                                 parse_number, rename_clashes, require_columns, resolve_score,
                                 select_present, tenure_months, to_double, unify_key)


def test_parse_number_styles(spark):
    vals = ["1.234,56", "1234,5", "1 234,5", "abc", "", "nan", "1.0d", None, "12.5", "-3"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = df.select(parse_number("x", "br").alias("br"), parse_number("x", "comma").alias("cm"),
                    parse_number("x", "plain").alias("pl")).collect()
    assert [r.br for r in got] == [1234.56, 1234.5, 1234.5, None, None, None, None, None, 125.0, -3.0]
    assert [r.cm for r in got] == [None, 1234.5, None, None, None, None, None, None, 12.5, -3.0]
    assert [r.pl for r in got] == [None, None, None, None, None, None, None, None, 12.5, -3.0]


def test_to_double_switches_on_type_and_drops_nan(spark):
    df = spark.createDataFrame([(1.5, "2,5"), (float("nan"), "x")], "a double, b string")
    r = df.select(to_double(df, "a").alias("a"), to_double(df, "b", "br").alias("b")).collect()
    assert (r[0].a, r[0].b) == (1.5, 2.5)
    assert (r[1].a, r[1].b) == (None, None)


def test_parse_date_explicit_formats_and_tenure(spark):
    df = spark.createDataFrame([("03/04/2020",), ("2020-02-01",), ("31/12/2019",), ("xx",)], "d string")
    df = df.withColumn("p", parse_date(df, "d"))
    got = [r.p for r in df.collect()]
    assert got == [dt.date(2020, 4, 3), dt.date(2020, 2, 1), dt.date(2019, 12, 31), None]
    t = df.select(tenure_months(F.col("p"), "2021-01-01").alias("t")).collect()
    assert t[0].t == round(273 / 30.44, 1)
    assert t[3].t is None


def test_unify_key_preference_and_noop(spark):
    df = spark.createDataFrame([(1, 2)], "CD_CLI long, IdCliente long")
    assert unify_key(df).first().CD_CLIENTE == 2  # IdCliente precedes CD_CLI
    df2 = spark.createDataFrame([(7, 8)], "CD_CLIENTE long, CLIENTE long")
    assert unify_key(df2).columns == ["CD_CLIENTE", "CLIENTE"]
    df3 = spark.createDataFrame([(1,)], "other long")
    assert unify_key(df3).columns == ["other"]


def test_resolve_score_first_in_table_order_and_clash(spark):
    # pandas would keep NPS and nps side by side; Spark names are
    # case-insensitive, so that collision is an error here
    with pytest.raises(ValueError):
        resolve_score(spark.createDataFrame([(1.0, 2.0)], "Nota_NPS double, nps double"))
    df = spark.createDataFrame([(1.0, 2.0)], "x double, Nota_NPS double")
    assert resolve_score(df).columns == ["x", "NPS"]
    df2 = spark.createDataFrame([(1.0,)], "RESPOSTA_NPS double")
    assert resolve_score(df2).columns == ["NPS"]
    with pytest.raises(ValueError):
        resolve_score(spark.createDataFrame([(1.0, 2.0)], "nota_nps double, NPS double"))


def test_find_duration_column():
    assert find_duration_column(["a", "Tempo de Resolução", "b"]) == "Tempo de Resolução"
    assert find_duration_column(["tempo_res"]) == "tempo_res"
    assert find_duration_column(["x", "y"]) is None


def test_select_present_orders(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c long, a long, CD_CLIENTE long")
    assert select_present(df, ["CD_CLIENTE", "a"], "table").columns == ["a", "CD_CLIENTE"]
    assert select_present(df, ["CD_CLIENTE", "a"], "list").columns == ["CD_CLIENTE", "a"]
    assert select_present(df, ["zz"], "table").columns == ["CD_CLIENTE"]
    with pytest.raises(ValueError):
        require_columns(df, "zz")


def test_rename_clashes(spark):
    l = spark.createDataFrame([(1, 2)], "k long, v long")
    r = spark.createDataFrame([(1, 3)], "k long, v long")
    l2, r2 = rename_clashes(l, r, ["k"])
    assert l2.columns == ["k", "v_x"] and r2.columns == ["k", "v_y"]


def test_open_status_case_insensitive(spark):
    df = spark.createDataFrame([("aberto",), ("ABERTO",), (None,), ("Fechado",)], "s string")
    assert df.where(is_open_status(F.col("s"))).count() == 2


def test_bucket3_order_of_tests(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,), (3.0,)], "v double")
    got = [r.b for r in df.select(bucket3(F.col("v"), F.lit(2.0), F.lit(4.0)).alias("b")).collect()]
    assert got == ["Médio", "Baixo", "Alto", "Médio"]
    eq = [r.b for r in df.select(bucket3(F.col("v"), F.lit(3.0), F.lit(3.0)).alias("b")).collect()]
    assert eq == ["Médio", "Baixo", "Alto", "Baixo"]
