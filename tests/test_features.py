import numpy as np

from cohortkit.operators.features import impute_median, one_hot, prepare_features, standardise


def test_impute_median_drops_all_null(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 4.0, None), (4, 10.0, None)],
                               "k long, a double, b double")
    out, med, dropped = impute_median(df, ["a", "b"])
    assert dropped == ["b"] and med == {"a": 4.0}
    assert [r.a for r in out.orderBy("k").collect()] == [1.0, 4.0, 4.0, 10.0]
    assert "b" not in out.columns


def test_one_hot_sorted_first_dropped_null_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "s string")
    out, names = one_hot(df, ["s"])
    assert names == ["s_b", "s_c"]
    got = [(r.s, r.s_b, r.s_c) for r in out.collect()]
    assert got == [("b", 1.0, 0.0), ("a", 0.0, 0.0), (None, 0.0, 0.0), ("c", 0.0, 1.0)]


def test_standardise_population_sd_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    out, _ = standardise(df, ["a", "c"])
    a = np.array([1.0, 2.0, 4.0])
    exp = (a - a.mean()) / a.std(ddof=0)
    got = [r.a for r in out.collect()]
    assert np.allclose(got, exp) and [r.c for r in out.collect()] == [0.0, 0.0, 0.0]


def test_prepare_features_end_to_end(spark):
    base = spark.createDataFrame(
        [(1, "A", "x", "1.000,5", "01/02/2020"), (2, "B", "y", None, "2019-12-31"),
         (3, "A", None, "10", "bad")],
        "CD_CLIENTE long, DS_SEGMENTO string, FAT_FAIXA string, MRR_12M string, "
        "DT_ASSINATURA_CONTRATO string")
    f = prepare_features(base, "2021-01-01")
    assert f.names == ["MRR_12M", "ANTIGUIDADE_MESES", "DS_SEGMENTO_B", "FAT_FAIXA_y"]
    assert f.medians["MRR_12M"] == (1000.5 + 10) / 2
    rows = {r.CD_CLIENTE: r for r in f.frame.collect()}
    assert rows[2].MRR_12M == (1000.5 + 10) / 2
    assert len(rows[1].features) == 4
