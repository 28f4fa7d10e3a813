import numpy as np
import pandas as pd
import pytest

from cohortkit.operators.quantiles import exact_quantiles, quantile_literals


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 4000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x": rng.normal(size=n).round(2),
                        "y": (rng.random(n) < 0.3).astype(float)})
    pdf.loc[::7, "x"] = np.nan
    pdf.loc[pdf.g == 2, "x"] = np.nan  # one group all NULL
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("bracket", [1_000_000, 40])  # direct path, bracketed path
def test_grouped_matches_pandas(data, bracket):
    pdf, df = data
    probs = [0.0, 0.25, 0.33, 0.5, 0.67, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, ["g"], bracket=bracket,
                          name=lambda c, p: f"{c}_{probs.index(p)}").toPandas().set_index("g")
    exp = pdf.groupby("g")[["x", "y"]].quantile(probs).unstack()
    for c in ["x", "y"]:
        for i, p in enumerate(probs):
            a = got.loc[exp.index, f"{c}_{i}"].astype(float).values
            b = exp[(c, p)].values
            assert np.allclose(a, b, equal_nan=True, atol=1e-12), (c, p)


def test_global_median_heavy_ties(spark):
    vals = [0.0] * 500 + [1.0] * 200 + [2.0] * 3
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for br in (10, 10_000):
        assert quantile_literals(df, ["v"], [0.5, 0.9], bracket=br)["v"] == [0.0, 1.0]


@pytest.mark.parametrize("bracket", [1_000_000, 40])
def test_literals_match_pandas(data, bracket):
    pdf, df = data
    probs = [0.1, 0.5, 0.67]
    got = quantile_literals(df, ["x", "y"], probs, bracket=bracket)
    for c in ["x", "y"]:
        exp = pdf[c].quantile(probs).values
        assert np.allclose(got[c], exp, atol=1e-12), (c, got[c], exp)
    nulls = quantile_literals(df.where("g = 2"), ["x"], [0.5], bracket=bracket)
    assert nulls == {"x": [None]}
