"""Many levels as sparse vectors: the numbers of the dense form, and plans that do not grow."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector

from cohortkit.operators.features import one_hot
from cohortkit.operators.wide import level_table, wide_features


def frame(spark, n=400):
    rng = np.random.default_rng(5)
    rows = [(i, [None, "a", "b", "ç", "z", "B"][rng.integers(6)], f"l{rng.integers(40):02d}" if i % 9 else None, "one", float(i % 13)) for i in range(n)]
    return spark.createDataFrame(rows, "CD_CLIENTE long, s string, t string, u string, x double")


def test_entries_are_those_of_the_columns(spark):
    df = frame(spark)
    dense, names = one_hot(df, ["s", "t", "u"])
    want = {r.CD_CLIENTE: [r.x, *[r[n] for n in names]] for r in dense.collect()}
    plain = wide_features(df, ["s", "t", "u"], ["x"], standardised=False)
    assert plain.width == 1 + len(names) and plain.sizes == {"s": 5, "t": 40, "u": 1}
    got = {r[0]: r[1] for r in plain.frame.select("CD_CLIENTE", vector_to_array("features")).collect()}
    assert got == want
    x = np.array([want[i] for i in range(len(want))])
    sd = x.std(0)
    got = {r[0]: r[1] for r in wide_features(df, ["s", "t", "u"], ["x"]).frame.select("CD_CLIENTE", vector_to_array("features")).collect()}
    z = np.array([got[i] for i in range(len(want))])
    assert np.allclose(z[:, 1:], x[:, 1:] / sd[1:], atol=1e-12)


def test_places_and_edges(spark):
    df = frame(spark)
    out = wide_features(df, ["s", "t"])
    for r in out.frame.select("s", "t", "s__place", "t__place", "features").collect():
        on = sorted(p for p in (r["s__place"], r["t__place"]) if p is not None)
        assert sorted(np.flatnonzero(r.features.toArray()).tolist()) == on
        assert (r["s__place"] is None) == (r.s in (None, "B"))
    empty = wide_features(df.limit(0), ["s"], ["x"])
    assert empty.frame.count() == 0 and empty.width == 1
    assert level_table(df, ["u"]).collect()[0].place == 0


def test_a_hundred_thousand_levels(spark):
    plans = []
    for n in (1000, 100_000):
        df = spark.range(n).selectExpr("id AS CD_CLIENTE", "concat('level', id) AS c", "cast(id % 5 as double) x")
        out = wide_features(df, ["c"], ["x"])
        assert out.width == n
        r = out.frame.where("CD_CLIENTE = 77").first()
        assert isinstance(r.features, SparseVector) and r.features.size == n and len(r.features.indices) == 2
        plans.append(len(out.frame._jdf.queryExecution().optimizedPlan().toString()))
    assert plans[1] < 1.2 * plans[0]


def test_distances_are_those_of_the_dense_form(spark):
    """The shift that is left out moves all rows alike."""
    from cohortkit.operators.features import standardise
    df = frame(spark, 120)
    dense, names = one_hot(df, ["s", "t"])
    dense, _ = standardise(dense, names)
    x = np.array([[r.x, *[r[n] for n in names]] for r in dense.orderBy("CD_CLIENTE").collect()])
    rows = wide_features(df, ["s", "t"], ["x"]).frame.orderBy("CD_CLIENTE").collect()
    y = np.array([r.features.toArray() for r in rows])
    far = lambda m: np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
    assert np.allclose(far(x), far(y))
