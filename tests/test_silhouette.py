"""Euclidean silhouette: exact on small clusters, close on drawn rows, and k chosen by it."""

import pathlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from cohortkit.operators.cluster import fit_best_k
from cohortkit.operators import silhouette
from cohortkit.operators.silhouette import _To, euclidean_silhouette, overall
from cohortkit.session import materialize


def brute(x, lab):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = np.zeros(len(x))
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i])
        out[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return out


def frame(spark, x, lab):
    rows = [(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, lab))]
    names = [f"f{j}" for j in range(x.shape[1])]
    return spark.createDataFrame(rows, "CD_CLIENTE long, " + ", ".join(f"{n} double" for n in names) + ", cluster int"), names


def blobs(n, seed=0, d=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=4, size=(4, d))
    lab = rng.choice(4, n, p=[0.55, 0.3, 0.1, 0.05])
    x = centres[lab] + rng.standard_normal((n, d))
    x[:: 97] *= 6  # far points make up much of the distance sums
    return x, lab


def test_small_clusters_are_exact(spark):
    x, lab = blobs(400)
    x[5] = x[6] = x[7]
    lab[0] = 9  # a cluster of one row
    df, names = frame(spark, x, lab)
    s = brute(x, lab)
    got = {r.cluster: (r.silhouette, r.n_rows) for r in euclidean_silhouette(df, names).collect()}
    for c in set(lab.tolist()):
        assert abs(got[c][0] - s[lab == c].mean()) < 1e-12 and got[c][1] == (lab == c).sum()
    assert abs(overall(euclidean_silhouette(df, names)).first().silhouette - s.mean()) < 1e-12


@pytest.mark.parametrize("points,error", [(128, 0.03), (512, 0.015)])
def test_drawn_rows_come_close(spark, points, error):
    """Sums err by about 1 / sqrt(2 * points) of themselves, and a silhouette by no more than some of that."""
    x, lab = blobs(4000, 1)
    df, names = frame(spark, x, lab)
    s = brute(x, lab)
    for seed in (1, 2):
        got = euclidean_silhouette(df, names, key="CD_CLIENTE", points=points, seed=seed)
        assert abs(overall(got).first().silhouette - s.mean()) < error
        for r in got.collect():
            assert abs(r.silhouette - s[lab == r.cluster].mean()) < 3 * error


def test_repeatable_and_edges(spark):
    x, lab = blobs(1500, 2)
    df, names = frame(spark, x, lab)
    value = lambda d: overall(euclidean_silhouette(d, names, key="CD_CLIENTE", points=40)).first().silhouette
    assert abs(value(df) - value(df.repartition(7))) < 1e-12
    one = euclidean_silhouette(df.filter("cluster = 0"), names).collect()
    assert [(r.silhouette, r.n_rows) for r in one] == [(None, int((lab == 0).sum()))]
    assert euclidean_silhouette(df.limit(0), names).collect() == []
    same = spark.createDataFrame([(i, 1.0, i % 2) for i in range(10)], "CD_CLIENTE long, a double, cluster int")
    assert [r.silhouette for r in euclidean_silhouette(same, ["a"]).collect()] == [0.0, 0.0]
    null = df.selectExpr("*", "nullif(cluster, 1) AS c2").drop("cluster")
    assert sorted(r.n_rows for r in euclidean_silhouette(null, names, "c2").collect()) == sorted(np.bincount(lab).tolist())


def test_fit_chooses_by_it(spark):
    x, lab = blobs(600, 3, 2)
    df, names = frame(spark, x, lab)
    feats = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    best = fit_best_k(feats, ks=(2, 3, 4), partitions=4, silhouette="euclidean")
    for s in best.scores:
        again = fit_best_k(feats, ks=(s["k"],), partitions=4)
        rows = again.assignments.orderBy("CD_CLIENTE").collect()
        assert abs(s["silhouette"] - brute(x, np.array([r.cluster for r in rows])).mean()) < 1e-9
    assert best.k == max(best.scores, key=lambda s: (s["silhouette"], -s["k"]))["k"]
    with pytest.raises(ValueError):
        fit_best_k(feats, silhouette="cosine")


def test_distances_are_those_of_the_differences():
    """One product instead of a pass per coordinate; nothing is lost where it cancels."""
    rng = np.random.default_rng(3)
    for far in (0.0, 1e6):
        y = rng.standard_normal((300, 12)) + far
        y[:10] += 500
        x = np.concatenate([rng.standard_normal((50, 12)) + far, y[:20], y[20:40] + 1e-7])
        want = np.sqrt(np.square(x[:, None, :] - y[None, :, :]).sum(-1))
        got = _To(y).distances(x)
        assert np.allclose(got, want, rtol=1e-10, atol=0) and (got[50:70][want[50:70] == 0] == 0).all()
    same = np.zeros((40, 2)) + 7
    assert (_To(same).distances(same) == 0).all()


def test_rows_are_spread_over_tasks(spark, monkeypatch):
    """The passes over all rows have a partition per so many rows, however few files the input is in."""
    written = {}

    def keep(df, name="table"):
        out = materialize(df, name)
        written[name] = len(list(pathlib.Path(out._scratch_path).glob("part-*")))
        return out

    monkeypatch.setattr(silhouette, "materialize", keep)
    monkeypatch.setattr(silhouette, "_PARTITION_ROWS", 100)
    x, lab = blobs(4000, 2)
    df, names = frame(spark, x, lab)
    euclidean_silhouette(df.coalesce(1), names, key="CD_CLIENTE", points=64)
    assert written["coded-points"] == 40


def test_large_clusters_are_exact(spark, monkeypatch):
    """All rows count: nothing is drawn, whatever the cluster's size, the number of tiles and ``points``."""
    x, lab = blobs(5000, 4)
    x[10:30] = x[10]  # equal rows
    lab[0] = 9  # a cluster of one row
    df, names = frame(spark, x, lab)
    s = brute(x, lab)
    want = {c: (s[lab == c].mean(), int((lab == c).sum())) for c in set(lab.tolist())}
    assert max(n for _, n in want.values()) > 2 * 1024
    for rows, points in ((50_000, 1024), (400, 1024), (1300, 8)):
        monkeypatch.setattr(silhouette, "_PARTITION_ROWS", rows)
        got = {r.cluster: (r.silhouette, r.n_rows) for r in euclidean_silhouette(df, names, key="CD_CLIENTE", points=points).collect()}
        assert {c: n for c, (_, n) in got.items()} == {c: n for c, (_, n) in want.items()}
        assert all(abs(got[c][0] - want[c][0]) < 1e-12 for c in want)


def test_sums_are_those_of_the_distances():
    """Of more rows than are worked out together, for the rows of both sides; a row that is no number spoils its own."""
    rng = np.random.default_rng(5)
    x, y = rng.standard_t(2, (150, 3)) + 1e4, rng.standard_t(2, (2500, 3)) + 1e4
    x[:40] = y[:40]
    d = np.sqrt(np.square(x[:, None, :] - y[None, :, :]).sum(-1))
    of_x, of_y = _To(y).sums(x)
    assert np.allclose(of_x, d.sum(1), rtol=1e-11, atol=0) and np.allclose(of_y, d.sum(0), rtol=1e-11, atol=0)
    x[7] = np.nan
    of_x, of_y = _To(y).sums(x)
    assert np.isnan(of_x[7]) and np.isnan(of_y).all()
    assert np.allclose(np.delete(of_x, 7), np.delete(d, 7, 0).sum(1), rtol=1e-11, atol=0)
