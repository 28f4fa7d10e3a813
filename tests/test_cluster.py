import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortkit.operators.cluster import fit_best_k, nearest_centre, silhouette


def _points(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0], [5, 5], [0, 6]])
    lab = rng.integers(0, 3, n)
    pts = centres[lab] + rng.normal(scale=1.0, size=(n, 2))
    rows = [(i, float(x), float(y), int(c)) for i, ((x, y), c) in enumerate(zip(pts, lab))]
    return spark.createDataFrame(rows, "CD_CLIENTE long, a double, b double, cluster int"), pts, lab


def _sq_silhouette_numpy(x, lab):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        n_own = own.sum()
        if n_own == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (n_own - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append(1 - a / b if a < b else (b / a - 1 if a > b else 0.0))
    return float(np.mean(s))


def test_silhouette_matches_bruteforce_and_evaluator(spark):
    df, pts, lab = _points(spark)
    ours = silhouette(df, ["a", "b"]).first().silhouette
    assert abs(ours - _sq_silhouette_numpy(pts, lab)) < 1e-9
    v = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    ev = ClusteringEvaluator(featuresCol="f", predictionCol="cluster", distanceMeasure="squaredEuclidean")
    assert abs(ours - ev.evaluate(v.withColumn("cluster", F.col("cluster").cast("double")))) < 1e-9


def test_nearest_centre_matches_numpy(spark):
    df, pts, _ = _points(spark)
    centres = spark.createDataFrame([(0, 0.0, 0.0), (1, 5.0, 5.0), (2, 0.0, 6.0)], "cluster int, a double, b double")
    got = {r.CD_CLIENTE: r.near for r in nearest_centre(df, ["a", "b"], centres, out="near").collect()}
    c = np.array([[0, 0], [5, 5], [0, 6]])
    exp = ((pts[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(len(pts))] == list(exp)


def test_fit_best_k_properties(spark):
    df, _, _ = _points(spark)
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    best = fit_best_k(feats, ks=(2, 3, 4), partitions=4)
    scored = [s for s in best.scores if s["silhouette"] is not None]
    top = max(s["silhouette"] for s in scored)
    assert best.k == next(s["k"] for s in scored if s["silhouette"] == top)  # first best wins
    a = best.assignments
    assert a.count() == 300 and a.select("CD_CLIENTE").distinct().count() == 300
    # each centre is the mean of its rows; each row is nearest its own centre
    joined = a.join(df.select("CD_CLIENTE", "a", "b"), "CD_CLIENTE")
    means = joined.groupBy("cluster").agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    again = nearest_centre(joined, ["a", "b"], means, out="near")
    assert again.where(F.col("near") != F.col("cluster")).count() == 0
    # same labels when the input arrives in another order
    shuffled = feats.orderBy(F.rand(11)).repartition(7)
    best2 = fit_best_k(shuffled, ks=(2, 3, 4), partitions=4)
    l1 = {r.CD_CLIENTE: r.cluster for r in a.collect()}
    l2 = {r.CD_CLIENTE: r.cluster for r in best2.assignments.collect()}
    assert best2.k == best.k and l1 == l2


def test_fit_best_k_skips_undefined_k(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(3)], "CD_CLIENTE long, a double")
    feats = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    best = fit_best_k(feats, ks=(2, 3, 4), partitions=2)
    assert best.k == 2 and [s.get("skipped") is not None for s in best.scores] == [False, True, True]


def test_fit_does_not_depend_on_how_files_are_packed(spark, tmp_path):
    """Core counts change how a stored table is split for reading; labels and the chosen k stay."""
    df, _, _ = _points(spark, n=900, seed=8)
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.drop("cluster"))
    found = []
    for packing, cores in (("2", "2"), ("8", "8")):
        spark.conf.set("spark.sql.files.minPartitionNum", packing)
        spark.conf.set("spark.sql.shuffle.partitions", cores)
        try:
            best = fit_best_k(feats, ks=(2, 3, 4, 5), partitions=8)
            found.append((best.k, {r.CD_CLIENTE: r.cluster for r in best.assignments.collect()}))
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_client_without_key_keeps_its_label(spark):
    df, _, _ = _points(spark, n=60)
    rows = df.drop("cluster").withColumn("CD_CLIENTE", F.when(F.col("CD_CLIENTE") != 5, F.col("CD_CLIENTE")))
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    best = fit_best_k(feats, ks=(3,))
    assert best.labelled.filter("cluster IS NOT NULL").count() == 60
    assert {"a", "b", "cluster"} <= set(best.labelled.columns)


def test_nothing_stays_cached(spark):
    from cohortkit.plans import queries as Q
    spark.catalog.clearCache()
    for name in ("q_recommend", "q_personas", "q_box_stats", "q_silhouette"):
        getattr(Q, name)(spark, "/root/testdata/sf0.001").collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
