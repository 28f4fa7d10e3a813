import pytest

from cohortkit.operators.recommend import owned_sets, popularity, top_products, top_unowned


@pytest.fixture(scope="module")
def case(spark):
    clusters = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 1)], "CD_CLIENTE long, cluster int")
    own = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "c"), (1, "d"),      # owns everything in cluster 0
         (2, "a"), (2, "a"), (2, "b"),                 # duplicate row for (2, a)
         (4, "x"), (4, "y"), (5, "y"), (5, None), (None, "z"),
         (9, "q")],                                   # client without a cluster
        "CD_CLIENTE long, DS_PROD string")
    return clusters, own


def test_popularity_modes_and_tie_order(case):
    clusters, own = case
    rows = {(r.cluster, r.DS_PROD): (r.QTD, r.rank_in_cluster)
            for r in popularity(clusters, own, count_mode="rows").collect()}
    assert rows[(0, "a")] == (3, 1) and rows[(0, "b")] == (2, 2)
    assert rows[(0, "c")] == (1, 3) and rows[(0, "d")] == (1, 4)  # tie -> product ascending
    assert rows[(1, "y")] == (2, 1) and rows[(1, "x")] == (1, 2)
    cl = {(r.cluster, r.DS_PROD): r.QTD for r in popularity(clusters, own, count_mode="clients").collect()}
    assert cl[(0, "a")] == 2


def test_top_unowned_cases(case):
    clusters, own = case
    got = {r.CD_CLIENTE: r.RECOMENDACOES for r in top_unowned(clusters, own, n=3).collect()}
    assert got == {1: "", 2: "c, d", 3: "a, b, c", 4: "", 5: "x"}


def test_salted_path_equals_broadcast_path(case):
    clusters, own = case
    a = {tuple(r) for r in top_unowned(clusters, own, n=2).collect()}
    b = {tuple(r) for r in top_unowned(clusters, own, n=2, broadcast_rows=0, salt=3).collect()}
    assert a == b


def test_owned_sets_and_top_products(case):
    clusters, own = case
    s = {r.CD_CLIENTE: (r.owned, r.n_owned) for r in owned_sets(own).collect()}
    assert s[2] == (["a", "b"], 2)
    top = top_products(popularity(clusters, own), n=1).collect()
    assert sorted((r.cluster, r.DS_PROD) for r in top) == [(0, "a"), (1, "y")]


def _brute(clusters, own, n):
    """Reference semantics in plain Python: rows counted, ties by product."""
    from collections import Counter
    cl = dict(clusters)
    cnt = Counter()
    owned = {}
    for k, p in own:
        if k is None or p is None:
            continue
        owned.setdefault(k, set()).add(p)
        if k in cl:
            cnt[(cl[k], p)] += 1
    rank = {}
    for c in set(cl.values()):
        items = sorted(((-q, p) for (cc, p), q in cnt.items() if cc == c))
        rank[c] = [p for _, p in items]
    return {k: ", ".join([p for p in rank[c] if p not in owned.get(k, set())][:n]) for k, c in cl.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_unowned_random_vs_bruteforce(spark, seed):
    import random
    rng = random.Random(seed)
    clusters = [(k, rng.randrange(3)) for k in range(60)]
    products = [f"p{i:02d}" for i in range(15)]
    own = [(rng.randrange(70), rng.choice(products)) for _ in range(600)]  # some keys without cluster
    cdf = spark.createDataFrame(clusters, "CD_CLIENTE long, cluster int")
    odf = spark.createDataFrame(own, "CD_CLIENTE long, DS_PROD string")
    exp = _brute(clusters, own, 4)
    for kw in ({}, {"broadcast_rows": 0, "salt": 5}):
        got = {r.CD_CLIENTE: r.RECOMENDACOES for r in top_unowned(cdf, odf, n=4, **kw).collect()}
        assert got == exp
    ranks = popularity(cdf, odf).collect()
    by_c = {}
    for r in ranks:
        by_c.setdefault(r.cluster, []).append((r.rank_in_cluster, -r.QTD, r.DS_PROD))
    for c, rows in by_c.items():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
        assert [x[1:] for x in rows] == sorted(x[1:] for x in rows)


def test_contract_errors(spark):
    clusters = spark.createDataFrame([(1, 0)], "CD_CLIENTE long, cluster int")
    no_product = spark.createDataFrame([(1,)], "CD_CLIENTE long")
    with pytest.raises(ValueError, match="DS_PROD"):
        top_unowned(clusters, no_product)
    with pytest.raises(ValueError, match="QTD"):
        top_products(spark.createDataFrame([(0, "a")], "cluster int, DS_PROD string"))


def test_query_reads_the_pairs_it_has(spark):
    """The ownership that recommendations are checked against is read from the pairs' table, not joined again."""
    from cohortkit.plans.queries import q_kmeans_recommend

    df = q_kmeans_recommend(spark, "/root/testdata/sf0.001")
    assert df.inputFiles() and not any("testdata" in p for p in df.inputFiles())
    assert df.where("already_owned > 0 OR twice > 0 OR NOT within_n").count() == 0
