"""Vector graphs against brute-force cosines."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from cohortkit.llm import vector_graph as V

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, least=0.95):
    """{row: (id, n_links, component_id, kept)} of (id, vector or None) rows."""
    n = len(rows)
    links = [[] for _ in range(n)]
    for d in {len(v) for _, v in rows if v is not None}:
        at = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) == d and None not in v
              and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
        if not at or not d:
            continue
        x = np.array([np.float32(rows[i][1]) for i in at], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= least)):
            if a != b:
                links[at[a]].append(at[b])
    ids = [-(2 ** 63) if i is None else i for i, _ in rows]
    root = list(range(n))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i in range(n):
        for j in links[i]:
            root[find(i)] = find(j)
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], len(links[i]), low[find(i)], ids[i] == low[find(i)]) for i in range(n))


def near(rng, v, cos):
    v = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ v) * v
    return cos * v + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def planted(rng, n=900, d=24):
    """Single vectors, pairs above and below the threshold, chains, and a third of all rows near one another."""
    base = [rng.standard_normal(d) for _ in range(n)]
    hot = rng.standard_normal(d)
    out = base + [near(rng, hot, 0.99) for _ in range(n // 2)]
    for v in base[:100]:
        out += [3 * near(rng, v, 0.96), near(rng, v, 0.93)]
    for v in base[100:120]:
        for _ in range(6):
            v = near(rng, v, 0.96)
            out.append(v)
    return [(int(i), [float(np.float32(x)) for x in out[k]]) for i, k in enumerate(rng.permutation(len(out)))]


def rows_of(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("kw", [{}, {"shard_rows": 100, "least_shards": 5}, {"shard_bytes": 24 * 4 * 300}])
def test_planted_groups(spark, kw):
    rows = planted(np.random.default_rng(1))
    want = brute(rows)
    got = rows_of(V.near_vectors(spark.createDataFrame(rows, SCHEMA), **kw))
    links = sum(w[1] for w in want)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.98 * links
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)
    assert any(w[1] > 400 for w in want) and any(w[1] == 1 for w in want)


def test_other_threshold_and_recall(spark):
    rng = np.random.default_rng(2)
    rows = planted(rng, 300, 8)
    want = brute(rows, 0.8)
    got = rows_of(V.near_vectors(spark.createDataFrame(rows, SCHEMA), least=0.8))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]),
            (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 3.0, 0.0]),
            (None, [3.0, 2.0, 1.0]), (11, [-1.0, -2.0, -3.0]), (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30])]
    extra = [(i, x, 7, "x", 7) for i, x in rows]
    df = spark.createDataFrame(extra, SCHEMA + ", id long, cls string, root long")
    assert rows_of(V.near_vectors(df)) == brute(rows)
    assert V.near_vectors(df.limit(0)).collect() == []
    one = spark.createDataFrame([(5, [1.0])], SCHEMA)
    assert rows_of(V.near_vectors(one)) == [(5, 0, 5, True)]
    with pytest.raises(ValueError):
        V.near_vectors(df, least=0.0)


def test_graph_reaches_every_node_and_layers_thin_out():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((3000, 16)), 5 + 0.01 * rng.standard_normal((1500, 16))])
    x = V.unit(x).astype(np.float32)
    g = V.build(x, rng.random(len(x)) * (1 - 1e-12) + 1e-13)
    seen, front = {g.entry}, [g.entry]
    while front:
        front = [k for k in np.unique(g.links[0][front]).tolist() if k >= 0 and k not in seen]
        seen.update(front)
    assert len(seen) == len(x)
    used = [int((m >= 0).any(1).sum()) for m in g.links]
    assert used[0] > 10 * used[1] > 0
    g = V.audited(g, 0.95, 0.99)
    q, k = g.in_range(x[3000:3100], 0.95, g.beam)  # their 1,500 neighbours are more than the widest beam holds
    assert np.bincount(q).min() == 1500


def test_choose_prefers_neighbours_apart_from_one_another():
    x = V.unit(np.array([[1, 0.0], [1, 0.1], [1, 0.11], [1, -0.3], [0, 1.0]])).astype(np.float32)
    sims = (x[[1, 2, 3, 4]] @ x[0])[None]
    assert V.choose(x, np.array([[1, 2, 3, 4]], np.int32), sims, 2).tolist() == [[1, 3]]
    assert V.choose(x, np.array([[1, -1]], np.int32), np.array([[0.9, -np.inf]], np.float32), 3).tolist() == [[1, -1, -1]]


def test_query(spark):
    t = pd.read_parquet(f"{SF}/embeddings.parquet")
    want = brute([(int(i), v.tolist()) for i, v in zip(t.vec_id, t.embedding)])
    assert rows_of(V.op12_vector_graphs(spark, SF)) == want
