import random

import brute
import numpy as np
from conftest import SF, edge_rows
from cohortkit.llm import decontaminate as D


def least_edits(item, words):
    """Fewest edits to the item over all runs of words, one cell at a time."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def edited(words, k, rng):
    out = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = "changed"
        elif kind == 1:
            out.insert(at, "put")
        else:
            del out[at]
    return out


def test_query_finds_all_within_the_limit(spark, documents):
    import pandas as pd

    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.edits for r in D.op8_benchmark_leaks(spark, SF).collect()}
    want = {}
    for d, text in zip(documents.doc_id, documents.text):
        words = D.words_of(text)
        have = set(words)
        for i, t in zip(items.item_id, items.text):
            w = D.words_of(t)
            if sum(x not in have for x in w) <= 0.2 * len(w) and (n := least_edits(w, words)) <= int(0.2 * len(w)):
                want[d, i] = n
    assert got == want and want


def test_planted_edits_reach_the_recall(spark):
    rng = random.Random(4)
    items = [(i, [f"v{rng.randrange(400)}" for _ in range(rng.choice([10, 20, 45]))]) for i in range(30)]
    docs, planted = [], {}
    for d in range(300):
        filler = [f"v{rng.randrange(400)}" for _ in range(80)]
        if d % 3 == 0:
            i, w = items[rng.randrange(30)]
            k = rng.randrange(int(0.2 * len(w)) + 1)
            filler[40:40] = edited(w, k, rng)
            planted[d] = i
        docs.append((d, " ".join(filler)))
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        [(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert sum((d, i) in pairs for d, i in planted.items()) >= 0.95 * len(planted)
    texts, by_id = dict(docs), dict(items)
    for r in found:  # no false positives, and the edits are the fewest
        assert r.edits == least_edits(by_id[r.item_id], texts[r.doc_id].split()) <= 0.2 * len(by_id[r.item_id])


def test_long_items_beside_short_ones_reach_the_recall():
    """Edits at the limit of each size, in an index of mostly short items."""
    rng = random.Random(6)
    sizes = [16] * 60 + [150] * 2 + [400] * 2 + [600]
    items = [(i, " ".join(f"v{rng.randrange(4000)}" for _ in range(m))) for i, m in enumerate(sizes)]
    index = D.ItemIndex(items, 0.2, 8, 0.95)
    for m in (16, 150, 400, 600):
        found = trials = 0
        for i, text in items:
            for _ in range(0 if len(text.split()) != m else 1 if m == 16 else 20):
                k = int(0.2 * m)
                words = ["around"] * 30 + edited(text.split(), k, rng) + ["around"] * 30
                ids = np.array([index.vocabulary.get(w.encode(), D._UNKNOWN) for w in words])
                found += any(item == i and edits <= k for _, item, edits, _ in index.leaks([ids]))
                trials += 1
        assert trials >= 20 and found >= 0.9 * trials, (m, found, trials)


def test_embedding_keeps_near_windows_near():
    rng = np.random.default_rng(0)
    base = rng.integers(2, 500, 40)
    near = base.copy()
    near[7] = 501
    far = rng.integers(2, 500, 40)
    same = lambda a, b: np.mean([(D.embed(a[None], r) == D.embed(b[None], r))[:, :80].mean() for r in range(20)])
    assert same(base, base) == 1 and same(base, near) > 0.6 > 0.1 > same(base, far)


def test_alignment_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item, region = rng.integers(2, 6, rng.integers(1, 9)), rng.integers(0, 6, rng.integers(0, 15))
        assert D.best_alignment(item, region)[0] == least_edits(list(item), list(region))


def test_edges(spark, edge, empty):
    item = " ".join(f"word{i} goes on" for i in range(20, 40))
    items = spark.createDataFrame([(1, item, 5), (2, None, 5), (3, "", 5), (4, "a b c", 5), (4, "a b c", 5)],
                                  "item_id long, text string, doc_id long")
    pairs = sorted({(-1 if r.doc_id is None else r.doc_id, r.item_id) for r in D.find_leaks(edge, items).collect()})
    assert pairs == [(-1, 1), (5, 1), (7, 1), (8, 1), (9, 1), (14, 4)]
    clean = D.drop_leaks(edge, items)
    assert clean.columns == edge.columns
    assert clean.count() == len(edge_rows()) - 7
    assert D.find_leaks(empty, items).count() == 0 and D.find_leaks(edge, items.limit(0)).count() == 0
    blocks = D.find_leaks(edge, items, block_chars=50)
    assert sorted({(-1 if r.doc_id is None else r.doc_id, r.item_id) for r in blocks.collect()}) == pairs


def test_brute_edit_distance():
    assert brute.edit_distance("kitten", "sitting") == 3
