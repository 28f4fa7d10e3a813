import random

import brute
import numpy as np
import pytest
from conftest import SF, edge_rows
from cohortkit.llm import ngram_join as J


def family(seed, size, words, edits):
    """A text and copies of it with some words replaced."""
    rng = random.Random(seed)
    base = [f"w{seed}x{rng.randrange(10_000)}" for _ in range(words)]
    out = [" ".join(base)]
    for c in range(size - 1):
        copy = list(base)
        for k in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"edit{seed}x{c}x{k}"
        out.append(" ".join(copy))
    return out


def test_query_against_brute_force(spark, documents):
    want = brute.components(list(zip(documents.doc_id, documents.text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op7_ngram_join(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [85, 60])
def test_families_and_shared_passages(spark, percent):
    texts = [t for s, (size, words, edits) in enumerate(
        [(25, 120, 6), (25, 30, 2), (30, 9, 1), (20, 400, 20), (15, 14, 2)]) for t in family(s, size, words, edits)]
    passage = " ".join(f"shared{i}" for i in range(60))
    rng = random.Random(9)
    texts += [passage + " " + " ".join(f"own{d}x{i}" for i in range(rng.choice([3, 8, 12, 200]))) for d in range(40)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.n, r.component_id) for r in J.similar_groups(frame, percent=percent).collect()}
    assert got == brute.components(docs, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_short_near_pairs_beside_a_shared_passage(spark, seed):
    """The grams that a pair has in common are listed for one of it and not for the other."""
    rng = random.Random(seed)
    passage, texts = [f"shared{i}" for i in range(60)], []
    for d in range(150):
        k = rng.randrange(8, 18)
        at = rng.randrange(60 - k)
        base = passage[at:at + k] + [f"near{d}x{i}" for i in range(23 - k)]
        texts += [" ".join(base), " ".join(base[:-1] + [f"edit{d}"])]
    for d in range(60):
        k = rng.randrange(20, 60)
        at = rng.randrange(61 - k)
        texts.append(" ".join(passage[at:at + k] + [f"own{d}"]))
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.id: (r.n, r.component_id) for r in J.similar_groups(frame).collect()} == brute.components(docs)


@pytest.mark.parametrize("percent", [100, 95, 50, 34, 10])
def test_thresholds_down_to_one_gram_in_common(spark, percent):
    rng = random.Random(percent)
    words = [f"v{i}" for i in range(400)]
    docs = [" ".join(rng.sample(words, rng.choice([1, 2, 3, 4, 6, 9]))) for _ in range(150)]
    docs += ["lone", "lone wolf", "lone wolf pack", *family(3, 8, 40, 12), *family(4, 8, 12, 6)]
    docs = list(enumerate(docs))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for n in (1, 2):
        want = brute.components(docs, percent, n)
        assert {r.id: (r.n, r.component_id) for r in J.similar_groups(frame, n=n, percent=percent).collect()} == want
    with pytest.raises(ValueError):
        J.similar_groups(frame, percent=0)


def test_words_with_nul_characters(spark):
    docs = list(enumerate(["a b c d e f g h", "a b c d e f g h\0", "a b c d a\0 b c d", "\0", "\0\0", "a\0b c", "ab c", "\0a b", "a b"]))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.n, r.component_id) for r in J.similar_groups(frame).collect()}
    assert got == brute.components(docs) and got[0] != got[1] and got[2] == (5, 2)


def test_small_sets_meet_by_subsets(spark):
    """With the boundary forced up, everything goes by 2-subsets; forced to 0, by lists."""
    docs = list(enumerate(t for s in range(6) for t in family(s, 12, 25 + 5 * s, 2)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.components(docs)
    for size in (0, 40, 10_000):
        join = J.JaccardJoin(frame, 4, 85, "doc_id", "text")
        join.boundary = lambda prefixes, size=size: size
        assert {r.id: (r.n, r.component_id) for r in join.components().collect()} == want


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 160), (7, 8), (9, 9), (8, 7), (3, 2), (2, 1)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.root for r in J.connected_components(frame).collect()}
    assert got == {**{i: 5 for i in [5, *range(100, 161)]}, 7: 7, 8: 7, 1: 1, 2: 1, 3: 1}


def test_edges(spark, edge, empty):
    rows = J.similar_groups(edge).collect()
    assert len(rows) == len(edge_rows())
    groups = {(r.id, r.n): r.component_id for r in rows}
    for i in (1, 2, 3):
        assert groups[i, 0] == i
    lowest = -(2 ** 63)  # the row without id holds the same prose
    assert groups[8, 237] == groups[9, 239] == groups[7, 237] == lowest and groups[14, 1] == groups[14, 2] == 14
    kept = J.keep_one_per_group(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3, None}.issubset(ids) and not {7, 8, 9} & set(ids) and ids.count(14) == 2 and ids.count(None) == 1
    assert J.similar_groups(empty).count() == 0 and J.keep_one_per_group(empty).count() == 0


def test_pairs_stay_few_where_many_sets_share_a_passage(spark, monkeypatch):
    """Most link with many others, and fewer pairs are verified than link; only sets of such pairs are moved."""
    rng = random.Random(3)
    passage = [f"shared{i}" for i in range(100)]
    docs = [passage + [f"own{d}x{i}" for i in range(rng.randrange(3, 20))] for d in range(400)]
    docs = list(enumerate(" ".join(d) for d in docs))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    seen, link = [], J.JaccardJoin.verify

    def verify(self, pairs, wholes):
        seen.append(pairs.select("a", "b").distinct().count())
        return link(self, pairs, wholes)
    monkeypatch.setattr(J.JaccardJoin, "verify", verify)
    got = {r.id: (r.n, r.component_id) for r in J.similar_groups(frame).collect()}
    assert got == brute.components(docs)
    sets = [frozenset(brute.WORD.findall(t)) for _, t in docs]
    links = sum(len(a & b) >= 0.85 * len(a | b) for a in sets for b in sets) / 2
    assert links > 25 * len(docs) and sum(seen) < 6 * len(docs)


def test_bitmaps_never_tell_more_than_the_sets():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b, c = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in rng.integers(1, 400, 3))
        x, y = np.unique(np.concatenate([a, c])), np.unique(np.concatenate([b, c]))
        apart = sum(int(v).bit_count() for v in (J._bitmap(x) ^ J._bitmap(y)).view(np.uint64))
        assert apart <= len(np.setxor1d(x, y)) and (J._bitmap(x) == J._bitmap(x[::-1])).all()
