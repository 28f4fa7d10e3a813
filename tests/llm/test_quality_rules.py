import brute
import numpy as np
import pytest
from conftest import SF, edge_rows
from cohortkit.llm import quality_rules as Q
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x1f\x85é#|", max_size=60))
def test_counts(text):
    want = brute.quality(text)
    assert Q.text_counts(text.encode())[:5] == want[:5]


def test_query(spark, documents):
    rows = {r.doc_id: r for r in Q.op1_quality_rules(spark, SF).collect()}
    assert len(rows) == len(documents)
    for i, text in zip(documents.doc_id, documents.text):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(text)
        assert not (r.kept and r.base_failed)


def test_forest_finds_outliers_and_spares_the_rest():
    rng = np.random.default_rng(1)
    normal = rng.normal(size=(4000, 5))
    forest = Q.IsolationForest(normal, 100, 256, 3)
    inside, outside = forest.score(normal), forest.score(rng.normal(size=(200, 5)) + 5)
    assert outside.min() > np.quantile(inside, 0.98)
    # Against paths walked one row at a time.
    for row in normal[:5]:
        total = 0.0
        for f, s, p in zip(forest.feature, forest.split, forest.path):
            node = 1
            while f[node] >= 0:
                node = 2 * node + int(row[f[node]] >= s[node])
            total += p[node]
        want = 2 ** (-total / 100 / float(Q._expected_path(256)))
        assert forest.score(row[None])[0] == pytest.approx(want)


def test_threshold_holds_on_other_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = Q.judge(docs, labels.filter("doc_id % 2 = 0"), good_loss=0.01)
    held = judged.join(labels.filter("doc_id % 2 = 1"), judged.id == labels.doc_id).filter("NOT base_failed").collect()
    good = [r.kept for r in held if r.quality == 1]
    assert np.mean(good) > 0.95


def test_bad_rows_held_out_are_rejected(spark):
    """With the defaults and fewer than 500 good labels: what one half of the labels teaches holds for the other."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = Q.judge(docs, labels.filter("doc_id % 2 = 0"))
    held = judged.join(labels.filter("doc_id % 2 = 1"), judged.id == labels.doc_id).filter("NOT base_failed").collect()
    bad, good = ([r.kept for r in held if r.quality == q] for q in (0, 1))
    assert len(bad) > 10 and np.mean(bad) < 0.1 and np.mean(good) > 0.98


def test_threshold_is_from_both_classes():
    # Just above the highest good score, with few rows too; below it only for bad rows, within good_loss.
    assert Q._threshold([(3000, 50, 0), (5000, 1, 0), (7000, 0, 9)], 0.002) == 5001
    assert Q._threshold([(3000, 50, 0), (5000, 1, 0)], 0.002) == 5001
    assert Q._threshold([(3000, 980, 0), (4000, 0, 5), (5000, 1, 0), (7000, 0, 9)], 0.002) == 3001
    assert Q._threshold([(3000, 980, 0), (4000, 1, 0), (5000, 1, 0), (7000, 0, 9)], 0.002) == 5001
    assert Q._threshold([(3000, 980, 0), (4000, 1, 1), (5000, 2, 0), (7000, 0, 9)], 0.002) == 5001
    assert Q._threshold([(3000, 998, 0), (4000, 1, 0), (5000, 1, 0)], 0.002) == 3001


def test_edges(spark, edge, empty):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (8, None, 0), (None, 1, 0), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.judge(edge, labels).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        if r.n_words == 0:
            assert r.base_failed and not r.kept
    kept = Q.keep_good(edge, labels)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert Q.judge(edge, labels.limit(0)).filter("kept = base_failed").count() == 0
    assert Q.judge(empty, labels).count() == 0
