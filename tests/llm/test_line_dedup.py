import hashlib

import brute
from conftest import SF, edge_rows
from cohortkit.llm import line_dedup as L


def test_query_against_brute_force(spark, documents):
    want = brute.lines(list(zip(documents.doc_id, documents.text)))
    got = L.op6_line_dedup(spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        n, dropped, kept = want[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (n, dropped, hashlib.sha256(kept.encode()).hexdigest())


def test_edges(spark, edge, empty):
    out = L.drop_repeated_lines(edge, min_docs=3)
    assert out.columns == edge.columns and out.count() == edge.count()
    texts = {(r.doc_id, r.text) for r in out.collect()}
    want = brute.lines(list({i: t for i, t, _ in edge_rows() if i not in (14, None)}.items()), min_docs=3)
    for i, (_, dropped, kept) in want.items():
        original = dict((a, b) for a, b, _ in edge_rows())[i]
        assert (i, kept if dropped else original) in texts
    assert want[12][1] == 0  # the largest id keeps both of its lines
    assert L.keep_bitmaps(empty).count() == 0 and L.drop_repeated_lines(empty).count() == 0


def test_runs_across_partition_bounds(spark):
    """One line in every document, and batches that cut its run."""
    line = "the same forty characters and some more of them"
    docs = spark.createDataFrame([(i, f"{line}\nown line {i}") for i in range(2000)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = L.line_digests(docs, L.keep_bitmaps(docs)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.doc_id: r.n_dropped for r in rows} == {i: int(i != 1999) for i in range(2000)}
