import brute
import corpus_pipeline as C
import numpy as np
import pandas as pd
import pytest
from conftest import SF
from test_tokens_and_packing import check_pieces
from cohortkit.llm import decontaminate as D


@pytest.fixture(scope="module")
def stages(spark):
    """{stage: (rows in, rows out)} as pandas, each stage on what the one before kept."""
    from cohortkit.session import materialize
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in C.STAGES:
        before = docs.toPandas()
        docs = materialize(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
        out[name] = before, docs.toPandas()
    return out


def test_names():
    assert [name for name, _ in C.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join",
                                              "benchmark_decontamination", "packing"]


def test_quality(stages):
    before, after = stages["quality_rules"]
    failed = {i for i, t in zip(before.doc_id, before.text) if brute.quality(t)[-1]}
    assert not failed & set(after.doc_id)
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    good = set(labels[labels.quality == 1].doc_id) - failed
    assert len(good & set(after.doc_id)) >= 0.98 * len(good)


def test_lines(stages):
    before, after = stages["line_dedup"]
    want = brute.lines(list(zip(before.doc_id, before.text)))
    assert dict(zip(after.doc_id, after.text)) == {i: t for i, (_, _, t) in want.items()}
    assert (after.n_chars == after.text.str.len()).all()


def test_one_of_each_group(stages):
    before, after = stages["ngram_jaccard_join"]

    def shingles(text):
        words = brute.WORD.findall(text.translate(brute.LOW))
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert sorted(after.doc_id) == sorted({find(i) for i in sets})


def test_leaks(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [D.words_of(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    gone = set(before.doc_id) - set(after.doc_id)
    for i, text in zip(before.doc_id, before.text):
        words = np.array([hash(w) for w in D.words_of(text)])
        leaks = any(D.best_alignment(np.array([hash(w) for w in item]), words)[0] <= 0.2 * len(item) for item in items
                    if len({*item} - {*D.words_of(text)}) <= 0.2 * len(item))
        assert leaks == (i in gone)


def test_packed(spark, stages, tokenizer):
    before, after = stages["packing"]
    check_pieces(list(after.itertuples()), dict(zip(before.doc_id, before.text)), tokenizer)
    rows = C.run(spark, SF).drop("ids").toPandas()
    key = ["doc_id", "start"]
    a, b = (x[list(rows.columns)].sort_values(key).reset_index(drop=True) for x in (after, rows))
    pd.testing.assert_frame_equal(a, b)


def test_stages_bound_the_rows_of_arrow_batches(spark, documents):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, want in (("10000", "1000"), ("0", "1000"), ("64", "64")):
            spark.conf.set(key, given)
            C.STAGES[-1][1](spark, spark.createDataFrame(documents.head(3)), SF)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)
