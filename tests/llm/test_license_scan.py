from itertools import combinations

import brute
import pytest
from conftest import SF, edge_rows
from cohortkit.llm import license_scan as S


def contract(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_query(spark, documents):
    rows = {r.doc_id: r for r in S.op10_license_scan(spark, SF).collect()}
    assert len(rows) == len(documents)
    for i, text in zip(documents.doc_id, documents.text):
        r = rows[i]
        assert contract(r) == brute.license_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and ("GNU General Public License, version 3" in text) == ("gpl-3" in r.labels)


TEXTS = {
    1: "This work is licensed under the GNU General Public License, version 3.",
    2: "words before. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
       "associated documentation files (the software)",
    3: "the licensed software under a general license of the public work version",  # words without a phrase
    4: "CC BY-NC. under the MIT license, Under The MIT License; cc by nc 4.0",
    5: "Apache License, Version 2.0 apache license version 2",
    6: "free of charge permission granted hereby is",
    7: "under-the-mit-license" * 2,
}


def test_texts(spark):
    fill = [(100 + i, f"the of and to a text is {i} in this under") for i in range(60)]
    rows = {r.doc_id: r for r in S.scan(spark.createDataFrame([*TEXTS.items(), *fill], "doc_id long, text string")).collect()}
    for i, text in [*TEXTS.items(), *fill]:
        assert contract(rows[i]) == brute.license_base(text)
    assert rows[1].labels == "gpl-3" and rows[1].score == 1.0
    assert rows[2].labels == "mit" and rows[3].labels == "" and rows[6].labels == "" and rows[6].score == 0
    assert rows[4].labels == "cc-by-nc,mit" and rows[5].base_labels == "apache-2"


def test_places_are_relative(spark):
    """The words of a licence in another order do not make a match, though its phrase stands in the file."""
    texts = [(1, "gnu general public license version 3 " + "x " * 30 + "work this under licensed is the"),
             (2, "x " * 30 + "this work is licensed under the gnu general public license version 3")]
    fill = [(100 + i, f"other text number{i}") for i in range(50)]
    rows = {r.doc_id: r for r in S.scan(spark.createDataFrame(texts + fill, "doc_id long, text string"), least_score=0.95).collect()}
    assert rows[1].labels == "" and rows[2].labels == "gpl-3"


def test_several_whole_licences(spark):
    """Files of two to five whole licences have the labels of all of them."""
    texts, want = [], {}
    for size in (2, 3, 4, 5):
        for some in combinations(range(len(S.TEMPLATES)), size):
            if size < 4 or sum(some) % 5 == 0:
                i = len(texts)
                texts.append((i, " and then ".join(f"x{i}y{k} {S.TEMPLATES[t][1]}" for k, t in enumerate(some))))
                want[i] = {S.TEMPLATES[t][0] for t in some if any(f" {k} " in f" {S.TEMPLATES[t][1]} " for k in S.TEMPLATES[t][2])}
                assert len(want[i]) == len({S.TEMPLATES[t][0] for t in some})
    fill = [(10_000 + i, f"the of and to a text is {i} in this under that with any") for i in range(3000)]
    rows = {r.doc_id: r for r in S.scan(spark.createDataFrame(texts + fill, "doc_id long, text string")).collect()}
    lost = {i: want[i] - set(rows[i].labels.split(",")) for i in want}
    assert not {i: x for i, x in lost.items() if x}
    assert all(rows[i].score == 1.0 for i in want)


def test_edges(spark, edge, empty):
    rows = S.scan(edge).collect()
    assert len(rows) == len(edge_rows())
    want = sorted((brute.license_base(t) for _, t, _ in edge_rows()), key=str)
    assert sorted(map(contract, rows), key=str) == want
    assert [r.labels for r in rows if r.doc_id == 13] == ["mit"]
    assert S.scan(empty).count() == 0
    many = spark.createDataFrame([(1, "Released under the MIT License. " * 500)], "doc_id long, text string")
    r = S.scan(many).first()
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (500, 1, 1 + 5 * 499, "mit")


@pytest.mark.parametrize("text", ["K by nc cc by nc", "İ under the mİt license", "a\x7fb{c}"])
def test_lower_case_beyond_ascii(spark, text):
    r = S.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert contract(r) == brute.license_base(text)
