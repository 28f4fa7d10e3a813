"""Periodic runs against brute force over every lag."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from cohortkit.llm.periodic_runs import find_runs, kept_words, lag_classes, op13_periodic_runs, periodic_runs, stretched

SF = "/root/testdata/sf0.001"


def brute_runs(words, shortest=24, exponent=3):
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q):
                out.add((i, j - i + q, q))
            i = j
    least = {}
    for s, m, q in out:
        if not any(s2 <= s and s + m <= s2 + m2 and q2 < q for s2, m2, q2 in out):
            least[(s, m, q)] = True
    return sorted(least, key=lambda r: (r[0], r[2]))


def random_text(rng):
    words = []
    while len(words) < rng.choice([5, 30, 80, 300]):
        kind = rng.random()
        letters = "ab" if kind < 0.3 else "abcdefgh"
        block = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 10, 17, 18, 19, 36, 40]))]
        words += block * rng.choice([1, 1, 2, 3, 4, 9])
        if rng.random() < 0.3:
            words += block[:rng.randrange(len(block) + 1)]
    return words


def codes(words):
    return np.array([words.index(w) for w in words], np.int64)


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(8):
        words = random_text(rng)
        assert find_runs(codes(words)) == brute_runs(words)
        assert find_runs(codes(words), 6, 3) == brute_runs(words, 6, 3)
        assert find_runs(codes(words), 30, 4) == brute_runs(words, 30, 4)


def test_structured_words():
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    assert find_runs(np.array(thue)) == brute_runs(thue) == []
    fib = [0]
    last = [1]
    while len(fib) < 600:
        fib, last = fib + last, fib
    assert find_runs(np.array(fib)) == brute_runs(fib)
    assert find_runs(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    period = list(range(5000)) * 3
    assert find_runs(np.array(period)) == [(0, 15_000, 5000)]
    assert find_runs(np.array(period[:-1])) == []


@pytest.mark.parametrize("shortest,exponent", [(24, 3), (6, 3), (30, 4), (3, 3), (100, 5)])
def test_classes_cover_every_lag_with_a_guaranteed_gram(shortest, exponent):
    covered = []
    for low, high, gram in lag_classes(20_000, shortest, exponent):
        covered += range(low, high + 1)
        assert gram >= high
        for q in (low, high):
            assert max(shortest, exponent * q) - q >= gram
    assert covered[:20_000 // exponent] == list(range(1, 20_000 // exponent + 1))


def expected(doc_id, text, prepare=True):
    words = (text or "").encode().split()
    if prepare:
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query(spark, documents):
    got = {r["doc_id"]: tuple(r) for r in op13_periodic_runs(spark, SF).collect()}
    small = [(i, t) for i, t in zip(documents.doc_id, documents.text) if t is None or len(t) < 40_000]
    assert len(got) == len(documents) and len(small) > 150
    for i, t in small:
        assert got[i] == expected(i, t)
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_edges(spark, edge, empty):
    rows = periodic_runs(edge).collect()
    assert len(rows) == edge.count()
    for doc_id, text in [(r["doc_id"], r["text"]) for r in edge.collect()]:
        words = (text or "").encode().split()
        runs = brute_runs(words) if len(words) < 3000 else [(0, 30_000, 1)]
        mine = [r for r in rows if r["doc_id"] == doc_id and r["n_words"] == len(words)]
        assert any([tuple(x) for x in r["runs"]] == runs for r in mine)
    long = next(r for r in rows if r["n_words"] > 20_000)
    assert bytes(long["collapsed"]).startswith(b"x A line of")
    assert periodic_runs(empty).count() == 0


def test_kept_and_stretched():
    assert kept_words(5, []) is None
    assert kept_words(30, [(2, 24, 8)]).tolist() == [True] * 10 + [False] * 16 + [True] * 4
    assert stretched(None, [b"a"]) == [b"a"]
    with pytest.raises(ValueError):
        periodic_runs(None, exponent=2)


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame(pd.DataFrame({"doc_id": [1], "t": [b"\xff\xfe " * 30]})).selectExpr("doc_id", "cast(t as string) text")
    assert [tuple(x) for x in periodic_runs(df).first()["runs"]] == [(0, 30, 1)]
