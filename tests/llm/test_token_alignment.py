"""Token alignment against a plain merge of both tokenizers' byte ranges."""

import hashlib
from collections import Counter

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortkit.llm import token_alignment as TA

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def spans(parts):
    at = 0
    for i, raw in parts:
        yield i, at, at + len(raw)
        at += len(raw)


def brute(texts, libraries):
    """Per text: (n_a, n_b, groups as text, links), from the libraries' own pieces."""
    a, b = libraries
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        raw = b" " + text.encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        pieces_a = [(i, TA.byte_level(a.id_to_token(i))) for i in ids_a]
        pieces_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            pieces_b.append((i, bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        if b"".join(x for _, x in pieces_a) != raw or b"".join(x for _, x in pieces_b) != raw:
            out.append(None)
            continue
        sa, sb = list(spans(pieces_a)), list(spans(pieces_b))
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups, links, k, m = [], [], 0, 0
        for end in ends:
            ga, gb = [], []
            while k < len(sa) and sa[k][2] <= end:
                ga.append(sa[k])
                k += 1
            while m < len(sb) and sb[m][2] <= end:
                gb.append(sb[m])
                m += 1
            links += [(x[0], y[0]) for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
            groups.append(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(x[0]) for x in gb))
        out.append((len(ids_a), len(ids_b), groups, links))
    counts = Counter(x for o in out if o for x in o[3])
    most = {}
    for (x, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    rows = []
    for o in out:
        if o is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            rows.append((o[0], o[1], len(o[2]), len(o[3]), sum(counts[x] == most[x[1]] for x in o[3]),
                         sum(counts[x] for x in o[3]), hashlib.sha256(";".join(o[2]).encode()).hexdigest()))
    return rows


def test_query(spark, documents, libraries):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in TA.op11_token_alignment(spark, SF).collect()}
    want = dict(zip(documents.doc_id, brute(documents.text, libraries)))
    assert got == want


def test_edges_and_rare_pairs_by_shuffle(spark, edge, empty, libraries):
    texts = [r["text"] for r in edge.collect()]
    want = sorted(brute(texts, libraries))
    for hot in (TA.HOT_PAIRS, 50, 0):
        rows = TA.aligned_tokens(edge, hot_pairs=hot).collect()
        assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == want
    assert TA.aligned_tokens(empty).count() == 0
    assert [r["doc_id"] for r in rows].count(None) == 1


ODD = ["  two  spaces   ", "\n\n tab\t\x00 nul \x0b", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mark▁mark", "ａｂ ﬁ ½",
       "é ​ x", "日本語の文章。 ทดสอบ", "🙂🙂 🏳️‍🌈", " ", "\n", "a", "﻿bom", "don't we'll  I'm", "x" * 5000 + " " * 300, "\U0010ffff"]


def test_odd_texts(spark, libraries):
    df = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(ODD)), "text": ODD}))
    rows = {r["doc_id"]: r for r in TA.aligned_tokens(df, with_groups=True).collect()}
    for i, want in enumerate(brute(ODD, libraries)):
        assert tuple(rows[i][c] for c in COLUMNS) == want, ODD[i]
        if want[-1]:
            assert hashlib.sha256(rows[i]["groups"].encode()).hexdigest() == want[-1]
        else:
            assert rows[i]["groups"] is None
    assert sum(bool(r["n_a"]) for r in rows.values()) > 8


def test_invalid_utf8_has_no_tokens(spark):
    df = spark.createDataFrame(pd.DataFrame({"doc_id": [1, 2], "t": [b"ok \xff\xfe", b"ok"]})).selectExpr("doc_id", "cast(t as string) text")
    rows = {r["doc_id"]: r for r in TA.aligned_tokens(df).collect()}
    assert rows[1]["n_a"] == 0 and rows[1]["groups_sha256"] == "" and rows[2]["n_a"] > 0


def test_windows_are_cleared_when_full(spark, documents, libraries, monkeypatch):
    monkeypatch.setattr(TA, "_WINDOWS", 100)
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligner = TA.Aligner(TA.ByteLevelSide(a), TA.PieceSide(b))
    texts = [t for t in documents.text if t][:60]
    want = brute(texts, libraries)
    for text, w in zip(texts, want):
        ids = [aligner.a.encode([text]), aligner.b.encode([text])]
        found = aligner.windows([b" " + text.encode()], *ids)[0]
        assert aligner.n_links(found).sum() == w[3] and aligner.n_groups[found].sum() == w[2]
        ends, pairs, times = aligner.pairs([found])
        assert times.sum() == w[3] and len(set(pairs.tolist())) == len(pairs) == ends[0]


def test_freed_memory_is_given_back(monkeypatch):
    """A worker keeps no freed memory from one part of its texts to the next."""
    import public_tokenizers
    import pyarrow as pa
    import pyspark

    from cohortkit.llm import common, token_alignment, tokens

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    given = []
    monkeypatch.setattr(pyspark, "TaskContext", Task)
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(token_alignment, "_BYTES", 30)
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array([b"some words of a text"] * 4)], names=["id", "text"])
    run = token_alignment._align(tokens.default_tokenizer(), public_tokenizers.path("piece_bpe_32k.model"), False)
    parts = list(run(iter([batch])))
    assert len(parts) > 1 and len(given) == len(parts) and sum(p.num_rows for p in parts) == 4
