import random
import shutil
import tempfile
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, edge_rows
from cohortkit.llm import packing as P
from cohortkit.llm import token_files as T
from cohortkit.llm import tokens
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sT .,\n\t\r\x0b\x1c\x85\xa0  é1_", max_size=40))
def test_piecewise_ids_are_the_library_s(text):
    enc = tokens.encoder(tokens.default_tokenizer())
    assert enc.by_piece
    want = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert enc.encode([text])[0].tolist() == want


def test_encoder_past_its_bound(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "_ENTRIES", 50)
    enc = tokens.Encoder(tokens.default_tokenizer())
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdefg", k=rng.randrange(1, 60))) for _ in range(40)) for _ in range(30)]
    texts += ["<|endoftext|> a <|endoftext|>", "", " ", "  x"]
    for _ in range(2):
        got = enc.encode(texts)
        assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.integers(0, 32), st.integers(0, 40))
def test_blocks_round_trip(seed, bits, outliers):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2 ** bits, (3, T.BLOCK), dtype=np.uint64).astype(np.uint32)
    values[1, :outliers] = rng.integers(0, 2 ** 32, outliers)
    values[2] = 77
    data, index = T.encode_blocks(values, 0.9)
    assert (T.decode_blocks(data, index) == values).all()


def test_file_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    docs = [(int(i), rng.zipf(1.3, rng.choice([0, 1, 5, 511, 512, 513, 40_000])) % 50_000) for i in range(60)]
    sink = pa.BufferOutputStream()
    writer = T.TokenWriter(sink)
    for i, ids in docs:
        writer.add(i, ids)
    stream_end = sink
    writer.stream = type("Open", (), {"write": sink.write, "close": lambda self: None})()
    writer.close()
    data = stream_end.getvalue()
    reader = T.TokenReader(pa.BufferReader(data))
    whole = np.concatenate([x for _, x in docs])
    start = 0
    for (i, ids), (j, s, got) in zip(docs, reader.documents(), strict=True):
        assert (i, start) == (j, s) and (got == ids).all()
        start += len(ids)
    for at in rng.integers(0, len(whole) - 2000, 20):
        assert (reader.read(int(at), 2000) == whole[at:at + 2000]).all()
    assert data.size < 2 * len(whole) + 20_000  # under two bytes an id


def test_op4_against_the_library(spark, documents, tokenizer):
    rows = {r.doc_id: r for r in T.op4_token_files(spark, SF).collect()}
    start = 0
    for i, text in sorted(zip(documents.doc_id, documents.text)):
        ids = brute.token_ids(tokenizer, text, 2)
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), brute.crc(ids))
        start += len(ids)


def test_token_files_edges(spark, edge, empty, tokenizer):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    manifest = T.write_token_files(edge, folder)
    rows = sorted(T.read_digests(manifest).collect(), key=lambda r: r.start)
    assert len(rows) == len(edge_rows()) and rows[0].doc_id == -(2 ** 63)
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    want = sorted(brute.crc(brute.token_ids(tokenizer, t, 2)) for _, t, _ in edge_rows())
    assert sorted(r.ids_crc32 for r in rows) == want
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    assert T.read_digests(T.write_token_files(empty, folder + "/none")).count() == 0
    shutil.rmtree(folder)


def check_pieces(rows, texts, tokenizer, end=0):
    """Every id in one piece, sequences gapless, full ones of 1024, the rest powers of two."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = brute.token_ids(tokenizer, texts[i], end)
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), brute.crc(ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    sizes = []
    for seq in range(len(by_seq)):
        at = 0
        for r in sorted(by_seq[seq], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    full = sum(sizes) // 1024
    assert sizes[:full] == [1024] * full
    assert all(n & (n - 1) == 0 for n in sizes[full:]) and sizes[full:] == sorted(sizes[full:], reverse=True)


def test_op9(spark, documents, tokenizer):
    check_pieces(P.op9_mixture_packing(spark, SF).collect(), dict(zip(documents.doc_id, documents.text)), tokenizer)


@pytest.mark.parametrize("mixture", [None, {"s0": 3, "s1": 1}, {"s2": 0.5}])
def test_packing_edges(spark, edge, empty, tokenizer, mixture):
    unique = edge.filter("doc_id NOT IN (8, 14)")
    texts = {i: t for i, t, _ in edge_rows() if i not in (8, 14, None)}
    check_pieces(P.pack(unique, mixture=mixture, window=2048).collect(), texts, tokenizer)
    every = P.pack(edge, mixture=mixture, with_ids=True).collect()
    assert sum(r.length for r in every) == sum(len(brute.token_ids(tokenizer, t, 0)) for _, t, _ in edge_rows())
    for r in every:
        assert brute.crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
    assert P.pack(empty, mixture=mixture).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=6), st.data(), st.integers(16, 700))
def test_schedule_is_deficit_round_robin(sizes, data, window):
    """The closed form against windows run one after the other."""
    weights = data.draw(st.lists(st.integers(0, 50), min_size=len(sizes), max_size=len(sizes)))
    s = P.Schedule(sizes, weights, window)
    total = sum(sizes)
    # Every token has one place, and the places are the stream without gaps.
    places = {}
    for q, n in enumerate(sizes):
        at = 0
        while at < n:
            step = min(n - at, 37)
            for start, size, place in s.places(q, at, step):
                for k in range(size):
                    assert place + k not in places
                    places[place + k] = (q, start + k)
            at += step
    assert sorted(places) == list(range(total))
    order = [places[i] for i in range(total)]
    for q in range(len(sizes)):
        assert [t for p, t in order if p == q] == list(range(sizes[q]))
    # While all queues last, each is within a token of its share after every window.
    if total and all(w > 0 for w in weights):
        end = s.phases[1][0] if len(s.phases) > 1 else s.windows * window
        for k in range(1, end // window + 1):
            for q, w in enumerate(weights):
                if sizes[q] > s.of(q, k):
                    assert abs(s.of(q, k) - k * window * w / sum(x for x, n in zip(weights, sizes) if n)) < 1


def test_windows_hold_the_target_mixture(spark, documents):
    rows = P.pack(spark.createDataFrame(documents[["doc_id", "text", "source"]]), window=4096,
                  mixture={"src0": 2, "src1": 1, "src2": 1}).collect()
    source = dict(zip(documents.doc_id, documents.source))
    first = [r for r in rows if r.sequence_id < 8]  # two windows
    share = defaultdict(int)
    for r in first:
        share[source[r.doc_id]] += r.length
    assert abs(share["src0"] - 4096) <= 4 and abs(share["src1"] - 2048) <= 4 and abs(share["src2"] - 2048) <= 4


@pytest.mark.parametrize("window,sources,bound", [(4096, 1100, 0.25), (512, 1100, 0.35)])
def test_many_small_sources_keep_their_shares(spark, tokenizer, window, sources, bound):
    """Sources of like size, more than 1,024, documents of a source side by side: every stretch holds all alike,
    with queues of their own (a token and more for every window) or in the shared one."""
    docs = [(i, "one two three four five six", f"d{i * sources // 4400:05d}") for i in range(4400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = P.pack(frame, window=window).collect()
    check_pieces(rows, {i: t for i, t, _ in docs}, tokenizer)
    total = sum(r.length for r in rows)
    half = sum(r.length for r in rows if r.sequence_id * 1024 < total // 2)
    low = sum(r.length for r in rows if r.sequence_id * 1024 < total // 2 and r.doc_id < 2200)
    assert abs(low / half - 0.5) < 0.05  # half of the sources, half of the first half
    per = defaultdict(int)
    for r in rows:
        if r.sequence_id * 1024 < total // 2:
            per[docs[r.doc_id][2]] += r.length
    mean = half / sources
    assert np.mean([abs(per[f"d{i:05d}"] - mean) for i in range(sources)]) < bound * mean


@pytest.mark.parametrize("plain", [False, True])
def test_encoder_cuts_as_the_library_does(plain):
    """Spaces, breaks, quotes, runs of punctuation, letters of several scripts, NUL and special tokens, in any order."""
    signs = "aab Z'''1.,é\n\t  ĠßñǅªµЖ×÷ \x1c\x85　中 ssTtre_\0<|>$$$"
    rng = random.Random(5)
    enc = tokens.Encoder(tokens.default_tokenizer(), plain)
    for _ in range(30):
        texts = ["".join(rng.choices(signs, k=rng.randrange(80))) + rng.choice(["", "<|endoftext|>", " <|endoftext|> x"])
                 for _ in range(40)]
        assert [x.tobytes() for x in enc.encode(texts)] == enc._direct(texts)
    assert len(enc.tails) <= 33 ** tokens._TAIL


def test_new_words_are_sorted_by_one_pattern(tmp_path):
    """Words of Latin letters, with signs after them or without, have the library's ids; the model of words is the
    tokenizer's own, unless an added token could stand in a word."""
    import json

    from tokenizers import AddedToken, Tokenizer

    from cohortkit.llm import tokens

    letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
    cores = ["plain", "äöüß", "İstanbul", letters[52:90], "ɐx", "x1", "naïve", letters[90:]]
    text = "a " + " ".join(c + t for c in cores for t in ("", ",", "?!)", "....", "'s", "-\n")) + "  end \n x"
    encoder = tokens.Encoder(tokens.default_tokenizer())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):  # at first all are new, then known
        assert encoder.encode([text])[0].tolist() == want
    assert tokens._WORD("naïve?!)").groups() == ("naïve", "?!)") and not tokens._WORD("x1") and not tokens._WORD("ab....")
    assert not encoder.words.get_added_tokens_decoder()  # not a second copy of the tokenizer
    with_word = Tokenizer.from_file(tokens.default_tokenizer())
    with_word.add_tokens([AddedToken("plain", normalized=False)])
    path = str(tmp_path / "with_word.json")
    with_word.save(path)
    assert json.load(open(path))["added_tokens"]
    other = tokens.Encoder(path)
    assert other.encode(["so plain, so explaining"])[0].tolist() == \
        with_word.encode("so plain, so explaining", add_special_tokens=False).ids


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.inner, self.characters = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode_batch_fast(self, texts, **options):
        self.characters += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


def test_simple_pieces_skip_the_cutting_rules():
    rng = random.Random(4)
    words = ["Ab", "naïve", "x1", "2024", "co-op", "a.b", "(so)", "###", "end....", "ª", "q_r"]
    pieces = ["\n".join(rng.choice(words) + rng.choice(["", ".", ',"', "?!..!"]) for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(4000)]
    text = "first " + " ".join(pieces)
    encoder = tokens.Encoder(tokens.default_tokenizer())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder.tokenizer = Counting(encoder.tokenizer)
    assert encoder.encode([text])[0].tolist() == want
    assert encoder.tokenizer.characters < 500  # the first piece and the runs of punctuation


def test_a_vocabulary_across_cuts_keeps_the_cutting_rules(tmp_path):
    import json
    from tokenizers import Tokenizer
    for left, right in (("d", "."), (".", "Ċ"), ("Ċ", "x"), ("x", "1"), ("d", "Ġ"), ("Ġ", "Ġ")):
        spec = json.loads(Tokenizer.from_file(tokens.default_tokenizer()).to_str())
        vocabulary = spec["model"]["vocab"]
        if left + right not in vocabulary:
            vocabulary[left + right] = max(vocabulary.values()) + 1
        spec["model"]["merges"].insert(0, [left, right])
        path = tmp_path / "tokenizer.json"
        path.write_text(json.dumps(spec))
        encoder = tokens.Encoder(str(path))
        assert (encoder.words is None) == (right != "Ġ" or left != "Ġ")
        text = "The end.\nx1 and. the  end\n\nx1 d x. " * 3
        assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
