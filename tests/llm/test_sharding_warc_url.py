import tempfile
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from conftest import SF, edge_rows
from cohortkit.llm import sharding as S
from cohortkit.llm import url_filter as U
from cohortkit.llm import warc as A
from cohortkit.session import scratch_path
from pyspark.sql import functions as F


def gapless(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    return all(sorted(x) == list(range(len(x))) for x in by.values())


def test_op5(spark, documents):
    rows = S.op5_rendezvous_shards(spark, SF).collect()
    texts = dict(zip(documents.doc_id, documents.text))
    assert len(rows) == len(texts) and gapless(rows)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)


def test_weights_and_growth(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.0, 5.0]
    rows = S.shard_records(ids, weights=weights, new_weights=[2.0]).collect()
    count = Counter(r.shard for r in rows)
    for shard, w in enumerate(weights):
        assert abs(count[shard] / 40_000 - w / 8) < 0.01
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 4 for r in moved) and abs(len(moved) / 40_000 - 0.2) < 0.01
    assert gapless(rows)
    # Heavier weight of one shard: rows go to it alone.
    more = ids.select("doc_id", S.shard_of(["doc_id"], weights).alias("a"), S.shard_of(["doc_id"], [1.0, 2.0, 0.0, 6.0]).alias("b"))
    assert more.filter("a <> b AND b <> 3").count() == 0


def test_sharding_edges(spark, edge, empty):
    rows = S.shard_records(edge).collect()
    assert len(rows) == len(edge_rows()) and gapless(rows)
    assert set(edge.columns) | {"grown_shard"} == set(rows[0].asDict())
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.shard)
    assert all(len(x) == 1 for x in by_id.values())
    assert S.shard_records(empty).count() == 0
    with pytest.raises(ValueError):
        S.shard_of(["doc_id"], [0.0])
    hot = spark.range(5000).select(F.lit(1).alias("doc_id"))
    assert gapless(S.shard_records(hot).collect())


def test_op3(spark, pages):
    want = brute.warc(list(zip(pages.page_id, pages.html)))
    rows = A.op3_warc_archives(spark, SF).collect()
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}
    assert got == want


def warc_rows():
    big = "<p>" + "é" * 200_000
    return [(1, "http://a.b/c d\r\nX: y", None), (2, None, ""), (3, "http://a", big), (4, "http://b", big),
            (5, "u", "x\r\n\r\nWARC/1.1\r\n"), (6, "u", "small"), (7, "u", "small"), (-5, "u", "small")]


def test_archives_hold_the_payloads(spark):
    rows = [(i, u, h, 1, "x") for i, u, h in warc_rows()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, id long, payload string")
    chunks = A.read_warc(A.write_warc(pages, scratch_path(spark, "warc"), min_revisit_bytes=6, chunk=1000), chunk=777).collect()
    digests = {r.page_id: tuple(r)[1:] for r in A.record_digests(spark.createDataFrame(chunks)).collect()}
    assert digests == brute.warc([(i, h) for i, _, h in warc_rows()], least=6)
    parts = defaultdict(dict)
    for c in chunks:
        parts[c.id][c.chunk_no] = (c.offset, bytes(c.data))
    for i, _, html in warc_rows():
        data = b"".join(parts[i][k][1] for k in range(len(parts[i])))
        assert data == (b"" if i == 4 else (html or "").encode())
        assert all(len(d) <= 777 for _, d in parts[i].values())
    # Each row's digest is of the payload up to its end.
    import hashlib
    for i in (3, 5):
        sha = hashlib.sha1()
        for c in sorted((c for c in chunks if c.id == i), key=lambda c: c.chunk_no):
            sha.update(bytes(c.data))
            assert c.digest == A.base32(sha.digest())


def test_warc_edges(spark):
    schema = "page_id long, url string, html string"
    rows = [(None, "u", "a"), (2, "u", "a"), (2, "u", "a"), (2, "u", "other")]
    got = A.record_digests(A.read_warc(A.write_warc(spark.createDataFrame(rows, schema), scratch_path(spark, "w")))).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == [
        (-(2 ** 63), 1, "response", 0), (2, 1, "revisit", -(2 ** 63)), (2, 1, "revisit", -(2 ** 63)), (2, 5, "response", 0)]
    none = A.write_warc(spark.createDataFrame([], schema), scratch_path(spark, "w"))
    assert A.record_digests(A.read_warc(none)).count() == 0


def test_archives_are_gzip_members(spark, pages):
    import gzip
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    A.write_warc(spark.createDataFrame(pages.head(5)), folder)
    from pathlib import Path
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: response\r\n") == 5


def test_op2_rules_and_list(spark, pages):
    rows = {r.page_id: r for r in U.op2_url_filter(spark, SF).collect()}
    assert len(rows) == len(pages)
    for i, url in zip(pages.page_id, pages.url):
        host, path, rule, verdict = brute.url_rule(url)
        listed = any(f"{name}." in f"{host}." and name in host.split(".") for name in U.LISTED_HOSTS)
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if listed else "allow"))
        assert r.maybe_listed or not listed or rule


def test_url_edges(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.ORG:80/a/?b=2&utm_source=x&a=1#f"),
            (5, "https://example.org/a?a=1&b=2"), (6, "x://example.org"), (7, "a://b://c/d"), (8, "http://net/"),
            (9, "http://x.NET/y"), (10, "http://notnet/"), (11, "http://org/fr/x"), (12, "http://É.org/fr/"),
            (13, "http://example.org/a?a=1&b=3"), (5, "https://example.org/a?a=1&b=2")]
    pages = spark.createDataFrame([(*u, 1, "x", 2) for u in urls],
                                  "page_id long, url string, host long, block string, w0 long")
    listed = spark.createDataFrame([("http://example.org/a?a=1&b=2",), (None,), ("junk",)], "url string")
    rows = U.filter_urls(pages, listed, U.RULES).collect()
    assert len(rows) == len(urls)
    by = dict(urls)
    for r in rows:
        host, path, rule, verdict = brute.url_rule(by[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.page_id in (4, 5) else "allow"))
    assert all(r.verdict == "allow" for r in U.filter_urls(pages, listed.limit(0)).collect())
    assert U.filter_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    name = lambda n, tag: spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit(f"http://{tag}/"), F.col("id")).alias("url"))
    listed = name(20_000, "listed")
    out = U.filter_urls(name(20_000, "listed").unionByName(name(20_000, "other")), listed)
    assert out.filter("host = 'listed' AND (verdict = 'allow' OR NOT maybe_listed)").count() == 0
    assert out.filter("host = 'other' AND verdict = 'block'").count() == 0
    assert out.filter("host = 'other' AND maybe_listed").count() < 400
