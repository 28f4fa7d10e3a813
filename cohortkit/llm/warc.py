"""WARC archives by way of a chunked record table.

A payload is never held whole by this code: it travels as rows (record, chunk
number, bytes), in order, each with the digest of the payload up to its end.
The last chunk's digest is the payload's. The writer copies chunks into the
archive as they come, the reader makes them again from the archive's bytes,
whatever a record's size. Each record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import common

CHUNK = 64 * 1024
#: A fixed date: writing the same pages again gives the same archives.
_DATE = "2000-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode().rstrip("=")


def _add_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of a record come one after the other within a partition."""
    sha = hashlib.sha1()
    for batch in batches:
        digests = []
        for no, data in zip(batch["chunk_no"].to_pylist(), batch["data"]):
            if no == 0:
                sha = hashlib.sha1()
            sha.update(data.as_buffer())
            digests.append(base32(sha.digest()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())],
                                         names=[*batch.schema.names, "digest"])


def chunk_records(records: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                  chunk: int = CHUNK, extra: tuple[str, ...] = ()) -> DataFrame:
    """The chunked record table of a payload column: one row (id, chunk_no,
    last, offset, data, digest) per ``chunk`` bytes, in order within its
    partition; an empty or null payload has one empty chunk."""
    size = F.octet_length("payload")
    chunks = F.greatest(F.lit(1), F.ceil(size / chunk)).cast("int")
    rows = records.select(F.col(id_col).cast("long").alias("id"), common.utf8(payload_col).alias("payload"), *extra)
    rows = rows.select("id", "payload", chunks.alias("n"), *extra,
                       F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk_no"))
    rows = rows.select("id", "chunk_no", (F.col("chunk_no") == F.col("n") - 1).alias("last"),
                       (F.col("chunk_no") * F.lit(chunk).cast("long")).alias("offset"),
                       F.col("payload").substr(F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"), *extra)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_add_digests, f"{fields}, digest string")


def payload_digests(records: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, payload_bytes, payload_digest): the last chunks of the table."""
    return (chunk_records(records, id_col, payload_col, extra=extra).filter("last")
            .select("id", *extra, (F.col("offset") + F.octet_length("data")).alias("payload_bytes"),
                    F.col("digest").alias("payload_digest")))


def with_revisits(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds record_type and refers_to: of records with equal payloads of at
    least ``min_bytes`` the one with the smallest id is the response."""
    firsts = (digests.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
              .filter("copies > 1").drop("copies"))
    # Payloads without a copy have a key of their own, so the join is even but
    # for the copies, whose skew the adaptive join splits.
    rows = digests.join(firsts, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("id"))
    return rows.select(*digests.columns,
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("first_id")).alias("refers_to"))


def _header(row: dict) -> bytes:
    """Everything of a record before its payload."""
    uri = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in row["uri"] or "")
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    response = row["record_type"] == "response"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:record:{row['id']}>",
             f"WARC-Date: {_DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}"]
    if not response:
        lines += [f"WARC-Refers-To: <urn:record:{row['refers_to']}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    size = len(http) + (row["payload_bytes"] if response else 0)
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, path, n = None, common.task_file(folder, ".warc.gz"), 0
        for batch in batches:
            data = batch["data"]
            heads = batch.select([i for i, c in enumerate(batch.schema.names) if c != "data"]).to_pylist()
            for k, row in enumerate(heads):
                stream = stream or common.create(path)
                if row["chunk_no"] == 0:
                    member = zlib.compressobj(1, wbits=31)
                    stream.write(member.compress(_header(row)))
                    n += 1
                if row["record_type"] == "response":
                    stream.write(member.compress(data[k].as_buffer()))
                if row["last"]:
                    stream.write(member.compress(b"\r\n\r\n") + member.flush())
        if stream:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])
    return run


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, id_col: str = "page_id",
               url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK) -> DataFrame:
    """Writes a record per row and returns the manifest (path, records), one row per archive.

    ``id_col`` identifies records: rows with a null id are written with the
    lowest integer, rows that share an id share the record of its digest.
    Null payloads are empty, null urls too; an empty table writes no archive.
    """
    row_id = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63)))
    rows = pages.select(row_id.alias("id"), F.col(url_col).alias("uri"), F.col(payload_col).alias("payload"),
                        F.xxhash64(payload_col).alias("hash"))
    # First pass: a record's header states its digest, so all digests come before any writing.
    digests = materialize(payload_digests(rows, "id", "payload", ("hash",)).distinct(), "payload-digests")
    types = with_revisits(digests, min_revisit_bytes)
    chunks = chunk_records(rows.join(types, ["id", "hash"]), "id", "payload", chunk,
                           ("uri", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    return materialize(chunks.mapInArrow(_write(folder), "path string, records long"), "warc-manifest")


@dataclass
class _Record:
    type: str
    id: int
    refers_to: int | None
    digest: str
    http: bytearray = field(default_factory=bytearray)


class _Members:
    """The bytes of a file of gzip members, some at a time."""

    def __init__(self, file):
        self.file, self.raw, self.member = file, b"", None

    def read(self, n: int) -> bytes:
        """At most n bytes; none at the end."""
        while True:
            if not self.raw and not (self.member and self.member.unconsumed_tail):
                self.raw = self.file.read(1 << 18)
                if not self.raw:
                    return b""
            if self.member is None:
                self.member = zlib.decompressobj(wbits=31)
            out = self.member.decompress(self.member.unconsumed_tail + self.raw, n)
            self.raw = b""
            if self.member.eof:
                self.raw, self.member = self.member.unused_data, None
            if out:
                return out


def read_records(file, chunk: int = CHUNK) -> Iterator[tuple[_Record, int, int, bytes, str, bool]]:
    """(record, chunk number, offset, data, digest up to its end, last) from an
    archive's stream; holds one chunk and the headers."""
    held = b""

    def fill(n: int) -> bool:
        nonlocal held
        while len(held) < n:
            more = file.read(max(chunk, n - len(held)))
            if not more:
                return False
            held += more
        return True

    def head(limit: int) -> bytes:
        nonlocal held
        at = held.find(b"\r\n\r\n")
        while at < 0:
            if len(held) > limit or not fill(len(held) + 1):
                raise ValueError("a record header without end")
            at = held.find(b"\r\n\r\n")
        out, held = held[:at], held[at + 4:]
        return out

    while fill(1):
        fields = dict(x.split(": ", 1) for x in head(1 << 20).decode().split("\r\n")[1:])
        number = lambda s: int(s.removeprefix("<urn:record:").removesuffix(">"))
        record = _Record(fields["WARC-Type"], number(fields["WARC-Record-ID"]),
                         number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
                         fields["WARC-Payload-Digest"].removeprefix("sha1:"))
        http = head(1 << 20)
        record.http.extend(http)
        left = int(fields["Content-Length"]) - len(http) - 4
        sha, no, offset = hashlib.sha1(), 0, 0
        while no == 0 or left:
            n = min(left, chunk)
            if not fill(n):
                raise ValueError("a record is cut off")
            data, held = held[:n], held[n:]
            left -= n
            sha.update(data)
            yield record, no, offset, data, base32(sha.digest()), not left
            no, offset = no + 1, offset + n
        if not fill(4) or held[:4] != b"\r\n\r\n":
            raise ValueError("a record without its end")
        held = held[4:]


def _read(chunk: int, with_data: bool):
    names = ["id", "record_type", "refers_to", "stated_digest", "stated_bytes", "chunk_no", "last", "offset", "n",
             "digest"] + ["data"] * with_data
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(),
             pa.int32(), pa.string()] + [pa.binary()] * with_data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                store, at = common.open_store(path)
                rows: list[tuple] = []
                with store.open_input_stream(at, compression=None) as file:
                    for r, no, offset, data, digest, last in read_records(_Members(file), chunk):
                        size = int(r.http.rpartition(b"Content-Length: ")[2])
                        rows.append((r.id, r.type, r.refers_to, r.digest, size, no, last, offset, len(data), digest)
                                    + (data,) * with_data)
                        if len(rows) * (chunk if with_data else 200) >= 8_000_000:
                            yield _batch(rows, names, kinds)
                            rows = []
                if rows:
                    yield _batch(rows, names, kinds)
    return run


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_warc(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of archives: a task streams whole archives.
    Without data the bytes are read and digested all the same, and left out."""
    schema = ("id long, record_type string, refers_to long, stated_digest string, stated_bytes long, chunk_no int, "
              "last boolean, offset long, n int, digest string" + ", data binary" * with_data)
    return manifest.repartition(max(1, manifest.count())).mapInArrow(_read(chunk, with_data), schema)


def record_digests(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from
    the last chunks; those of a revisit are the ones its header states."""
    response = F.col("record_type") == "response"
    return chunks.filter("last").select(
        F.col("id").alias("page_id"),
        F.when(response, F.col("offset") + F.col("n")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives written."""
    manifest = write_warc(common.table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return record_digests(read_warc(manifest, with_data=False))
