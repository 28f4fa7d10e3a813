"""Token-ID files of patched frame-of-reference blocks.

A block holds 512 ids. Its minimum is subtracted, the rest is packed at the
width that holds a given percentile of the block, and the values that need
more bits leave their high bits in an exception list. File layout:

    "PFOR1\\0\\0\\0"
    blocks: packed words, exception positions (u16), exception high bits (u32)
    index: block starts (u64), minima (u32), exception counts (u16), widths (u8)
    documents: ids (i64), token counts (i64), deflated
    tail: JSON with the counts and places of the parts, its length (u32), "PFOR1\\0\\0\\0"

512 values are 32 rows of 16 lanes; a packed block of width w is w words of 32
bits in each lane, so that packing and unpacking are 32 array steps over all
blocks of one width.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import common, tokens

MAGIC = b"PFOR1\0\0\0"
BLOCK, _ROWS, _LANES = 512, 32, 16
#: Blocks that are encoded or decoded together.
_GROUP = 1024


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 512) of at most width bits to (blocks, width * 16) words."""
    x = values.reshape(-1, _ROWS, _LANES)
    out = np.zeros((len(x), width, _LANES), "<u4")
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        out[:, word] |= x[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= x[:, i] >> np.uint32(32 - shift)
    return out.reshape(len(x), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(-1, width, _LANES)
    out = np.empty((len(w), _ROWS, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        v = w[:, word] >> np.uint32(shift)
        if shift + width > 32:
            v = v | (w[:, word + 1] << np.uint32(32 - shift))
        out[:, i] = v & mask
    return out.reshape(len(w), BLOCK)


def encode_blocks(values: np.ndarray, percentile: float) -> tuple[bytes, dict[str, np.ndarray]]:
    """The bytes of whole blocks (blocks, 512) and the index entries, starts counted from 0."""
    low = values.min(axis=1)
    rest = values - low[:, None]
    held = np.partition(rest, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))]
    width = np.frexp(held.astype(float))[1].astype(np.uint8)  # bits of the value at the percentile; 0 for 0
    high = rest >> width[:, None].astype(np.uint32)
    high[width == 32] = 0
    n_out = np.count_nonzero(high, axis=1)
    size = width.astype(np.int64) * 4 * _LANES + n_out * 6
    start = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            mask = np.uint32((1 << int(w)) - 1)
            packed = _pack(rest[at] & mask, int(w)).view(np.uint8)
            data[start[at][:, None] + np.arange(packed.shape[1])] = packed
    block, pos = np.nonzero(high)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(n_out) - n_out)[block]
        base = start[block] + width[block].astype(np.int64) * 4 * _LANES
        data[(base + 2 * nth)[:, None] + np.arange(2)] = pos.astype("<u2").view(np.uint8).reshape(-1, 2)
        values_at = base + 2 * n_out[block] + 4 * nth
        data[values_at[:, None] + np.arange(4)] = high[block, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
    return data.tobytes(), {"start": start, "low": low, "n_out": n_out, "width": width}


def decode_blocks(data: bytes, index: dict[str, np.ndarray]) -> np.ndarray:
    """The inverse; index starts count from data's first byte."""
    raw = np.frombuffer(data, np.uint8)
    start, width, n_out = index["start"].astype(np.int64), index["width"], index["n_out"].astype(np.int64)
    out = np.zeros((len(start), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            words = raw[start[at][:, None] + np.arange(int(w) * 4 * _LANES)].view("<u4")
            out[at] = _unpack(words, int(w))
    block = np.repeat(np.arange(len(start)), n_out)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(n_out) - n_out)[block]
        base = start[block] + width[block].astype(np.int64) * 4 * _LANES
        pos = raw[(base + 2 * nth)[:, None] + np.arange(2)].view("<u2").ravel()
        high = raw[(base + 2 * n_out[block] + 4 * nth)[:, None] + np.arange(4)].view("<u4").ravel()
        out[block, pos] |= high << width[block].astype(np.uint32)
    return out + index["low"].astype(np.uint32)[:, None]


class TokenWriter:
    """Streams documents into one file; holds one group of blocks and the index."""

    def __init__(self, stream, percentile: float = 0.9):
        self.stream, self.percentile = stream, percentile
        self.at, self.held, self.n_held, self.n_tokens = len(MAGIC), [], 0, 0
        self.index: dict[str, list[np.ndarray]] = {"start": [], "low": [], "n_out": [], "width": []}
        self.doc_ids: list[int] = []
        self.doc_sizes: list[int] = []
        stream.write(MAGIC)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.doc_sizes.append(len(ids))
        self.held.append(ids.astype(np.uint32))
        self.n_held += len(ids)
        self.n_tokens += len(ids)
        if self.n_held >= _GROUP * BLOCK:
            self._flush(self.n_held // BLOCK)

    def _flush(self, blocks: int) -> None:
        ids = np.concatenate(self.held)
        for k in range(0, blocks, _GROUP):
            n = min(_GROUP, blocks - k)
            data, index = encode_blocks(ids[k * BLOCK:(k + n) * BLOCK].reshape(n, BLOCK), self.percentile)
            self.stream.write(data)
            index["start"] = index["start"] + self.at
            self.at += len(data)
            for name, column in index.items():
                self.index[name].append(column)
        self.held = [ids[blocks * BLOCK:]]
        self.n_held = len(self.held[0])

    def close(self) -> None:
        if self.n_held % BLOCK:  # the last block is filled with its own last id
            self.held.append(np.full(BLOCK - self.n_held % BLOCK, self.held[-1][-1], np.uint32))
            self.n_held += len(self.held[-1])
        if self.n_held:
            self._flush(self.n_held // BLOCK)
        tail = {"n_tokens": self.n_tokens, "n_docs": len(self.doc_ids), "n_blocks": sum(map(len, self.index["low"]))}
        kinds = {"start": "<u8", "low": "<u4", "n_out": "<u2", "width": "<u1"}
        parts = {k: np.concatenate([np.zeros(0), *self.index[k]]).astype(v).tobytes() for k, v in kinds.items()}
        parts |= {"doc_ids": zlib.compress(np.array(self.doc_ids, "<i8").tobytes()),
                  "doc_sizes": zlib.compress(np.array(self.doc_sizes, "<i8").tobytes())}
        for name, data in parts.items():
            tail[name] = [self.at, len(data)]
            self.stream.write(data)
            self.at += len(data)
        text = json.dumps(tail).encode()
        self.stream.write(text + struct.pack("<I", len(text)) + MAGIC)
        self.stream.close()


class TokenReader:
    """Random access to a file: its documents, and the ids of any range."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        (length,), magic = struct.unpack("<I", file.read_at(4, size - 12)), file.read_at(8, size - 8)
        if magic != MAGIC or file.read_at(8, 0) != MAGIC:
            raise ValueError("not a token file")
        self.tail = json.loads(file.read_at(length, size - 12 - length))
        part = lambda k: file.read_at(self.tail[k][1], self.tail[k][0])
        self.index = {k: np.frombuffer(part(k), t) for k, t in
                      {"start": "<u8", "low": "<u4", "n_out": "<u2", "width": "<u1"}.items()}
        self.doc_ids = np.frombuffer(zlib.decompress(part("doc_ids")), "<i8")
        self.doc_sizes = np.frombuffer(zlib.decompress(part("doc_sizes")), "<i8")

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks first to last - 1."""
        if last <= first:
            return np.zeros(0, np.uint32)
        begin = int(self.index["start"][first])
        end = int(self.index["start"][last]) if last < len(self.index["start"]) else self.tail["start"][0]
        part = {k: v[first:last] for k, v in self.index.items()}
        part["start"] = part["start"].astype(np.int64) - begin
        return decode_blocks(self.file.read_at(end - begin, begin), part).ravel()

    def read(self, start: int, n: int) -> np.ndarray:
        first, last = start // BLOCK, -(-(start + n) // BLOCK)
        return self.blocks(first, last)[start - first * BLOCK:start - first * BLOCK + n]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc id, start in the file, ids), decoded a group of blocks at a time."""
        held, begin, start, n_blocks = np.zeros(0, np.uint32), 0, 0, self.tail["n_blocks"]
        block = 0
        for doc_id, n in zip(self.doc_ids.tolist(), self.doc_sizes.tolist()):
            parts = [held[start - begin:]]
            have = len(parts[0])
            if have < n:
                while have < n:
                    parts.append(self.blocks(block, min(block + _GROUP, n_blocks)))
                    block = min(block + _GROUP, n_blocks)
                    have += len(parts[-1])
                held, begin = np.concatenate(parts), start
            yield doc_id, start, held[start - begin:start - begin + n]
            start += n


def _write(folder: str, tokenizer: str, end_id: int | None, percentile: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, path, writer = tokens.encoder(tokenizer), common.task_file(folder, ".pfor"), None
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            for part in common.by_bytes(batch, tokens.TOGETHER):
                for doc_id, ids in zip(part["doc_id"].to_pylist(), enc.encode(part["text"].to_pylist())):
                    writer = writer or TokenWriter(common.create(path), percentile)
                    writer.add(doc_id, np.concatenate([ids, tail]))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "part": [TaskContext.get().partitionId()],
                                              "n_docs": [len(writer.doc_ids)],
                                              "n_tokens": [writer.n_tokens]},
                                             pa.schema([("path", pa.string()), ("part", pa.int32()),
                                                        ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = 2,
                      percentile: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of all texts in ascending id order and returns the
    manifest (path, part, start, n_docs, n_tokens), one row per file; start
    counts the ids of all files before it.

    Null texts are empty (their end id alone), null ids come first and are
    stored as the lowest integer, rows that share an id follow each other by
    text hash, an empty table writes no file, other columns are not read.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63))).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", common.row_hash())
    written = materialize(dealt.mapInArrow(_write(folder, tokenizer or tokens.default_tokenizer(), end_id, percentile),
                                           "path string, part int, n_docs long, n_tokens long"), "token-manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return written.select("path", "part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"),
                          "n_docs", "n_tokens")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
            store, at = common.open_store(path)
            with store.open_input_file(at) as file:
                rows = [(doc_id, start + s, len(ids), tokens.crc32(ids))
                        for doc_id, s, ids in TokenReader(file).documents()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files; a task reads whole files."""
    files = materialize(manifest, "token-files")
    dealt = files.repartition(max(1, files.count())).select("path", "start")
    return dealt.mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum as read back from the token files."""
    docs = common.table(spark, sf_dir, "documents")
    return read_digests(write_token_files(docs, scratch_path(spark, "token-files")))
