"""Periodic runs: stretches of a text that repeat a block of words three times or more.

A run of least period q and length L repeats its words at lag q over L - q
places. With L >= max(shortest, exponent * q) no such overlap is shorter than
max(shortest - q, (exponent - 1) * q). Lags are taken in classes [m, 2m), and
for each class the text's k-grams are indexed, k being the least overlap that a
run of the class guarantees. A run's first k-gram stands again q words on; and
nowhere between, for the gram would then have periods d and q - d, hence one
that divides q, and so would the run. So in a class the pairs of neighbouring
occurrences, at most one per word, hold a seed of every run.

Seeds are extended along their diagonal (same lag) to both sides. A table of
the place to which each lag is covered lets the later seeds of a diagonal
that was extended go without a second look. What comes out is a maximal
repetition at its least period.

Gram hashes of length 2k are mixed from two of length k, so texts built to
make polynomial hashes collide have no effect; every pair is verified by the
extension. Grams that stand once in a text are dropped before the next class.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words that a diagonal's extension compares at a time, growing fourfold.
_STEP = 64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * _K1 + (right ^ (right >> np.uint64(29))))


def _extend(codes: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` on."""
    end, step = len(codes) - lag, _STEP
    while at < end:
        stop = min(end, at + step)
        same = codes[at:stop] == codes[at + lag:stop + lag]
        first = int(same.argmin())
        if not same[first]:
            return at + first
        at, step = stop, step * 4
    return at


def _extend_back(codes: np.ndarray, at: int, lag: int) -> int:
    """The first place of the stretch before ``at`` whose words are the same ``lag`` on."""
    step = _STEP
    while at > 0:
        begin = max(0, at - step)
        same = codes[begin:at] == codes[begin + lag:at + lag]
        if not same.all():
            return at - int(same[::-1].argmin())
        at, step = begin, step * 4
    return at


def lag_classes(n: int, shortest: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, gram length) of the classes that a text of n words can have runs of."""
    low = 1
    while max(shortest, exponent * low) <= n:
        flat = shortest // exponent  # up to this lag the shortest run sets the overlap
        high = max(low, flat) if low <= flat else 2 * low - 1
        gram = max(shortest - high, (exponent - 1) * low)
        yield low, high, gram
        low = high + 1


def find_runs(codes: np.ndarray, shortest: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of the codes, by start, then period."""
    n, runs = len(codes), []
    # hashes of all grams of length `have`, at the places that may still start a repeated gram
    hashes, have = _mix(codes.astype(np.uint64) + _K1), 1
    alive = None
    for low, high, gram in lag_classes(n, shortest, exponent):
        while have < gram:
            step = min(have, gram - have)  # the two parts may overlap
            hashes = _join(hashes[:len(hashes) - step], hashes[step:])
            have += step
        places = np.arange(len(hashes)) if alive is None else alive[alive < len(hashes)]
        if len(places) < 2:
            break
        order = np.argsort(hashes[places], kind="stable")  # occurrences of a gram, by place
        at = places[order]
        own = hashes[at]
        same = own[1:] == own[:-1]
        repeated = np.zeros(len(at), bool)
        repeated[1:] = same
        repeated[:-1] |= same
        alive = np.sort(at[repeated])
        lag = at[1:] - at[:-1]
        seed = same & (lag >= low) & (lag <= high)
        starts, lags = at[:-1][seed], lag[seed]
        order = np.lexsort((starts, lags))
        covered: dict[int, int] = {}
        for i, q in zip(starts[order].tolist(), lags[order].tolist()):
            if i < covered.get(q, 0):
                continue
            end = _extend(codes, i, q)
            covered[q] = max(end, i + 1)
            begin = _extend_back(codes, i, q)
            length = end + q - begin
            if length >= max(shortest, exponent * q):
                runs.append((begin, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray | None:
    """The words that no run repeats: those within no run, or in its first period. None for all."""
    if not runs:
        return None
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def _runs(shortest: int, exponent: int, prepare: Callable | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 64):
            found, sizes, texts = [], [], []
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                words = text.split()  # at the six white-space bytes
                if prepare:
                    words = prepare(doc_id, words)
                codes: dict[bytes, int] = {}
                at = np.fromiter(map(codes.setdefault, words, count()), np.int64, len(words))
                runs = find_runs(at, shortest, exponent) if len(codes) < len(words) else []
                keep = kept_words(len(words), runs)
                found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                sizes.append(len(words))
                texts.append(b" ".join(words if keep is None else [words[i] for i in np.flatnonzero(keep)]))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sizes, pa.int64()), pa.array(found, pa.list_(_RUN)),
                                              pa.array(texts, pa.binary())], names=names)
    return run


def periodic_runs(docs: DataFrame, shortest: int = 24, exponent: int = 3, id_col: str = "doc_id",
                  text_col: str = "text", prepare: Callable | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) per row: the maximal runs of at least
    ``shortest`` words and ``exponent`` whole periods as (start, length, period)
    by start, then period; and the UTF-8 text, words joined by one space, without
    the words that a run repeats.

    ``prepare(id, words)`` gives the words to look at in place of the row's own.
    Null, empty and white texts have no words, no runs and an empty collapsed
    text; a null id stays null; repeated rows and rows that share an id give a
    row each; bytes that are no valid UTF-8 are words like others; an empty
    table gives no row; other columns are not read. Runs of least period above
    a third of a text's words do not exist at the defaults. ``exponent`` is 3 at
    least: squares guarantee no gram as long as every lag of a class.
    """
    if exponent < 3 or shortest < exponent:
        raise ValueError("exponent must be 3 at least, and shortest no less than it")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), common.utf8(text_col).alias("text"))
    names = ["id", "n_words", "runs", "collapsed"]
    out = rows.mapInArrow(_runs(shortest, exponent, prepare, names), "id long, n_words long, "
                          "runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run of the greatest length to period, compared in whole numbers; the first in order among equals."""
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def stretched(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the checksum of their id, from a word on repeat the block of words
    there to their end; the others, and those without an id, stay as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * -(-(n - a) // p))[:n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its runs' number, the strongest one, and digests of all runs and of the text without repeats."""
    found = periodic_runs(common.table(spark, sf_dir, "documents"), prepare=stretched)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.select("*", strongest(F.col("runs")).alias("best"))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                       F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                       F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
