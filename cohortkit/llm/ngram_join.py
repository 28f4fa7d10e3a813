"""N-gram Jaccard join: a size-aware heavy-light join, and the groups its links make.

A text's set holds the 64-bit hashes of its distinct word n-grams. Equal sets
are one class, represented by its smallest id; only representatives go on.

Order all grams by (few holders first): two sets that link share a gram within
the first p = n - ceil(t n) + 1 grams of each, and with one more gram each,
two. Most grams of a corpus have one holder and can be skipped, so each set
gives only the grams in a fixed part of the hash space, 1.2 (1 - t) of it (and so
many more that there are p + 1); a set with p grams there that nobody else holds has no partner
and leaves.

Of the sets that stay, small ones are light: they enumerate all 2-subsets of
their first p + 1 grams, and share a subset with each partner. Large sets are
heavy: their first p grams are looked up in inverted lists. Small sets within
reach of a large one are listed too, and those so small that one gram in
common can be enough for a link. The size that parts the two is the one of
least cost, counted in subset rows against list entries made and scanned.

Sets with a key in common are compared with the key's pivot, the set with the
smallest share of grams of its own. Links join components; keys whose sets are
all in one component need nothing more. For the others, pivots of each size
follow, more of them while they pay, and at last all pairs that lie in
different components. No link between different sets is lost that the
components depend on.

Beside its whole grams a set has a bitmap: the parities of its grams by 9 bits
of their hashes. Two bitmaps differ in no more bits than the sets have grams
apart, so a pair whose bitmaps differ in too many cannot link; such pairs go
before any whole set is moved. Sets with equal minima of two permutations meet
once as well, so that groups of near copies are one component early.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import discard, materialize
from . import common

_LOWEST = -(2 ** 63)
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PIVOT_ROUNDS = 3
#: Cost of a list entry, in subset rows.
_SCAN = 2.0
#: Longs of a bitmap, and pairs of permutations whose minima are compared.
_LONGS, _MEETINGS = 8, 4
_BITMAP = [f"b{i}" for i in range(_LONGS)]
_ORDERS = [np.uint64((int(_K1) + 2 * i * int(_K2)) % 2 ** 64) for i in range(2 * _MEETINGS)]
#: All pairs of different components follow when they are at most so many per key entry.
_PAIRS_PER_ENTRY = 20


#: Bytes whose powers are at hand; words are hashed in runs of about so many.
_RUN = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[list(common.SPACE)] = True


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """K ** i and K ** -i modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_K1), -1, 2 ** 64))
    both = []
    for base in (_K1, inverse):
        x = np.full(n, base)
        x[0] = 1
        both.append(np.cumprod(x))
    return both[0], both[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the words data[start:end]: polynomials of their bytes, each counted from 1, from one running
    sum, mixed with their lengths."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, begin + _RUN, "right")))
        size = int(ends[stop - 1]) - begin
        up, down = _powers(max(_RUN, 1 << (size - 1).bit_length()))
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[begin:begin + size] + np.uint64(1)) * up[:size], out=total[1:])
        s, e = starts[at:stop] - begin, ends[at:stop] - begin
        out[at:stop] = (total[e] - total[s]) * down[s]
        at = stop
    return _mix(out ^ ((ends - starts).astype(np.uint64) * _K2))


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text: the sorted hashes of its distinct n-grams; of all words as
    one if there are fewer; none without words. texts: binary, without nulls."""
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].copy()
    offsets -= offsets[0]
    data[(data >= 65) & (data <= 90)] += 32
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # words end with their text, too
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    codes = _word_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)

    def grams(codes: np.ndarray, k: int) -> np.ndarray:
        h = np.full(max(0, len(codes) - k + 1), np.uint64(k))
        for i in range(k):
            h = (h ^ codes[i:i + len(h)]) * _K1
            h ^= h >> np.uint64(29)
        return _mix(h)

    every = grams(codes, n)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            yield np.unique(every[a:b - n + 1])
        else:
            yield grams(codes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _bound(percent: int) -> int:
    """Grams of hashes below it are listed for every set: of these a set has
    somewhat more than the first grams that its partners must share one of."""
    return min(2 ** 64 - 1, (100 - percent) * 2 ** 64 * 12 // 1000)


def _is_listed(gram: Column, percent: int) -> Column:
    """Of the unsigned hash in a signed long."""
    bound = _bound(percent)
    return (gram >= 0) & (gram < bound) if bound < 2 ** 63 else (gram >= 0) | (gram < bound - 2 ** 64)


def _least(n, percent: int):
    """Grams that a set of n shares with any partner."""
    return -(-n * percent // 100)


def _sets(n: int, percent: int):
    bound = np.uint64(_bound(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in common.slices(batches, 500):
            sizes, low, f1, f2, grams = [], [], [], [], []
            for s in gram_sets(part["text"], n):
                fp = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                listed = int(np.searchsorted(s, bound))
                sizes.append(len(s))
                low.append(listed)
                f1.append(int(fp[0]))
                f2.append(int(fp[1]))
                grams.append(s[:_listed(len(s), listed, percent)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["rid"], pa.array(sizes, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(grams, pa.list_(pa.int64()))],
                names=["id", "rid", "n", "low", "f1", "f2", "grams"])
    return run


def _listed(n: int, low: int, percent: int) -> int:
    """How many of its n grams a set gives to the join."""
    return max(low, n - _least(n, percent) + 2)


def _bitmap(grams: np.ndarray) -> np.ndarray:
    """Parities of the numbers of grams by the low bits of their hashes, as longs."""
    bits = 64 * _LONGS
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _minima(grams: np.ndarray) -> np.ndarray:
    """The least grams in the orders of some permutations, mixed two by two."""
    both = np.array([(grams * x).min() for x in _ORDERS], np.uint64).reshape(_MEETINGS, 2)
    return _mix(both[:, 0] * _K3 + both[:, 1] + np.arange(_MEETINGS, dtype=np.uint64)).view(np.int64)


def _whole_sets(n: int, percent: int):
    bound = np.uint64(_bound(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, 500):
            sets = list(gram_sets(part["text"], n))
            listed = [_listed(len(s), int(np.searchsorted(s, bound)), percent) for s in sets]
            bitmaps = np.array([_bitmap(s) for s in sets], np.int64).reshape(-1, _LONGS)
            yield pa.RecordBatch.from_arrays(
                [part["set"], pa.array([len(s) for s in sets], pa.int64()), pa.array(listed, pa.int32()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([_minima(s) for s in sets], pa.list_(pa.int64())), *map(pa.array, bitmaps.T.copy())],
                names=["set", "size", "listed", "whole", "minima", *_BITMAP])
    return run


def _link(percent: int):
    def lists(column: pa.ListArray):
        values = column.values.to_numpy().view(np.uint64)
        ends = column.offsets.to_numpy()
        return [values[i:j] for i, j in zip(ends[:-1], ends[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 2000):
            keep = []
            for a, b in zip(lists(batch["x"]), lists(batch["y"])):
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])
    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable, for every id in edges (a, b);
    alternating large-star and small-star steps."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialize(e, "edges")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(checked_broadcast(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        least = checked_broadcast(least)
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        e = materialize(small.filter("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last:
            break
        last = now
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _pivot(rank: Column) -> Column:
    """The set of the lowest rank, as the struct x of p, pn and pp."""
    return F.min(F.struct(rank.alias("rank"), F.col("set").alias("p"), F.col("n").alias("pn"),
                          F.col("place").alias("pp"))).alias("x")


def _single_holders(grams: DataFrame, name: str) -> DataFrame:
    """(set, name): how many of its grams no other set of (set, gram) holds."""
    held = grams.groupBy("gram").agg(F.count("*").alias("c"), F.min("set").alias("set"))
    return held.filter("c = 1").groupBy("set").agg(F.count("*").alias(name))


class JaccardJoin:
    """The tables of one join, from sets to components."""

    def __init__(self, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str):
        if not 0 < percent <= 100:
            raise ValueError("percent must be above 0, and 100 at most")
        self.n, self.percent = n, percent
        self._ratio = max(float(np.log(100 / percent)), 0.01)  # of the sizes of sets that link, as a logarithm
        self.docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
                                common.row_hash(text_col).alias("rid"), common.utf8(text_col).alias("text"))
        self.sets = materialize(self.docs.mapInArrow(
            _sets(n, percent), "id long, rid long, n long, low long, f1 long, f2 long, grams array<long>"), "gram-sets")
        # A class is named by the hash of its fingerprint, as ids may repeat. Its rows have equal grams.
        self.classes = materialize(self.sets.filter("n > 0").groupBy("f1", "f2", "n").agg(
            F.min("id").alias("id"), F.min_by("rid", "id").alias("rid"), F.first("low").alias("low"),
            F.first("grams").alias("grams")).withColumn("set", F.xxhash64("f1", "f2", "n")), "gram-classes")

    def prefixes(self) -> DataFrame:
        """(set, n, part, gram, place, inner) for the sets that may have a
        partner: their first grams, those with a single holder left out.
        ``place`` is the gram's place in the set's order, ``part`` the share
        of the set's listed grams that are its own."""
        listed = _is_listed(F.col("gram"), self.percent)
        size = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        own = _single_holders(self.classes.select("set", F.explode("grams").alias("gram")).filter(listed), "own")
        active = (self.classes.join(own, "set", "left").filter(F.coalesce("own", F.lit(0)) < size)
                  .select("set", "n", "low", "grams"))
        active = materialize(active, "active-sets")
        # Only the sets that stay can be partners: holders are counted among them.
        grams = active.select("set", F.explode("grams").alias("gram"))
        held = grams.groupBy("gram").agg(F.count("*").alias("held")).filter("held > 1")
        shared = materialize(grams.join(held, "gram"), "shared-grams")
        info = active.select("set", "n", "low")
        counts = shared.groupBy("set").agg(F.count_if(listed).alias("common"))
        stay = (info.join(counts, "set").withColumn("own", F.col("low") - F.col("common"))
                .withColumn("first", F.floor(size - F.col("own")).cast("long")).filter("first > 0")
                .withColumn("part", F.col("own") / F.greatest(F.col("low"), F.lit(1))))
        # Grams beyond the listed ones are in the order of their unsigned hashes, as only the first of them are known.
        order = W.partitionBy("set").orderBy((~listed).cast("int"), F.when(listed, F.col("held")).otherwise(
            (F.col("gram") < 0).cast("long")), "gram")
        rows = shared.join(stay.select("set", "n", "own", "first", "part"), "set")
        prefixes = materialize(rows.withColumn("k", F.row_number().over(order)).filter("k <= first + 1")
                               .select("set", "n", "part", "gram", (F.col("own") + F.col("k") - 1).alias("place"),
                                       (F.col("k") <= F.col("first")).alias("inner")), "prefixes")
        discard(shared, active)
        return prefixes

    def boundary(self, prefixes: DataFrame) -> int:
        """The size up to which sets enumerate subsets, by cost. Sizes are
        counted in steps of the ratio that linked sets may have: a few hundred rows."""
        ratio = self._ratio
        per_set = prefixes.groupBy("set", "n").agg(F.count("*").alias("s"), F.sum(F.col("inner").cast("int")).alias("p"))
        rows = (per_set.groupBy(F.floor(F.log("n") / ratio).cast("int").alias("step"))
                .agg(F.sum(F.col("s") * (F.col("s") - 1) / 2).alias("subsets"), F.sum("p").alias("lists"))
                .orderBy("step").collect())
        # A row of either kind is made, moved and sorted; a list entry is also
        # scanned with the pivots, and meets sets there that share one gram only.
        best, best_cost = 0, sum(_SCAN * r["lists"] for r in rows)
        for i, r in enumerate(rows):
            light = sum(x["subsets"] for x in rows[:i + 1])
            heavy = _SCAN * sum(x["lists"] for x in rows[i:])  # the last light step is listed as well
            if light + heavy < best_cost:
                best, best_cost = int(np.exp((r["step"] + 1) * ratio)), light + heavy
        return best

    def keys(self, prefixes: DataFrame) -> DataFrame:
        """(key, set, n, part, place, p, pn, pp) for the keys of several sets:
        sets that link share one key at least. p is the key's pivot, the set
        with the smallest share of grams of its own."""
        small = self.boundary(prefixes)
        # Sets that may share a single gram with a partner have no subset in common with it: they are listed.
        listed = (F.col("n") * 100 >= F.lit(small * self.percent)) | (F.col("n") * self.percent <= 100)
        lists = (prefixes.filter("inner").filter(listed)
                 .select(F.xxhash64(F.lit(1), "gram").alias("key"), "set", "n", "part", "place"))
        light = (prefixes.filter(F.col("n") <= small).groupBy("set", "n", "part")
                 .agg(F.sort_array(F.collect_list(F.struct("gram", "place"))).alias("g")))
        pairs = F.flatten(F.transform("g", lambda x, i: F.transform(
            F.slice("g", i + 2, F.size("g")), lambda y: F.struct(
                F.xxhash64(F.lit(2), x["gram"], y["gram"]).alias("key"),
                F.least(x["place"], y["place"]).alias("place")))))
        subsets = (light.select("set", "n", "part", F.explode(pairs).alias("x"))
                   .select("x.key", "set", "n", "part", "x.place"))
        found = lists.unionByName(subsets)
        pivots = found.groupBy("key").agg(F.count("*").alias("sets"), _pivot(F.col("part"))).filter("sets > 1")
        return materialize(found.join(pivots.select("key", "x.p", "x.pn", "x.pp"), "key"), "join-keys")

    def verify(self, pairs: DataFrame, wholes: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets reach the threshold; only sets of pairs that can are moved."""
        marks = wholes.select("set", "size", *_BITMAP)
        sides = [marks.select(F.col("set").alias(side), *[F.col(c).alias(side + c) for c in ("size", *_BITMAP)])
                 for side in ("a", "b")]
        near = materialize(pairs.select("a", "b").distinct().join(sides[1], "b").join(sides[0], "a")
                           .filter(self._bitmaps_allow("a{}", "b{}")).select("a", "b"), "near-pairs")
        here = checked_broadcast(near.select(F.explode(F.array("a", "b")).alias("set")).distinct())
        some = wholes.select("set", "whole").join(here, "set", "left_semi")
        rows = (near.join(some.select(F.col("set").alias("b"), F.col("whole").alias("y")), "b")
                .join(some.select(F.col("set").alias("a"), F.col("whole").alias("x")), "a"))
        return rows.mapInArrow(_link(self.percent), "a long, b long")

    def _bitmaps_allow(self, one: str, other: str) -> Column:
        """Whether two sets can link by their sizes and bitmaps; the names of these are made from the patterns."""
        apart = sum((F.bit_count(F.col(one.format(c)).bitwiseXOR(F.col(other.format(c)))) for c in _BITMAP), F.lit(0))
        both = F.col(one.format("size")) + F.col(other.format("size"))
        return (100 + self.percent) * (both - apart) >= 2 * self.percent * both

    def links(self) -> DataFrame:
        """(id, root) of sets in components of more than one set."""
        keys = self.keys(self.prefixes())
        own = (self.classes.join(keys.select("set").distinct(), "set", "left_semi")
               .select(F.col("id").alias("__id"), F.col("rid").alias("__rid"), "set"))
        texts = self.docs.join(checked_broadcast(own), (F.col("id") == F.col("__id")) & (F.col("rid") == F.col("__rid")))
        wholes = materialize(texts.select("set", "text").mapInArrow(
            _whole_sets(self.n, self.percent), "set long, size long, listed int, whole array<long>, minima array<long>, "
            + ", ".join(f"{c} long" for c in _BITMAP)), "whole-sets")
        left = keys
        tried = [materialize(self._pivot_pairs(left).unionByName(self._meetings(wholes)).distinct(), "pairs")]
        edges = materialize(self.verify(tried[0], wholes), "links")
        roots = connected_components(edges)
        for turn in range(1, _PIVOT_ROUNDS + 1):
            left = self._mixed(left, roots)
            if turn == 1:
                left = self._mixed(materialize(self._placed(left, wholes), "placed-keys"), None)
            if left.isEmpty():
                break
            last = turn == _PIVOT_ROUNDS or (turn > 1 and self._cross_pairs(left) <= _PAIRS_PER_ENTRY)
            if last:
                pairs = self._all_pairs(left, wholes)
            else:
                pairs = self._pivots_by_size(left, turn)
            for done in tried:
                pairs = pairs.join(done, ["a", "b"], "left_anti")
            tried.append(materialize(pairs, "pairs"))
            edges = edges.unionByName(materialize(self.verify(tried[-1], wholes), "links"))
            roots = connected_components(edges)
            if last:
                break
        return roots

    def _meetings(self, wholes: DataFrame) -> DataFrame:
        """Each set with the smallest one that has the same minima: near copies do in most cases."""
        rows = wholes.select("set", F.posexplode("minima").alias("order", "least"))
        first = rows.groupBy("order", "least").agg(F.min("set").alias("p"), F.count("*").alias("c")).filter("c > 1").drop("c")
        return (rows.join(first, ["order", "least"]).filter("set <> p")
                .select(F.least("set", "p").alias("a"), F.greatest("set", "p").alias("b")).distinct())

    def _pivot_pairs(self, left: DataFrame) -> DataFrame:
        """Each key's sets with the key's pivot."""
        return (left.filter("set <> p").filter(self._can_share("n", "place", "pn", "pp"))
                .select(F.least("set", "p").alias("a"), F.greatest("set", "p").alias("b")).distinct())

    def _pivots_by_size(self, left: DataFrame, turn: int) -> DataFrame:
        """Each key's sets with pivots of about their size. Sizes are in steps
        of the ratio that linked sets may have, and in steps half a step off,
        so two sets of much the same size are together in one of them."""
        # What lies before a first gram in common is not shared: a pivot with little of that has the most partners.
        rank = F.col("place") / F.col("n")
        out = None
        for shift in (0.0, 0.5) if turn == 1 else (0.25, 0.75):
            step = F.floor(F.log("n") / self._ratio + shift).cast("int")
            own = left.drop("p", "pn", "pp").withColumn("step", step)
            pivots = own.groupBy("key", "step").agg(_pivot(rank)).select("key", "step", "x.p", "x.pn", "x.pp")
            pairs = self._pivot_pairs(own.join(pivots, ["key", "step"]))
            out = pairs if out is None else out.unionByName(pairs)
        return out.distinct()

    def _mixed(self, left: DataFrame, roots: DataFrame | None) -> DataFrame:
        """The entries, with their components' roots, of the keys whose sets
        are not all in their first set's component."""
        if roots is not None:
            at = checked_broadcast(roots.select(F.col("id").alias("__set"), F.col("root").alias("__root")))
            left = left.drop("root").join(at, F.col("set") == F.col("__set"), "left")
            left = left.withColumn("root", F.coalesce("__root", "set")).drop("__set", "__root")
        mixed = (left.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
                 .filter("r1 <> r2").select("key"))
        return materialize(left.join(checked_broadcast(mixed), "key"), "mixed-keys")

    def _placed(self, left: DataFrame, wholes: DataFrame) -> DataFrame:
        """Key entries with their places in the order that has all grams with a
        single holder first, also those that were not listed: what is then
        beyond a set's first grams goes. Sets list different parts of their
        grams, so holders are counted over whole sets; those below the bound
        are listed by all."""
        here = checked_broadcast(left.select("set").distinct())
        grams = (wholes.join(here, "set", "left_semi")
                 .select("set", "listed", F.posexplode("whole").alias("pos", "gram"))
                 .filter(~_is_listed(F.col("gram"), self.percent)))
        held = (grams.groupBy("gram").agg(F.count("*").alias("c"), F.min("set").alias("set"),
                                          F.max(F.col("pos") >= F.col("listed")).alias("rest")))
        own = held.filter("c = 1 AND rest").groupBy("set").agg(F.count("*").alias("more"))
        more = left.join(own, "set", "left")
        return (more.withColumn("place", F.col("place") + F.coalesce("more", F.lit(0))).drop("more")
                .filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * self.percent / 100)))

    def _can_share(self, n: str, place: str, n2: str, place2: str) -> Column:
        """Whether sets whose first gram in common has these places can link:
        what lies before it, they do not share."""
        most = F.least(F.col(n) - F.col(place), F.col(n2) - F.col(place2))
        return (100 + self.percent) * most >= self.percent * (F.col(n) + F.col(n2))

    def _cross_pairs(self, left: DataFrame) -> float:
        """Pairs of different components per key entry."""
        each = left.groupBy("key", "root").agg(F.count("*").alias("c"))
        per_key = each.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c").cast("double") * F.col("c")).alias("q"))
        r = per_key.agg(F.sum((F.col("m").cast("double") * F.col("m") - F.col("q")) / 2).alias("pairs"), F.sum("m").alias("m")).first()
        return r["pairs"] / r["m"]

    def _all_pairs(self, left: DataFrame, wholes: DataFrame) -> DataFrame:
        """The pairs of different components with a key in common that may be their first, if sizes and
        bitmaps allow a link."""
        marked = left.join(wholes.select("set", "size", *_BITMAP), "set")
        columns = ("set", "n", "root", "place", "size", *_BITMAP)
        other = marked.select("key", *[F.col(c).alias(f"{c}2") for c in columns])
        return (marked.select("key", *columns).join(other, "key").filter("set < set2 AND root <> root2")
                .filter(self._can_share("n", "place", "n2", "place2"))
                .filter(self._bitmaps_allow("{}", "{}2"))
                .select(F.col("set").alias("a"), F.col("set2").alias("b")).distinct())

    def components(self) -> DataFrame:
        """(id, rid, n, group, component_id) per row; sets without a link are groups of their own."""
        roots = self.links()
        at = roots.select(F.col("id").alias("set"), "root")
        classes = self.classes.join(at, "set", "left").withColumn("root", F.coalesce("root", "set"))
        smallest = classes.groupBy("root").agg(F.min("id").alias("component_id"))
        named = classes.join(smallest, "root").select("f1", "f2", "n", F.col("root").alias("group"), "component_id")
        rows = self.sets.select("id", "rid", "n", "f1", "f2")
        return (rows.join(named, ["f1", "f2", "n"], "left")
                .select("id", "rid", "n", "group", F.coalesce("component_id", "id").alias("component_id")))


def similar_groups(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, rid, n, group, component_id) per row: the size of its set of word
    ``n``-grams, its group, and the smallest id in that, where links lead to.

    Two rows link when their sets' Jaccard similarity is ``percent`` percent
    or more. Null, empty and wordless texts have the empty set, link with
    nothing and keep their own id; a null id is the lowest integer; repeated
    rows are in one group; rows that share an id and not a text are grouped
    each; an empty table gives no row; other columns are not read.
    """
    return JaccardJoin(docs, n, percent, id_col, text_col).components()


def keep_one_per_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, one with the smallest id; rows without words all stay."""
    groups = similar_groups(docs, n, percent, id_col, text_col)
    # Rows of a group that share the smallest id: the one of the smallest text hash, once.
    first = (groups.filter("n > 0 AND id = component_id").groupBy("group")
             .agg(F.first("id").alias("__id"), F.min("rid").alias("__rid")).drop("group"))
    wordless = groups.filter("n = 0").select(F.col("id").alias("__id"), F.col("rid").alias("__rid")).distinct()
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    key = [own.alias("__own"), common.row_hash(text_col).alias("__hash")]
    match = lambda d: docs.select("*", *key).join(d, (F.col("__own") == F.col("__id")) & (F.col("__hash") == F.col("__rid")))
    one = match(first).dropDuplicates(["__own", "__hash"]).select(*docs.columns)
    return one.unionByName(match(wordless).select(*docs.columns))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by 4-word shingles at a similarity of 0.85."""
    common.small_batches(spark)
    groups = similar_groups(common.table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
