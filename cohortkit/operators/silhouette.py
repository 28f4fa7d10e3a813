"""Plain Euclidean silhouette of a clustering, from all pairs of rows.

A row's silhouette needs its mean distance to every cluster. These are sums of
distances, which, unlike sums of squares, do not follow from the clusters' means: every
pair of rows is worked out. So that this spreads and no machine needs all rows:

1. the rows are dealt into tiles of at most about 50,000, each one row of a table, sorted by cluster;
2. each two tiles meet in a task of a Cartesian product, which reads the tiles from one shuffle and
   stores no copies of them. A distance is worked out once and counts for both of its rows;
3. a tile's sums, a number per row and cluster from each tile met, are added up, and
   give the mean distances and the silhouettes.

For n rows these are n * n / 2 distances. What a task holds is two tiles and their sums. What is
gathered is the clusters' sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import spec
from ..session import discard, materialize
from .relational import checked_broadcast

#: Distances are worked out for so many rows to so many rows at a time, which stay in a core's cache.
_ROWS, _TO_ROWS = 128, 512
#: Squares of distances below this share of the squared norms are worked out again from differences.
_CLOSE = 1e-4
#: Rows per tile, at most about; fewer where they are wide or the clusters many (numbers per tile).
_PARTITION_ROWS, _TILE_VALUES = 50_000, 1 << 20
#: Rows below which a tile is not made smaller for more tasks, and for what it holds.
_LEAST_ROWS, _LEAST_WIDE_ROWS = 4_000, 256

_TILE = "tile int, codes array<int>, counts array<int>, points binary"
_SUMS = "tile int, codes array<int>, counts array<int>, others array<int>, sums binary"
_INTS = pa.list_(pa.int32())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


class _To:
    """Distances to the rows of y, by one matrix product around their middle.

    Where the product cancels (points close together for their distance from the middle) the
    coordinates' differences are taken, so equal points are at 0. Both sides are gone through
    by distance from the middle: rows worked out together then have much the same norms, and one
    look at the least square tells whether any could cancel.
    """

    def __init__(self, y: np.ndarray):
        self.middle = y.mean(0)
        near, squares, self.order = self._by_norm(y)
        self.y, self.squares = y[self.order], squares
        turned = np.vstack([-2.0 * near.T, np.ones(len(y)), squares])
        self.turned = [np.ascontiguousarray(turned[:, b:b + _TO_ROWS]) for b in range(0, len(y), _TO_ROWS)]

    def _by_norm(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        near = x - self.middle
        norms = np.square(near).sum(1)
        order = np.argsort(norms)
        return near[order], norms[order], order

    def _blocks(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(rows of x, first row of y by norm, distances); what is yielded is overwritten by the next."""
        near, norms, order = self._by_norm(x)
        left = np.column_stack([near, norms, np.ones(len(x))])
        store = np.empty(_ROWS * _TO_ROWS)
        for a in range(0, len(x), _ROWS):
            some, rows = left[a:a + _ROWS], order[a:a + _ROWS]
            for b, turned in zip(range(0, len(self.y), _TO_ROWS), self.turned):
                total = np.matmul(some, turned, out=store[:len(some) * turned.shape[1]].reshape(len(some), -1))
                y, squares = self.y[b:b + _TO_ROWS], self.squares[b:b + _TO_ROWS]
                if not total.min() > _CLOSE * (some[-1, -2] + squares[-1]):  # what is not a number, too
                    self._again(total, x[rows], y, _CLOSE * (some[:, -2:-1] + squares))
                yield rows, b, np.sqrt(total, out=total)

    @staticmethod
    def _again(total: np.ndarray, x: np.ndarray, y: np.ndarray, least: np.ndarray) -> None:
        at = np.flatnonzero(~(total > least))
        if len(at) > total.size // 16:
            total[:] = 0
            for k in range(x.shape[1]):
                total += np.square(x[:, k, None] - y[None, :, k])
        elif len(at):
            i, j = np.divmod(at, len(y))
            total[i, j] = np.square(x[i] - y[j]).sum(1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.y)))
        for rows, b, d in self._blocks(x):
            out[rows[:, None], self.order[b:b + d.shape[1]]] = d
        return out

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of the distances, for each row of x and for each row of y."""
        of_x, of_y, ones = np.zeros(len(x)), np.zeros(len(self.y)), np.ones(max(_ROWS, _TO_ROWS))
        for rows, b, d in self._blocks(x):
            of_x[rows] += d @ ones[:d.shape[1]]
            of_y[b:b + d.shape[1]] += ones[:len(d)] @ d
        back = np.empty_like(of_y)
        back[self.order] = of_y
        return of_x, back


def _pack(width: int):
    """A tile: a task's rows, sorted by their cluster's code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b["code"].to_numpy(), _matrix(b["x"], width)) for b in batches if b.num_rows]
        if got:
            codes, x = (np.concatenate(v) for v in zip(*got))
            own, counts = np.unique(codes, return_counts=True)
            points = x[np.argsort(codes, kind="stable")].tobytes()
            yield _record(_TILE, TaskContext.get().partitionId(), own, counts, points)
    return run


def _record(schema: str, tile: int, *values: np.ndarray | bytes) -> pa.RecordBatch:
    columns = [pa.array([v], pa.binary()) if isinstance(v, bytes) else pa.array([v.tolist()], _INTS) for v in values]
    return pa.RecordBatch.from_arrays([pa.array([tile], pa.int32()), *columns], names=[c.split()[0] for c in schema.split(", ")])


def _pair_sums(width: int):
    """Of two tiles that meet: for each one's rows, the sums of the distances to the other's clusters."""
    def tiles(batch: pa.RecordBatch, side: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for tile, codes, counts, points in zip(*[batch[side + c] for c in ("tile", "codes", "counts", "points")]):
            x = np.frombuffer(points.as_buffer()).reshape(-1, width)
            yield tile.as_py(), np.array(codes.as_py()), np.array(counts.as_py()), x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (i, codes, counts, x), (j, others, sizes, y) in zip(tiles(batch, ""), tiles(batch, "to_")):
                of_x = np.zeros((len(others), len(x)))
                of_y = of_x if i == j else np.zeros((len(codes), len(y)))
                for q, t in enumerate(np.cumsum(sizes)):
                    theirs = slice(t - sizes[q], t)
                    to = _To(y[theirs])
                    for p, s in enumerate(np.cumsum(counts)[:q + 1 if i == j else None]):
                        own = slice(s - counts[p], s)
                        of_x[q, own], back = to.sums(x[own])
                        if i != j or p != q:
                            of_y[p, theirs] = back
                yield _record(_SUMS, i, codes, counts, others, of_x.tobytes())
                if i != j:
                    yield _record(_SUMS, j, others, sizes, codes, of_y.tobytes())
    return run


def _score(sizes: Sequence[int]):
    """(code, s, n): sum of the silhouettes and number of a task's rows, per cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, count = np.array(sizes, float), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
        tiles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for tile, codes, counts, others, sums in zip(*batch.columns):
                if tile.as_py() not in tiles:
                    own = np.repeat(codes.as_py(), counts.as_py())
                    tiles[tile.as_py()] = own, np.zeros((len(own), len(n)))
                own, w = tiles[tile.as_py()]
                w[:, others.as_py()] += np.frombuffer(sums.as_buffer()).reshape(-1, len(own)).T
        for codes, w in tiles.values():
            at = np.arange(len(codes))
            a = w[at, codes] / np.maximum(n[codes] - 1, 1)
            w /= n
            w[at, codes] = np.inf
            b = w.min(1)
            s = np.where((n[codes] > 1) & (np.maximum(a, b) > 0), (b - a) / np.where(np.maximum(a, b) > 0, np.maximum(a, b), 1), 0.0)
            total += np.bincount(codes, s, len(n))
            count += np.bincount(codes, minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(total), pa.array(count)],
                                         names=["code", "s", "n"])
    return run


def euclidean_silhouette(df: DataFrame, cols: Sequence[str], cluster_col: str = spec.CLUSTER, key: str | None = None,
                         points: int = spec.SILHOUETTE_POINTS, seed: int = spec.SEED) -> DataFrame:
    """Per cluster: its mean silhouette and its rows (cluster, silhouette, n_rows); see :func:`overall`.

    ``cols`` are numeric columns, or one array column of doubles, without NULLs. Every pair of rows
    counts, whatever the clusters' sizes. Rows of a one-row cluster score 0; a NULL cluster is a
    cluster; one cluster alone has no silhouette (NULL). ``key``, ``points`` and ``seed`` said which rows
    to draw when this was an estimate; they are still taken, and change nothing.
    """
    x = F.col(cols[0]) if dict(df.dtypes)[cols[0]].startswith("array") else F.array(*[F.col(c).cast("double") for c in cols])
    pts = materialize(df.select(F.col(cluster_col).alias("c"), x.alias("x")), "points")
    sizes_table = pts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))  # a row per cluster
    clusters = materialize(sizes_table.withColumn("code", F.row_number().over(W.orderBy("c")) - 1), "clusters")
    named = clusters.withColumnRenamed("c", "own")
    rows = pts.join(checked_broadcast(named), F.col("c").eqNullSafe(F.col("own")))
    sizes = [r["n"] for r in clusters.orderBy("code").collect()]
    if len(sizes) < 2:
        discard(pts)
        return clusters.select(F.col("c").alias(cluster_col), F.lit(None).cast("double").alias("silhouette"), F.col("n").alias("n_rows"))
    width = len(pts.select("x").first()["x"])
    held = max(_LEAST_WIDE_ROWS, _TILE_VALUES // max(width, len(sizes)))
    count = max(math.ceil(sum(sizes) / min(_PARTITION_ROWS, held)),
                min(spec.KMEANS_LEAST_PARTITIONS, math.ceil(sum(sizes) / _LEAST_ROWS)))
    tiles = materialize(rows.select("code", "x").repartition(count).mapInArrow(_pack(width), _TILE), "coded-points")
    apart = tiles.repartitionById(count, "tile")  # a tile per task of either side
    to = apart.select(*[F.col(c).alias(f"to_{c}") for c in apart.columns])
    pairs = apart.hint("shuffle_replicate_nl").join(to, F.col("tile") <= F.col("to_tile"))
    scored = (pairs.mapInArrow(_pair_sums(width), _SUMS).repartition("tile").mapInArrow(_score(sizes), "code int, s double, n long")
              .groupBy("code").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    out = materialize(scored.join(clusters.select("code", "c"), "code")
                      .select(F.col("c").alias(cluster_col), (F.col("s") / F.col("n")).alias("silhouette"), F.col("n").alias("n_rows")), "silhouettes")
    discard(pts, tiles)
    return out


def overall(per_cluster: DataFrame) -> DataFrame:
    """One row: silhouette over all rows, n_rows, n_clusters."""
    return per_cluster.agg((F.sum(F.col("silhouette") * F.col("n_rows")) / F.sum("n_rows")).alias("silhouette"),
                           F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters"))
