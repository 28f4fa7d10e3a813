"""Embedding near-duplicates by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one class. Classes are dealt by hash to shards of bounded
bytes, so a group of near copies is spread over all of them. A task builds a
shard's graph: layers of navigable links, each node in layer l with probability
links ** -l, and in the lowest layer all nodes. Points are linked in batches to
the neighbours that a beam search through the layers above finds among those
that are there, and to those of their own batch; a neighbour is kept if it
is closer to the point than to the neighbours kept before. Nodes that no
path reaches get one.

Each graph is audited before it is used: vectors at the threshold's angle
from some of its own must find these, and some of its own vectors all their
neighbours that an exact scan has. Beams are widened until the recall is reached.

All vectors then query every shard: of two shards the vectors of one search
the graph of the other, and each shard's its own, a block of queries at a time.
A query whose beam ends full of neighbours above the threshold searches again
with twice the beam, and beyond ``_WIDEST`` by an exact scan of the shard. All
pairs found are verified by their cosine in double precision. Pairs are
counted where they are found, and only spanning stars of the components
of two shards leave the task, for the union of all.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize, scratch_path
from . import common
from .ngram_join import connected_components

_LOWEST = -(2 ** 63)
#: Vectors of a shard in bytes of single precision, at most; and classes of a shard, at least.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 512
#: Shards that share the work where the vectors would fit in fewer.
LEAST_SHARDS = 8
_LINKS = 16  # of a node; twice as many in the lowest layer
_SPARE = 4  # places for links that make a node reachable
_BUILD_BEAM, _FIRST_BEAM, _WIDEST = 64, 32, 1024
_AUDITS = 512
#: Single-precision cosines of pairs above the threshold are not lower by more.
_SLACK = np.float32(1e-4)
#: Nodes that beams expand at a time.
_EXPAND = 4


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    v = v / np.abs(v).max(1, keepdims=True, initial=1e-300)
    return v / np.sqrt(np.einsum("nd,nd->n", v, v))[:, None]


def _best(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, in any order."""
    if sims.shape[1] <= k:
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of the ``beam`` best that each query meets from its entries (rows of
    nodes, -1 for none); all queries go step by step together. -1 and -inf where there are fewer."""
    n_queries, rows = len(queries), np.arange(len(queries))
    nodes = np.full((n_queries, beam), -1, np.int32)
    sims = np.full((n_queries, beam), -np.inf, np.float32)
    opened = np.ones((n_queries, beam), bool)
    seen = np.zeros((n_queries, len(x) + 1), bool)  # the last column stands for -1
    active, fresh = rows, entries
    while len(active):
        fresh = np.sort(fresh, axis=1)
        new = fresh >= 0
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        new &= ~seen[active[:, None], fresh]
        seen[active[:, None], fresh] = True
        s = np.einsum("qkd,qd->qk", x[fresh], queries[active])
        s[~new] = -np.inf
        all_nodes = np.concatenate([nodes[active], fresh], axis=1)
        all_sims = np.concatenate([sims[active], s], axis=1)
        all_opened = np.concatenate([opened[active], ~new], axis=1)
        top = _best(all_sims, beam)
        nodes[active] = np.take_along_axis(all_nodes, top, 1)
        sims[active] = np.take_along_axis(all_sims, top, 1)
        opened[active] = np.take_along_axis(all_opened, top, 1)
        closed = np.where(opened[active], -np.inf, sims[active])
        k = min(_EXPAND, beam)
        at = _best(closed, k)
        go = np.take_along_axis(closed, at, 1) > -np.inf
        left = go.any(1)
        active, at, go = active[left], at[left], go[left]
        if not len(active):
            break
        at_opened = opened[active]
        np.put_along_axis(at_opened, at, True, 1)
        opened[active] = at_opened
        fresh = links[np.take_along_axis(nodes[active], at, 1)]
        fresh[~go] = -1
        fresh = fresh.reshape(len(active), -1)
    return nodes, sims


def choose(x: np.ndarray, nodes: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """Of each row of candidates k as neighbours: in order of similarity those that are closer to the
    point than to the ones kept before, then the nearest of the others. -1 where there are fewer."""
    order = np.argsort(-sims, axis=1, kind="stable")
    nodes, sims = np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)
    there = sims > -np.inf
    v = x[nodes]
    between = np.matmul(v, v.transpose(0, 2, 1))
    kept = np.zeros(nodes.shape, bool)
    nearest = np.full(nodes.shape, -np.inf, np.float32)  # to the kept ones
    count = np.zeros(len(nodes), np.int64)
    for j in range(nodes.shape[1]):
        take = there[:, j] & (nearest[:, j] < sims[:, j]) & (count < k)
        kept[:, j] = take
        count += take
        nearest[take] = np.maximum(nearest[take], between[take, j])
    first = np.argsort(~kept * 2 + ~there, axis=1, kind="stable")[:, :k]
    out = np.take_along_axis(nodes, first, 1)
    out[~np.take_along_axis(there, first, 1)] = -1
    if out.shape[1] < k:
        out = np.concatenate([out, np.full((len(out), k - out.shape[1]), -1, out.dtype)], axis=1)
    return out


class Graph:
    """The layers of a shard: links[l][node] are a node's neighbours in layer l, -1 for none."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray], entry: int, beam: int = _FIRST_BEAM):
        self.x, self.links, self.entry, self.beam = x, links, entry, beam

    def _enter(self, queries: np.ndarray, down_to: int) -> np.ndarray:
        """Entries of the queries into the layer below ``down_to``."""
        at = np.full((len(queries), 1), self.entry, np.int32)
        for layer in range(len(self.links) - 1, down_to - 1, -1):
            at, _ = beam_search(self.x, self.links[layer], queries, at, 8)
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return beam_search(self.x, self.links[0], queries, self._enter(queries, 1), beam)

    def in_range(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the pairs found whose cosine is ``least`` or more, beams as wide as they need to be."""
        low = np.float32(least) - _SLACK
        at, found, left = [], [], np.arange(len(queries))
        while len(left):
            wide = beam >= len(self.x) or beam > _WIDEST
            if wide:
                sims = queries[left] @ self.x.T
                q, k = np.nonzero(sims >= low)
                nodes = k
                full = np.zeros(len(left), bool)
            else:
                nodes, sims = self.search(queries[left], beam)
                hit = sims >= low
                full = hit.all(1)
                q, k = np.nonzero(hit & ~full[:, None])
                nodes = nodes[q, k]
            at.append(left[q])
            found.append(nodes)
            left, beam = left[full], beam * 2
        return np.concatenate(at), np.concatenate(found).astype(np.int64)


def build(x: np.ndarray, draws: np.ndarray) -> Graph:
    """The graph of unit vectors x (single precision); ``draws``, uniform in (0, 1), set the nodes' layers."""
    n, width = len(x), 2 * _LINKS
    levels = np.floor(-np.log(draws) / np.log(_LINKS)).astype(np.int64)
    order = np.argsort(-levels, kind="stable")
    top = int(levels.max(initial=0))
    graph = Graph(x, [np.full((n, (width if l == 0 else _LINKS) + _SPARE), -1, np.int32) for l in range(top + 1)], int(order[0]))
    for layer in range(top, -1, -1):
        _fill(graph, layer, order[levels[order] >= layer], width if layer == 0 else _LINKS)
    _reach(graph.links[0], x, graph.entry)
    return graph


def _fill(graph: Graph, layer: int, order: np.ndarray, width: int) -> None:
    x, links, done = graph.x, graph.links[layer], 0
    while done < len(order):
        batch = order[done:done + max(64, min(512, done // 2))]
        v = x[batch]
        own = v @ v.T
        np.fill_diagonal(own, -np.inf)
        near = _best(own, min(_BUILD_BEAM // 2, len(batch)))
        nodes, sims = batch[near].astype(np.int32), np.take_along_axis(own, near, 1)
        if done:
            found, s = beam_search(x, links, v, _entries(graph, v, layer, order[0]), _BUILD_BEAM)
            nodes, sims = np.concatenate([found, nodes], axis=1), np.concatenate([s, sims], axis=1)
        to = choose(x, nodes, sims, _LINKS)
        links[batch, :_LINKS] = to
        _link_back(x, links, batch, to, width)
        done += len(batch)


def _entries(graph: Graph, queries: np.ndarray, layer: int, first: int) -> np.ndarray:
    if layer == len(graph.links) - 1:
        return np.full((len(queries), 1), first, np.int32)
    return graph._enter(queries, layer + 1)


def _link_back(x: np.ndarray, links: np.ndarray, batch: np.ndarray, to: np.ndarray, width: int) -> None:
    """Links from the batch's neighbours to it; those with too many choose again."""
    q, k = np.nonzero(to >= 0)
    source, target = batch[q], to[q, k].astype(np.int64)
    known = (links[target, :width] == source[:, None]).any(1)
    source, target = source[~known], target[~known]
    if not len(source):
        return
    s = np.einsum("pd,pd->p", x[source], x[target])
    order = np.lexsort((-s, target))
    source, target, s = source[order], target[order], s[order]
    nodes, begins = np.unique(target, return_index=True)
    rank = np.arange(len(target)) - np.repeat(begins, np.diff(np.append(begins, len(target))))
    few = rank < width  # of a batch's links to one node the most similar are looked at
    new = np.full((len(nodes), int(rank[few].max()) + 1), -1, np.int32)
    new_sims = np.full(new.shape, -np.inf, np.float32)
    row = np.searchsorted(nodes, target[few])
    new[row, rank[few]], new_sims[row, rank[few]] = source[few], s[few]
    for k in range(0, len(nodes), 2048):
        some = nodes[k:k + 2048]
        old = links[some, :width]
        old_sims = np.einsum("nkd,nd->nk", x[old], x[some])
        old_sims[old < 0] = -np.inf
        links[some, :width] = choose(x, np.concatenate([old, new[k:k + 2048]], axis=1),
                                     np.concatenate([old_sims, new_sims[k:k + 2048]], axis=1), width)


def _reach(links: np.ndarray, x: np.ndarray, entry: int) -> None:
    """Links to the nodes that no path from the entry reaches, from the nearest reached ones with a spare place."""
    reached = np.zeros(len(x), bool)

    def walk(front: np.ndarray) -> None:
        reached[front] = True
        while len(front):
            to = np.unique(links[front])
            front = to[(to >= 0)]
            front = front[~reached[front]]
            reached[front] = True

    walk(np.array([entry]))
    while not reached.all():
        node = int(np.argmin(reached))
        sims = np.where(reached & (links[:, -1] < 0), x @ x[node], -np.inf)
        best = int(np.argmax(sims))
        links[best, -_SPARE + int(np.count_nonzero(links[best, -_SPARE:] >= 0))] = node
        walk(np.array([node]))


def audited(graph: Graph, least: float, recall: float, seed: int = 0) -> Graph:
    """The graph with a beam at which the recall of the audits is reached; it may be as wide as the graph."""
    x, rng = graph.x, np.random.default_rng(seed)
    some = np.sort(rng.choice(len(x), min(_AUDITS, len(x)), replace=False))
    aside = rng.standard_normal((len(some), x.shape[1])).astype(np.float32)
    aside -= np.einsum("nd,nd->n", aside, x[some])[:, None] * x[some]
    lengths = np.sqrt(np.einsum("nd,nd->n", aside, aside))[:, None]
    if x.shape[1] > 1:
        aside /= np.maximum(lengths, 1e-12)
    planted = np.float32(least) * x[some] + np.float32(np.sqrt(max(0.0, 1 - least * least))) * aside
    exact = [x[some[k:k + 64]] @ x.T >= np.float32(least) for k in range(0, len(some), 64)]
    true = sum(int(e.sum()) for e in exact)
    while graph.beam < len(x):
        found = hits = 0
        for k in range(0, len(some), 64):
            nodes, _ = graph.search(planted[k:k + 64], graph.beam)
            hits += int((nodes == some[k:k + 64, None]).any(1).sum())
            q, node = graph.in_range(x[some[k:k + 64]], least, graph.beam)
            found += int(exact[k // 64][q, node].sum())
        if hits >= recall * len(some) and found >= recall * true:
            break
        graph.beam *= 2
    return graph


def _save(path: str, **arrays: np.ndarray) -> None:
    held = io.BytesIO()
    np.savez(held, **arrays)
    with common.create(path) as out:
        out.write(held.getbuffer())


class Shard:
    """A shard as its file holds it."""

    def __init__(self, path: str):
        store, at = common.open_store(path)
        with store.open_input_file(at) as file:
            held = np.load(io.BytesIO(file.readall()))
            self.ids, self.copies = held["ids"], held["copies"]
            self.unit = unit(held["vectors"])
            links = [held[f"links{k}"] for k in range(int(held["layers"]))]
            self.graph = Graph(self.unit.astype(np.float32), links, int(held["entry"]), int(held["beam"]))


@lru_cache(maxsize=2)
def _shard(path: str) -> Shard:
    return Shard(path)


def _build(folder: str, least: float, recall: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.sort_by("cls")
        vectors = np.frombuffer(b"".join(rows["vec"].to_pylist()), "<f8").reshape(len(rows), -1)
        x = unit(vectors).astype(np.float32)
        draws = (rows["k2"].to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2 ** 53 + 2 ** -54
        graph = audited(build(x, draws), least, recall)
        path = common.task_file(folder, f"-{key[0].as_py()}-{key[1].as_py()}.npz")
        _save(path, ids=rows["cls"].to_numpy(), copies=rows["copies"].to_numpy(), vectors=vectors, entry=np.int64(graph.entry),
              beam=np.int64(graph.beam), layers=np.int64(len(graph.links)), **{f"links{k}": v for k, v in enumerate(graph.links)})
        return pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()], "path": [path], "rows": [len(rows)], "beam": [graph.beam]},
                        schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("path", pa.string()),
                                          ("rows", pa.int64()), ("beam", pa.int32())]))
    return run


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (each the smallest node of its component) after links between a and b."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _search(least: float):
    def unit_rows(a: Shard, b: Shard, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, links, root class): b's vectors in a's graph."""
        n = len(a.ids)
        counts, root = np.zeros(n + len(b.ids), np.int64), np.arange(n + len(b.ids))
        shift = 0 if same else n
        step = max(16, min(256, (32 << 20) // max(n, 1)))
        for k in range(0, len(b.ids), step):
            q, node = a.graph.in_range(b.graph.x[k:k + step], least, a.graph.beam)
            q = q + k
            for m in range(0, len(q), 200_000):
                i, j = q[m:m + 200_000], node[m:m + 200_000]
                true = np.einsum("pd,pd->p", b.unit[i], a.unit[j]) >= least
                if same:
                    true &= i != j
                i, j = i[true], j[true]
                np.add.at(counts, i + shift, a.copies[j])
                if not same:
                    np.add.at(counts, j, b.copies[i])
                root = _union(root, i + shift, j)
        ids = a.ids if same else np.concatenate([a.ids, b.ids])
        counts, root = counts[:len(ids)], root[:len(ids)]
        at = np.flatnonzero(counts)
        return ids[at], counts[at], ids[root[at]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                arrays = unit_rows(_shard(a), _shard(b), a == b)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["cls", "n", "root"])
    return run


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k1, k2, dim, vec) per row; dim 0 for vectors that link with nothing."""
    import xxhash

    for batch in batches:
        out: list[list] = [[], [], [], []]
        for cell in batch["v"]:
            v = cell.values if cell.is_valid else None
            x = v.to_numpy(zero_copy_only=False) if v is not None and len(v) and not v.null_count else None
            if x is None or not np.isfinite(x).all() or not x.any():
                row = (0, 0, 0, None)
            else:
                raw = x.astype("<f8").tobytes()
                key = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64)
                row = (int(key[0]), int(key[1]), len(x), raw)
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                                         names=["id", "k1", "k2", "dim", "vec"])


class NearVectors:
    """The tables of one search: rows, classes, shards, links."""

    def __init__(self, vectors: DataFrame, least: float = 0.95, recall: float = 0.99, id_col: str = "vec_id",
                 vector_col: str = "embedding", shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS,
                 least_shards: int = LEAST_SHARDS):
        if not 0 < least <= 1:
            raise ValueError("the least cosine must be above 0, and 1 at most")
        self.id_col, self.least = id_col, least
        rows = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
                              F.col(vector_col).cast("array<double>").alias("v"))
        self.rows = materialize(rows.mapInArrow(_vectors, "id long, k1 long, k2 long, dim int, vec binary"), "vectors")
        classes = self.rows.filter("dim > 0").groupBy("k1", "k2", "dim").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
        # The numbers are fixed by the written table.
        self.classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
        sizes = self.classes.groupBy("dim").agg(F.count("*").alias("n"))
        most = F.greatest(F.floor(F.lit(shard_bytes) / (4 * F.col("dim"))), F.lit(1))
        shards = F.greatest(F.ceil(F.col("n") / most), F.least(F.lit(least_shards), F.ceil(F.col("n") / shard_rows)))
        dealt = (self.classes.join(checked_broadcast(sizes.select("dim", shards.cast("long").alias("shards"))), "dim")
                 .withColumn("shard", F.pmod("k1", "shards").cast("int")))
        folder = scratch_path(vectors.sparkSession, "vector-graphs")
        self.graphs = materialize(dealt.groupBy("dim", "shard").applyInArrow(
            _build(folder, least, recall), "dim int, shard int, path string, rows long, beam int"), "graph-manifest")

    def links(self) -> DataFrame:
        """(cls, n, root): a class's links found in two shards, and a class that these lead to."""
        order = F.row_number().over(W.partitionBy("dim").orderBy("shard"))  # a row per shard
        named = materialize(self.graphs.withColumn("k", order), "graph-order")
        pairs = (named.select("dim", F.col("path").alias("a"), F.explode(F.sequence(F.lit(1), "k")).alias("k"))
                 .join(named.select("dim", "k", F.col("path").alias("b")), ["dim", "k"]).select("a", "b"))
        units = materialize(pairs, "shard-pairs")
        return materialize(units.repartition(max(1, units.count())).mapInArrow(
            _search(self.least), "cls long, n long, root long"), "vector-links")

    def groups(self) -> DataFrame:
        """One row per vector: id, n_links, component_id, kept."""
        links = self.links()
        roots = connected_components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
        counted = links.groupBy("cls").agg(F.sum("n").alias("n"))
        at = roots.select(F.col("id").alias("cls"), "root")
        classes = (self.classes.drop("vec").join(counted, "cls", "left").join(at, "cls", "left")
                   .withColumn("root", F.coalesce("root", "cls")))
        smallest = classes.groupBy("root").agg(F.min("id").alias("component_id"))
        named = classes.join(smallest, "root").select(
            "k1", "k2", "dim", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        found = self.rows.select("id", "k1", "k2", "dim").join(named, ["k1", "k2", "dim"], "left")
        component = F.coalesce("component_id", "id")
        return found.select(F.col("id").alias(self.id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                            component.alias("component_id"), (F.col("id") == component).alias("kept"))


def near_vectors(vectors: DataFrame, least: float = 0.95, recall: float = 0.99, id_col: str = "vec_id",
                 vector_col: str = "embedding", **kw) -> DataFrame:
    """One row per vector: id, n_links (other vectors whose cosine with it is ``least`` or more),
    component_id (the smallest id that links lead to, its own included) and kept
    (whether that is its own).

    ``recall`` is what the audits of each graph must reach. Vectors that are
    null, empty, zero or have null or non-finite components link with nothing and
    are kept; vectors of different lengths never link; equal vectors link, each
    row counted; a null id is the lowest integer; rows that share an id are
    vectors each; an empty table gives no row; other columns are not read.
    """
    return NearVectors(vectors, least, recall, id_col, vector_col, **kw).groups()


def op12_vector_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate embeddings at a cosine of 0.95."""
    return near_vectors(common.table(spark, sf_dir, "embeddings"))
