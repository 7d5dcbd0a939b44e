"""Nearest neighbours by cosine, from vantage-point trees over shards.

Distances are those on the unit sphere, a metric that orders like the cosine. The top levels of one
vantage-point tree, built on at most SAMPLE vectors, cut the space into at most REGIONS regions; a
region's rows are dealt by hash to shards of about SHARD rows, and each shard has its own tree. Of
each region the least and largest distance of its rows from each vantage point above it are kept.

A query visits its own region first. That bounds how far its k-th neighbour can be, and all other
regions, and in a shard all subtrees, are left out if the triangle inequality puts them further away
than `factor` times that bound: with factor 1 nothing near is lost and the search is exact, smaller
factors prune more and may lose neighbours. Queries meet a shard in slices of at most about SLICE: a
slice gets the shard's tree once.

Equal vectors have equal neighbours. So the index holds the k + 1 smallest vec_ids of each distinct
vector, which is all that can be an answer, and each distinct vector is searched for once, with one
neighbour more than asked; a query then leaves itself out. A vector that a third of all rows hold is
reduced to that before the shuffle.

What a search keeps is scored again on the original vectors in double precision, row by row, so
that equal vectors have equal scores wherever they stand; ties go to the smaller vec_id.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no
part, nor do rows with a null vec_id. Rows that share a vec_id are one vector, the smallest. Vectors
are compared with those of equal length. Other columns are not read. Without valid rows the result
is empty; with fewer than k candidates all are returned.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from entitymill.llm.common import materialize

SHARD, SLICE, LEAF, TIE = 8192, 8192, 64, 1e-6
#: Vectors, and components of all of them, on which regions are built; regions and vector lengths that
#: have regions at most (other lengths have one region each).
SAMPLE, SAMPLE_SIZE, REGIONS, LENGTHS = 8192, 1 << 22, 1024, 16


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def build(x: np.ndarray, leaf: int = LEAF, seed: int = 5) -> dict[str, np.ndarray]:
    """A tree over unit vectors x: `order` holds their numbers, a node's vantage point first, then
    its inner and its outer half; `nodes` holds (start, stop, inner, outer), -1 for leaves;
    `reach` the (least, largest) distances of the inner and of the outer half."""
    order, nodes, reach = np.arange(len(x)), [], []
    rng, todo = np.random.default_rng(seed), [(0, len(x), -1, 0)]
    while todo:
        start, stop, parent, side = todo.pop()
        if parent >= 0:
            nodes[parent][side] = len(nodes)
        me = len(nodes)
        nodes.append([start, stop, -1, -1])
        reach.append([0.0] * 4)
        if stop - start <= leaf:
            continue
        own = order[start:stop]
        v = rng.integers(len(own))
        own[0], own[v] = own[v], own[0]
        far = np.sqrt(((x[own[1:]] - x[own[0]]) ** 2).sum(axis=1))
        rank = np.argsort(far, kind="stable")
        own[1:], far = own[1:][rank], far[rank]
        half = len(far) // 2
        reach[me] = [far[0], far[half - 1], far[half], far[-1]]
        todo += [(start + 1, start + 1 + half, me, 2), (start + 1 + half, stop, me, 3)]
    return {"order": order, "nodes": np.array(nodes, np.int32).reshape(-1, 4), "reach": np.array(reach).reshape(-1, 4)}


def search(tree: dict, x: np.ndarray, q: np.ndarray, k: int, factor: float, bound: np.ndarray) -> list[np.ndarray]:
    """For each query, the rows of x whose distance ties with or beats the k-th best found, and is
    not above its bound."""
    best, kept = np.repeat(bound[:, None], k, axis=1), [[] for _ in q]
    order, nodes, reach = tree["order"], tree["nodes"], tree["reach"]

    def offer(who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        far = np.sqrt(np.maximum(0, 2 - 2 * (q[who] @ x[rows].T)))
        near = far <= best[who, -1:] + TIE
        for i in np.flatnonzero(near.any(axis=1)):
            kept[who[i]].append((rows[near[i]], far[i][near[i]]))
        best[who] = np.sort(np.partition(np.concatenate((best[who], far), axis=1), k - 1, axis=1)[:, :k], axis=1)
        return far

    def visit(node: int, who: np.ndarray) -> None:
        start, stop, inner, outer = nodes[node]
        if inner < 0:
            offer(who, order[start:stop])
            return
        far = offer(who, order[start : start + 1])[:, 0]
        low_in, high_in, low_out, high_out = reach[node]
        gap = {inner: np.maximum(low_in - far, far - high_in), outer: np.maximum(low_out - far, far - high_out)}
        first = gap[inner] <= gap[outer]
        for rows, path in ((np.flatnonzero(first), (inner, outer)), (np.flatnonzero(~first), (outer, inner))):
            for child in path:
                some = rows[gap[child][rows] <= factor * best[who[rows], -1] + TIE]
                if len(some):
                    visit(child, who[some])

    if len(q) and len(x):
        visit(0, np.arange(len(q)))
    out = []
    for i, parts in enumerate(kept):
        rows, far = (np.concatenate(c) for c in zip(*parts)) if parts else (np.empty(0, int), np.empty(0))
        out.append(rows[far <= best[i, -1] + TIE])
    return out


@dataclass
class Top:
    """The top of a tree over one vector length: node i (from 1, children 2i and 2i + 1) has
    vantage[i - 1] and radius[i - 1]. Rows of region r are within low[r] and high[r] of the vantage
    points above it, level by level."""

    vantage: np.ndarray
    radius: np.ndarray
    depth: int
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def above(self) -> np.ndarray:
        """Numbers of the nodes above each region, from the root."""
        leaf = np.arange(1 << self.depth) + (1 << self.depth)
        return np.stack([leaf >> (self.depth - i) for i in range(self.depth)], axis=1)

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region of each row of unit vectors x, and its distances from the vantage points above."""
        node, far = np.ones(len(x), np.int64), np.zeros((len(x), self.depth))
        for i in range(self.depth):
            far[:, i] = np.sqrt(((x - self.vantage[node - 1]) ** 2).sum(axis=1))
            node = 2 * node + (far[:, i] > self.radius[node - 1])
        return node - (1 << self.depth), far

    def least(self, q: np.ndarray) -> np.ndarray:
        """A lower bound of the distance of each query from the rows of each region."""
        far = np.sqrt(np.maximum(0, (q * q).sum(axis=1)[:, None] + (self.vantage**2).sum(axis=1)[None, :] - 2 * q @ self.vantage.T))
        far = far[:, self.above() - 1]
        return np.maximum(self.low - far, far - self.high).max(axis=2)


def top_of(x: np.ndarray, depth: int, seed: int = 11) -> Top:
    """Splits unit vectors at median distances from vantage points drawn among them."""
    rng, top = np.random.default_rng(seed), Top(np.zeros(((1 << depth) - 1, x.shape[1])), np.zeros((1 << depth) - 1), depth)
    rows = {1: np.arange(len(x))}
    for node in range(1, 1 << depth):
        own = rows.pop(node)
        if len(own):
            v = x[rng.choice(own)]
            far = np.sqrt(((x[own] - v) ** 2).sum(axis=1))
            top.vantage[node - 1], top.radius[node - 1] = v, np.median(far)
            outer = far > top.radius[node - 1]
        else:
            outer = np.zeros(0, bool)
        rows[2 * node], rows[2 * node + 1] = own[~outer], own[outer]
    return top


def cosine(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one original vector with original rows, each by the same operations."""
    q, rows = q.astype(np.float64), rows.astype(np.float64)
    return (rows * q).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((q * q).sum()))


def _pack(**arrays: np.ndarray) -> bytes:
    np.savez(out := io.BytesIO(), **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def _vectors(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).reshape(n, -1)


_TREE = pa.schema([("dim", pa.int32()), ("region", pa.int64()), ("part", pa.int64()), ("tree", pa.binary())])
_FOUND = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _index(table: pa.Table) -> pa.Table:
    ids, raw = table["vec_id"].to_numpy(), _vectors(table["embedding"], len(table))
    order = np.argsort(ids, kind="stable")
    ids, raw = ids[order], raw[order]
    blob = _pack(ids=ids, raw=raw, **build(unit(raw)))
    return pa.table([table["dim"][:1], table["region"][:1], table["part"][:1], pa.array([blob], pa.binary())], schema=_TREE)


def _search(k: int, factor: float):
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if len(trees) and len(queries):
            asked, raw = queries["q"].to_numpy(), _vectors(queries["embedding"], len(queries))
            for blob in trees["tree"]:
                tree = _unpack(blob.as_py())
                hits = search(tree, unit(tree["raw"]), unit(raw), k, factor, queries["bound"].to_numpy())
                for number, q, rows in zip(asked, raw, hits):
                    score, ids = cosine(q, tree["raw"][rows]), tree["ids"][rows]
                    best = np.lexsort((ids, -score))[:k]
                    out[0].extend([number] * len(best))
                    out[1].extend(ids[best])
                    out[2].extend(score[best])
        return pa.table([pa.array(c, f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)

    return run


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch by vector length."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch.take(pa.array(np.flatnonzero(dims == dim)))


def _route(tops):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _grouped(batch):
                region, far = np.zeros(part.num_rows, np.int64), np.zeros((part.num_rows, 0))
                if top := tops.value.get(dim):
                    region, far = top.route(unit(_vectors(part.column("embedding"), part.num_rows)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(region), pa.array(list(far), pa.list_(pa.float64()))], names=[*part.schema.names, "region", "far"])

    return run


def _others(tops, factor: float):
    """Queries with the regions besides their own that they must visit."""

    def run(batches):
        for batch in batches:
            for dim, whole in _grouped(batch):
                if not (top := tops.value.get(dim)):
                    continue
                for at in range(0, whole.num_rows, 256):
                    part = whole.slice(at, 256)
                    bound = factor * part.column("bound").to_numpy()[:, None] + TIE
                    visit = top.least(unit(_vectors(part.column("embedding"), part.num_rows))) <= bound
                    visit[np.arange(part.num_rows), part.column("region").to_numpy()] = False
                    who, region = np.nonzero(visit)
                    rows = part.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("q", "dim", "embedding", "bound")), pa.array(region.astype(np.int64))], names=["q", "dim", "embedding", "bound", "region"])

    return run


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and dim of the vectors that take part, one for each vec_id."""
    e = F.col("embedding")
    finite: Column = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    order = W.partitionBy(key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Index:
    """Regions, shards and trees of a table of valid vectors, for searches for k neighbours."""

    def __init__(self, rows: DataFrame, k: int, shard: int = SHARD, regions: int = REGIONS):
        self.k, self.spark = k, rows.sparkSession
        alike = W.partitionBy("embedding").orderBy("vec_id")
        few = materialize(rows.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k).drop("_n"), "distinct")
        tops = self._tops(few, shard, regions)
        sent = self.spark.sparkContext.broadcast(tops)
        self.kind = rows.schema["embedding"].dataType.simpleString()
        placed = materialize(few.mapInArrow(_route(sent), f"vec_id long, embedding {self.kind}, dim int, region long, far array<double>"), "placed")
        levels = max((t.depth for t in tops.values()), default=0)
        spans = [f(F.get("far", F.lit(i))).alias(f"{n}{i}") for i in range(levels) for n, f in (("low", F.min), ("high", F.max))]
        self.regions = materialize(placed.groupBy("dim", "region").agg(F.ceil(F.count("*") / shard).alias("parts"), *spans), "regions")
        for dim, top in tops.items():
            top.low, top.high = np.full((1 << top.depth, top.depth), np.inf), np.full((1 << top.depth, top.depth), -np.inf)
            for r in self.regions.where(F.col("dim") == dim).collect():  # at most `regions` rows
                top.low[r.region], top.high[r.region] = ([r[f"{n}{i}"] for i in range(top.depth)] for n in ("low", "high"))
        self.tops = self.spark.sparkContext.broadcast(tops)
        part = F.pmod(F.xxhash64("vec_id"), "parts").alias("part")
        dealt = placed.join(self.regions.select("dim", "region", "parts"), ["dim", "region"]).select("vec_id", "embedding", "dim", "region", part)
        self.trees = materialize(dealt.groupBy("dim", "region", "part").applyInArrow(_index, "dim int, region long, part long, tree binary"), "trees")

    def _tops(self, rows: DataFrame, shard: int, regions: int) -> dict[int, Top]:
        sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > shard).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
        out = {}
        for dim, n in sizes:
            limit = max(1, min(SAMPLE, SAMPLE_SIZE // dim))
            table = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).select("embedding").toArrow()
            x = unit(_vectors(table["embedding"], len(table)))
            depth = min(math.ceil(math.log2(n / shard)), int(math.log2(regions)), int(math.log2(max(1, len(x) // 4))))
            if depth:
                out[dim] = top_of(x, depth)
        return out

    def place(self, queries: DataFrame) -> DataFrame:
        """queries (q, embedding, dim) with their region."""
        asked = queries.select(F.col("q").alias("vec_id"), "embedding", "dim").mapInArrow(_route(self.tops), f"vec_id long, embedding {self.kind}, dim int, region long, far array<double>")
        return asked.select(F.col("vec_id").alias("q"), "embedding", "dim", "region")

    def others(self, queries: DataFrame, factor: float) -> DataFrame:
        """The visits to other regions of queries (q, embedding, dim, region, bound)."""
        return queries.select("q", "dim", "embedding", "bound", "region").mapInArrow(_others(self.tops, factor), f"q long, dim int, embedding {self.kind}, bound double, region long")

    def visit(self, visits: DataFrame, factor: float) -> DataFrame:
        """q, vec_id and score of what visits (q, embedding, dim, region, bound) find, k for each shard."""
        counts = visits.groupBy("dim", "region").agg(F.ceil(F.count("*") / SLICE).alias("slices"))
        plan = materialize(self.regions.select("dim", "region", "parts").join(counts, ["dim", "region"]), "slices")
        to = visits.join(plan, ["dim", "region"]).withColumn("slice", F.pmod(F.xxhash64("q"), "slices"))
        to = to.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("dim", "region", "part", "slice", "q", "embedding", "bound")
        trees = self.trees.join(plan.select("dim", "region", "slices"), ["dim", "region"]).select("dim", "region", "part", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "tree")
        key = ["dim", "region", "part", "slice"]
        return trees.groupBy(*key).cogroup(to.groupBy(*key)).applyInArrow(_search(self.k, factor), "q long, vec_id long, score double")


def nearest(vectors: DataFrame, asked: Column, k: int = 5, factor: float = 1.0, shard: int = SHARD, regions: int = REGIONS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of each vector for which `asked` holds."""
    rows = materialize(valid_vectors(vectors), "vectors")
    index = Index(rows, k + 1, shard, regions)
    asked_rows = materialize(rows.where(asked), "asked")
    alike = materialize(asked_rows.groupBy("embedding", "dim").agg(F.min("vec_id").alias("q")), "alike")
    queries = materialize(index.place(alike), "queries")
    first = materialize(_best(index.visit(queries.withColumn("bound", F.lit(float("inf"))), factor), "q", k + 1), "first")
    far = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))) + TIE
    bound = first.groupBy(F.col("q").alias("_q")).agg(F.when(F.count("*") > k, far).otherwise(F.lit(float("inf"))).alias("bound"))
    others = materialize(index.others(queries.join(bound, F.col("q") == F.col("_q")), factor), "visits")
    found = first.select("q", "vec_id", "score").unionByName(index.visit(others, factor))
    found = materialize(_best(found, "q", k + 1).select("q", "vec_id", "score"), "found")
    who = asked_rows.select(F.col("vec_id").alias("query_id"), "embedding").join(alike, "embedding").select("query_id", "q")
    answers = who.join(found, "q").where(F.col("vec_id") != F.col("query_id"))
    return _best(answers, "query_id", k).select("query_id", "rank", "vec_id", "score")
