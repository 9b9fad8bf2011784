"""Approximate nearest neighbours by largest inner product: a forest of
random-projection trees searched through one shared priority queue, leaf
candidates reranked exactly.

The split planes are fitted on a bounded sample; every vector is indexed.  Equal
vectors are indexed once, with the smallest ids that could still be in a result,
so a group of copies fills no leaf.  How many trees are searched and how many leaves
a query visits is set for every table: for a bounded sample of queries the true
neighbours are found by one pass over all vectors, and the fewest leaves are taken
that hold the wanted share of them (``calibrate``).  A tree's leaves are dealt to
tasks in shards (subtrees), large ones in blocks of bounded size; a query goes once
to every shard in which its queue has found leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from crease.llm.common import bounded_sample, cut, frugal, shuffle_width
from crease.operators.scan import top_n

#: Trees at most (halved while fewer need fewer leaves, two at least), vectors of a leaf and of a shard.
TREES, LEAF, SHARD = 8, 128, 4_096
#: Vectors of the sample on which the planes are fitted.
SAMPLE = 32_768
#: Queries whose true neighbours set the leaves to visit, and the share of these neighbours wanted there.
PROBES, RECALL = 48, 0.95


class Forest:
    """Split planes of several trees of one depth; a plane's direction parts two
    clusters grown from a drawn pair of the node's sample, its offset is their median."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 5):
        draw = np.random.default_rng(seed)
        inner, width = 2 ** depth - 1, sample.shape[1] if sample.ndim == 2 else 0
        self.depth, self.planes, self.offsets = depth, np.zeros((trees, inner, width)), np.zeros((trees, inner))
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                own = members.pop(node)
                direction = self._direction(sample[own], draw)
                along = sample[own] @ direction
                offset = float(np.median(along)) if len(along) else 0.0
                self.planes[tree, node], self.offsets[tree, node] = direction, offset
                members[2 * node + 1], members[2 * node + 2] = own[along <= offset], own[along > offset]

    @staticmethod
    def _direction(own: np.ndarray, draw) -> np.ndarray:
        a, b = (own[draw.choice(len(own), 2, replace=False)] if len(own) > 1 else draw.normal(size=(2, own.shape[1])))
        for _ in range(4):
            near = own @ (a - b) > (a @ a - b @ b) / 2
            if near.all() or not near.any():
                break
            a, b = own[near].mean(axis=0), own[~near].mean(axis=0)
        size = np.linalg.norm(a - b)
        other = draw.normal(size=own.shape[1])
        return (a - b) / size if size > 1e-12 else other / max(1e-12, np.linalg.norm(other))

    def first(self, trees: int) -> "Forest":
        """The forest of the first ``trees`` trees."""
        out = object.__new__(Forest)
        out.depth, out.planes, out.offsets = self.depth, self.planes[:trees], self.offsets[:trees]
        return out

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Leaf (0 to 2**depth - 1) of every row in every tree."""
        out = np.zeros((len(self.planes), len(rows)), np.int64)
        for tree, (planes, offsets) in enumerate(zip(self.planes, self.offsets)):
            node = np.zeros(len(rows), np.int64)
            if self.depth:
                right = rows @ planes.T > offsets
                for _ in range(self.depth):
                    node = 2 * node + 1 + right[np.arange(len(rows)), node]
            out[tree] = node - (2 ** self.depth - 1)
        return out

    def visit(self, row: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The first ``visits`` leaves (tree, leaf) that the queue, shared by all
        trees, gives out: nodes by the smallest margin on their path."""
        inner = 2 ** self.depth - 1
        margins = (self.planes @ row - self.offsets).tolist()
        queue = [(-np.inf, tree, 0) for tree in range(len(self.planes))]
        found = []
        while queue and len(found) < visits:
            worst, tree, node = heapq.heappop(queue)
            own = margins[tree]
            while node < inner:
                m = own[node]
                heapq.heappush(queue, (max(worst, abs(m)), tree, 2 * node + (1 if m > 0 else 2)))
                worst, node = max(worst, -abs(m)), 2 * node + (2 if m > 0 else 1)
            found.append((tree, node - inner))
        return found


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, one per id, of the most common length."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")) \
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()) \
        .filter(~bad & F.exists("v", lambda x: x != 0)).groupBy("vec_id").agg(F.min("v").alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (common[0]["n"] if common else 0))


def _matrix(column, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _least_ids(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their ``k`` smallest ids: first per batch, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple, list] = {}
            keys = zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist())
            for k1, (key, vec) in enumerate(zip(keys, batch.column("vec_id").to_pylist())):
                held.setdefault(key, [k1, []])[1].append(vec)
            at = pa.array([x[0] for x in held.values()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1").take(at), batch.column("h2").take(at), batch.column("v").take(at),
                 pa.array([heapq.nsmallest(k, x[1]) for x in held.values()], pa.list_(pa.int64()))], ["h1", "h2", "v", "ids"])

    some = rows.mapInArrow(frugal(run), "h1 long, h2 long, v array<double>, ids array<long>")
    return some.groupBy("h1", "h2").agg(F.min("v").alias("v"), F.flatten(F.collect_list("ids")).alias("ids")) \
        .select("h1", "h2", "v", F.slice(F.array_sort("ids"), 1, k).alias("ids"))


def _true_neighbours(nodes: DataFrame, asked: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` distinct vectors of largest inner product for each row of ``asked``."""
    width = asked.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, rows = np.full((len(asked), 0), -np.inf), np.zeros((len(asked), 0, width))
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            own = asked @ x.T
            top = np.argpartition(-own, min(k, len(x)) - 1, axis=1)[:, :k]
            scores = np.concatenate([scores, np.take_along_axis(own, top, axis=1)], axis=1)
            rows = np.concatenate([rows, x[top]], axis=1)
            if scores.shape[1] > k:
                top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                scores, rows = np.take_along_axis(scores, top, axis=1), np.take_along_axis(rows, top[:, :, None], axis=1)
        if scores.shape[1]:
            n = scores.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(asked)), n).astype(np.int32)), pa.array(scores.ravel()),
                 pa.array(rows.reshape(-1, width).tolist(), pa.list_(pa.float64()))], ["q", "score", "v"])

    found = nodes.select("v").mapInArrow(frugal(run), "q int, score double, v array<double>")
    best = top_n(found, ["q"], [F.desc("score"), F.col("v")], k, salt_by=["score"]).collect()  # probes x k
    return [np.array([r["v"] for r in best if r["q"] == q]).reshape(-1, width) for q in range(len(asked))]


def calibrate(forest: Forest, asked: np.ndarray, near: list[np.ndarray], longest: float, recall: float,
              sample: np.ndarray) -> tuple[int, int, float]:
    """(trees, visits, share): how many of the forest's trees to search and how many
    leaves to visit so that they hold the share ``recall`` of the known neighbours,
    by the fewest leaves, and the share of the (lifted) sample that these leaves hold."""
    every, best = 2 ** forest.depth, None
    trees = len(forest.planes)
    places = [forest.leaves(_lift(rows, longest)) for rows in near]
    while trees:
        part = forest.first(trees)
        orders, needed = [], []
        for row, own in zip(_lift(asked, None), places):
            order = part.visit(row, trees * every)
            rank = np.zeros((trees, every), np.int64)
            for n, (tree, leaf) in enumerate(order):
                rank[tree, leaf] = n + 1
            orders.append(rank)
            needed += rank[np.arange(trees)[:, None], own[:trees]].min(axis=0).tolist()
        visits = int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) if needed else trees * every
        if best is None or visits < best[1]:
            held = part.leaves(sample) if len(sample) else np.zeros((trees, 0), np.int64)
            share = np.mean([(rank[np.arange(trees)[:, None], held].min(axis=0) <= visits).mean() for rank in orders]) \
                if orders and held.shape[1] else 1.0
            best = (trees, visits, float(share))
        trees = trees // 2 if trees > 2 else 0
    return best


def search(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           trees: int = TREES, leaf: int = LEAF, shard: int = SHARD, sample: int = SAMPLE, probes: int = PROBES,
           recall: float = RECALL, told: dict | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every id divisible by ``every`` the
    ``k`` nearest other ids found, by falling inner product, ties to the smaller id.

    Vectors that are null, zero, hold null or non-finite components, or have
    another length than most take no part, nor do null ids; of an id's several
    vectors the smallest counts.  Fewer than ``k`` others give as many rows; an
    empty table gives none; other columns are not read.  ``told`` is given what
    ``calibrate`` has found (trees, visits, share of all vectors that a query scores).
    """
    spark = vectors.sparkSession
    rows = cut(_usable(vectors, id_col, vector_col)
               .select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(3), "v").alias("h2")))
    nodes = cut(_least_ids(rows, k + 1).withColumn("node", F.element_at("ids", 1)))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    count, longest, width = nodes.agg(F.count("*"), F.max(squares), F.max(F.size("v"))).first()
    width, longest = width or 0, longest or 0.0
    depth = max(0, int(np.ceil(np.log2(max(1, min(count, 4 * sample) / leaf)))))
    drawn = bounded_sample(nodes.select("node", "v"), sample, "node").select("v").toArrow()
    # One more coordinate makes all vectors equally long, so that the nearest by angle is that by inner product.
    lifted = _lift(_matrix(drawn.column(0), width), longest) if count else np.zeros((0, 1))
    asked = rows.filter(F.col("vec_id") % every == 0)
    queries = cut(nodes.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi"))
    whole = Forest(lifted, max(1, trees), depth)
    probe = bounded_sample(queries.select("node", "v"), probes, "node").select("v").toArrow()
    probe = _matrix(probe.column(0), width) if count else np.zeros((0, 1))
    near = _true_neighbours(nodes, probe, k + 1) if len(probe) else []
    use, stops, share = calibrate(whole, probe, near, longest, recall, lifted)
    if told is not None:
        told |= {"trees": use, "visits": stops, "share": share, "leaves": 2 ** depth}
    forest = spark.sparkContext.broadcast(whole.first(use))
    upper = max(0, min(depth, int(np.ceil(np.log2(max(1, count / shard))))))
    below = depth - upper

    def count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(use << upper, np.int64)
        for batch in batches:
            for tree, own in enumerate(forest.value.leaves(_lift(_matrix(batch.column("v"), width), longest))):
                total += np.bincount((tree << upper) + (own >> below), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["shard", "n"])

    # a shard of many vectors is cut into blocks; there are at most trees x 2**depth numbers of blocks
    cuts = np.ones(use << upper, np.int64)
    if count > shard:
        for r in nodes.select("v").mapInArrow(count_shards, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n")).collect():
            cuts[r["shard"]] = max(1, -(-r["n"] // (2 * shard)))
    base_of = np.concatenate(([0], np.cumsum(cuts)))[:-1]

    def place(shards: np.ndarray, node) -> np.ndarray:
        ids = node.to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return base_of[shards] + (ids % cuts[shards].astype(np.uint64)).astype(np.int64)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.value.leaves(_lift(_matrix(batch.column("v"), width), longest))
            for tree, own in enumerate(leaves):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place(np.full(n, tree, np.int64) * (1 << upper) + (own >> below), batch.column("node"))),
                     pa.array(np.zeros(n, np.int32)),
                     batch.column("node"), batch.column("v"), batch.column("ids"),
                     pa.array([[x] for x in (own & ((1 << below) - 1)).tolist()], pa.list_(pa.int32()))], _SENT.names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at, to, lists = _matrix(batch.column("v"), width), [], [], []
            for i, row in enumerate(_lift(own, None)):
                shards: dict[int, list] = {}
                for tree, leaf_at in forest.value.visit(row, stops):
                    shards.setdefault((tree << upper) + (leaf_at >> below), []).append(leaf_at & ((1 << below) - 1))
                for number, leaves in shards.items():
                    blocks = int(cuts[number])
                    at += [i] * blocks
                    to += range(int(base_of[number]), int(base_of[number]) + blocks)
                    lists += [leaves] * blocks
            take = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), pa.array(np.ones(len(at), np.int32)), take.column("node"), take.column("v"),
                 pa.array([None] * len(at), pa.list_(pa.int64())), pa.array(lists, pa.list_(pa.int32()))], _SENT.names)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_at, held, base = None, [], None
        for batch in batches:
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.diff(shards) | np.diff(kinds)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                part = batch.slice(start, end - start)
                if shards[start] != shard_at:
                    shard_at, held, base = shards[start], [], None
                if kinds[start] == 0:
                    held.append(part)
                    continue
                if base is None:
                    base = _Shard(held, width, k + 1)
                    held = []
                for first in range(0, part.num_rows, 256):
                    yield base.nearest(part.slice(first, 256))

    wide = shuffle_width(spark)
    sent = nodes.select("node", "v", "ids").mapInArrow(frugal(index), _SENT) \
        .unionAll(queries.select("node", "v", "ids").mapInArrow(frugal(route), _SENT))
    found = sent.repartition(wide, "shard").sortWithinPartitions("shard", "kind").mapInArrow(frugal(rerank), _FOUND)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        scores = table.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ids, scores = _top(ids, scores, k + 1)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64())),
                                     pa.array([scores.tolist()], pa.list_(pa.float64()))], _FOUND.names)

    best = found.groupBy("node").applyInArrow(merge, _FOUND) \
        .join(queries.select("node", "h1", "h2"), "node").drop("node")
    others = F.slice(F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("vec_id")), 1, k)
    return asked.select("vec_id", "h1", "h2").join(best, ["h1", "h2"]) \
        .select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "x")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"),
                F.col("x.scores").alias("score"))


_SENT = StructType([StructField("shard", LongType()), StructField("kind", IntegerType()), StructField("node", LongType()),
                    StructField("v", ArrayType(DoubleType())), StructField("ids", ArrayType(LongType())),
                    StructField("leaves", ArrayType(IntegerType()))])
_FOUND = StructType([StructField("node", LongType()), StructField("ids", ArrayType(LongType())),
                     StructField("scores", ArrayType(DoubleType()))])


def _lift(rows: np.ndarray, longest: float | None) -> np.ndarray:
    extra = np.zeros(len(rows)) if longest is None else np.sqrt(np.maximum(0, longest - (rows ** 2).sum(axis=1)))
    return np.column_stack([rows, extra])


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best distinct ids: score falling, then id."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:k]
    return ids[order], scores[order]


class _Shard:
    """Vectors of a subtree by leaf, and the exact scores of queries against them."""

    def __init__(self, parts: list, width: int, k: int):
        self.k, self.width = k, width
        table = pa.Table.from_batches(parts) if parts else None
        self.size = table.num_rows if table else 0
        if self.size:
            leaf = table.column("leaves").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(leaf, kind="stable")
            self.rows = _matrix(table.column("v"), width)[order]
            self.starts = np.searchsorted(leaf[order], np.arange(int(leaf.max()) + 2))
            ids = table.column("ids").to_pylist()
            self.ids = [ids[i] for i in order.tolist()]

    def nearest(self, part: pa.RecordBatch) -> pa.RecordBatch:
        """The best ids of every query, among the leaves that it visits."""
        queries, lists, at, out = _matrix(part.column("v"), self.width), part.column("leaves").to_pylist(), [], []
        by_leaf: dict[int, list] = {}
        for q, own in enumerate(lists):
            for leaf in own:
                by_leaf.setdefault(leaf, []).append(q)
        scores = np.full((len(lists), self.size), -np.inf)
        for leaf, who in by_leaf.items():
            if self.size and leaf < len(self.starts) - 1:
                a, b = self.starts[leaf], self.starts[leaf + 1]
                scores[who, a:b] = queries[who] @ self.rows[a:b].T
        k = min(self.k, self.size)
        for q in range(len(lists) if k else 0):
            bar = np.partition(scores[q], self.size - k)[self.size - k]
            near = np.flatnonzero((scores[q] >= bar) & (scores[q] > -np.inf))
            if len(near):
                at.append(q)
                sizes = [len(self.ids[i]) for i in near]
                out.append(_top(np.array([x for i in near for x in self.ids[i]], np.int64),
                                np.repeat(scores[q, near], sizes), self.k))
        return pa.RecordBatch.from_arrays(
            [part.column("node").take(pa.array(at, pa.int64())), pa.array([o[0].tolist() for o in out], pa.list_(pa.int64())),
             pa.array([o[1].tolist() for o in out], pa.list_(pa.float64()))], _FOUND.names)
