"""Approximate nearest neighbours: a forest of random-projection trees, a shared queue, exact reranking.

The trees are fitted on a sample of at most `SAMPLE` distinct vectors, one task a tree: each node halves its vectors
at the median of a random projection, down to `LEAF` of the sample. Every distinct vector is then put into its leaf
of every tree.

A query puts the leaves of all trees into one queue, in the order of the probability that a neighbour lies there: at each
node on the way a neighbour at distance r differs from the query by about r / sqrt(d) along the direction, which tells how
likely it is on either side; r is the k-th distance among the sample vectors in the query's own leaves. Leaves are taken
until a neighbour would be in none of them, over all trees, with probability `MISS` at most. So a query among clusters
reads few leaves, and one among near-random vectors, whose neighbours are hardly nearer than others, most of them. The
probabilities take directions as independent, which they are not quite: recall is measured in the tests.

Leaves are grouped into parts of subtrees of about `PART` vectors, and the queries of a part into blocks of `BLOCK`; a task
compares a part's leaves with a block of the queries that chose them, first by products of matrices, then the few that can
be among the best by exact distances. The best of all parts are the result.

Equal vectors are indexed once, with the least ids of each, as many as a result can hold.

Defined results: a vector that is null, empty, zero, of another length than most of the sample, or holds null or
non-finite components takes no part, nor does a row with a null id; rows equal in id and vector are one,
and where an id has several vectors the nearest counts. Fewer
candidates than `k` give all of them. Ties go to the smaller id. No queries or an empty table: an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace
from shelfcast.llm.vectors import matrix, usable

SAMPLE, TREES, LEAF, PART = 16_384, 8, 16, 16_384
#: Probability to miss a neighbour by the model of the queue; queries of a block; queries whose projections are made at once.
MISS, BLOCK, AT_ONCE = 1e-4, 8192, 64


class Tree:
    """Arrays by node: direction, threshold, children (a leaf: -1 and its number)."""

    def __init__(self, points: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[tuple[int, int]] = []
        self.leaf_rows: list[np.ndarray] = []
        zero = np.zeros(points.shape[1], np.float32)

        def build(rows: np.ndarray) -> int:
            at = len(self.children)
            self.children.append((-1, -1))
            direction = random.standard_normal(points.shape[1])
            direction = (direction / np.linalg.norm(direction)).astype(np.float32)
            values = points[rows] @ direction
            threshold = float(np.median(values)) if len(rows) else 0.0
            left = values <= threshold
            if len(rows) <= LEAF or left.all():
                self.directions.append(zero)
                self.thresholds.append(0.0)
                self.children[at] = (-1, len(self.leaf_rows))
                self.leaf_rows.append(rows)
                return at
            self.directions.append(direction)
            self.thresholds.append(threshold)
            self.children[at] = (build(rows[left]), build(rows[~left]))
            return at

        build(np.arange(len(points)))
        self.directions = np.array(self.directions)
        self.thresholds = np.array(self.thresholds)
        self.children = np.array(self.children)

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point. A leaf's number also tells its place: subtrees hold consecutive leaves."""
        node = np.zeros(len(points), np.int64)
        active = np.flatnonzero(self.children[node, 0] >= 0)
        while len(active):
            at = node[active]
            right = (points[active] * self.directions[at]).sum(axis=1) > self.thresholds[at]
            node[active] = self.children[at, right.astype(np.int64)]
            active = active[self.children[node[active], 0] >= 0]
        return self.children[node, 1]


class Forest:
    """All trees as one set of arrays, nodes and leaves numbered through; levels are lists of inner nodes."""

    def __init__(self, trees: list[Tree], points: np.ndarray, k: int):
        self.trees, self.points, self.k = trees, points, k
        nodes = np.cumsum([0, *(len(t.children) for t in trees)])
        self.first_leaf = np.cumsum([0, *(len(t.leaf_rows) for t in trees)])
        self.directions = np.concatenate([t.directions for t in trees])
        self.thresholds = np.concatenate([t.thresholds for t in trees])
        self.size = int(nodes[-1])
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        self.leaf = np.full(self.size, -1)
        for t, tree in enumerate(trees):
            left, right = tree.children.T
            own = slice(nodes[t], nodes[t + 1])
            inner = left >= 0
            self.left[own] = np.where(inner, left + nodes[t], -1)
            self.right[own] = np.where(inner, right + nodes[t], -1)
            self.leaf[own] = np.where(inner, -1, right + self.first_leaf[t])
        self.roots = nodes[:-1]
        self.levels, level = [], self.roots
        while len(level := level[self.left[level] >= 0]):
            self.levels.append(level)
            level = np.concatenate([self.left[level], self.right[level]])
        self.leaves = np.flatnonzero(self.leaf >= 0)
        self.leaves = self.leaves[np.argsort(self.leaf[self.leaves])]
        self.tree_of_leaf = np.repeat(np.arange(len(trees)), np.diff(self.first_leaf))
        self.rows = [rows for t in trees for rows in t.leaf_rows]

    def sides(self, queries: np.ndarray) -> np.ndarray:
        """How far each query lies beyond the hyperplane of each node."""
        return queries @ self.directions.T - self.thresholds

    def search(self, query: np.ndarray, side: np.ndarray) -> np.ndarray:
        """Leaves in which neighbours of the query may lie, by the shared queue."""
        home = self.roots
        while (inner := self.left[home] >= 0).any():
            home = np.where(inner, np.where(side[home] > 0, self.right[home], self.left[home]), home)
        near = np.unique(np.concatenate([self.rows[leaf] for leaf in self.leaf[home]]))
        distance = np.sqrt(((self.points[near] - query) ** 2).sum(axis=1))
        radius = max(float(np.partition(distance, min(self.k, len(near) - 1))[min(self.k, len(near) - 1)]), 1e-9)
        # the normal distribution by a logistic curve; steeper for nearer neighbours
        x = np.clip(side * (1.702 * math.sqrt(len(query)) / radius), -500, 500)
        onto_right = -np.logaddexp(0, -x)
        onto_left = onto_right - x
        likely = np.zeros(self.size)
        for level in self.levels:
            likely[self.left[level]] = likely[level] + onto_left[level]
            likely[self.right[level]] = likely[level] + onto_right[level]
        likely = likely[self.leaves]
        queue = np.argsort(-likely, kind="stable")
        tree, mass = self.tree_of_leaf[queue], np.exp(likely[queue])
        # what each tree has left of the neighbours after each leaf of the queue
        by_tree = np.argsort(tree, kind="stable")
        upto = np.cumsum(mass[by_tree])
        starts = np.searchsorted(tree[by_tree], np.arange(len(self.trees)))
        upto -= np.concatenate([[0], upto])[starts][tree[by_tree]]
        left = np.log(np.maximum(1 - upto, 1e-12))
        step = left - np.where(np.isin(np.arange(len(left)), starts), 0, np.concatenate([[0], left[:-1]]))
        missed = np.empty(len(queue))
        missed[by_tree] = step
        enough = np.flatnonzero(np.cumsum(missed) <= math.log(MISS))
        return queue[: enough[0] + 1] if len(enough) else queue


def _parts(tree: Tree, n: int, sampled: int) -> np.ndarray:
    """Part of each leaf: consecutive leaves that hold about `PART` of all vectors."""
    sizes = np.array([len(r) for r in tree.leaf_rows], np.float64) * (n / max(sampled, 1))
    return ((np.cumsum(sizes) - sizes) // PART).astype(np.int32)


def _index(forest, parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column(2))
            for t, tree in enumerate(forest.value.trees):
                leaf = tree.leaves(points)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(leaf), t, np.int32)), pa.array(parts.value[t][leaf]),
                     pa.array(leaf.astype(np.int32)), *batch.columns],
                    names=["tree", "part", "leaf", "node", "first_id", "vector"],
                )

    return run


def _queries(forest, parts):
    """A row for each part that a query chose leaves of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        part_of = np.concatenate(parts.value)
        for batch in batches:
            ids, points = batch.column(0).to_numpy(), matrix(batch.column(1))
            for start in range(0, batch.num_rows, AT_ONCE):
                some = points[start : start + AT_ONCE]
                which, trees, chosen, lists = [], [], [], []
                for row, (query, side) in enumerate(zip(some, f.sides(some), strict=True), start):
                    leaves = np.sort(f.search(query, side))
                    place = f.tree_of_leaf[leaves] * (1 << 32) + part_of[leaves]
                    cuts = np.flatnonzero(np.diff(place, prepend=-1))
                    which += [row] * len(cuts)
                    trees += f.tree_of_leaf[leaves[cuts]].tolist()
                    chosen += part_of[leaves[cuts]].tolist()
                    lists += np.split(leaves - f.first_leaf[f.tree_of_leaf[leaves]], cuts[1:])
                ends = np.cumsum([0, *map(len, lists)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trees, pa.int32()), pa.array(chosen, pa.int32()), pa.array(ids[which]),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int32())),
                     batch.column(1).take(pa.array(which))],
                    names=["tree", "part", "query_id", "leaves", "vector"],
                )

    return run


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, a row a query."""
    out = np.empty((len(queries), len(points)))
    for i, q in enumerate(queries):
        d = points - q
        out[i] = np.sqrt((d * d).sum(axis=1))
    return out


def _best(k: int):
    """Each query's `k` + 1 best of a part; one may be the query itself."""

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()),
                         "score": pa.array([], pa.float64())})
        if not points.num_rows or not queries.num_rows:
            return none
        order = np.argsort(points.column("leaf").to_numpy(), kind="stable")
        leaf, node, first = (points.column(c).to_numpy()[order] for c in ("leaf", "node", "first_id"))
        vectors = matrix(points.column("vector").combine_chunks())[order]
        squares = (vectors * vectors).sum(axis=1)
        wanted = matrix(queries.column("vector").combine_chunks())
        ids = queries.column("query_id").to_numpy()
        lists = queries.column("leaves").combine_chunks()
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy()
        chosen = np.zeros(int(leaf[-1]) + 1, bool)
        found = []
        for start in range(0, len(wanted), AT_ONCE):
            block = wanted[start : start + AT_ONCE]
            # squared distances but for the query's own square; exact ones follow for those that can count
            rough = squares - 2 * (block @ vectors.T)
            for i, (q, near) in enumerate(zip(block, rough, strict=True), start):
                own = flat[ends[i] : ends[i + 1]]
                own = own[own < len(chosen)]
                chosen[own] = True
                rows = np.flatnonzero(chosen[leaf])
                chosen[own] = False
                if not len(rows):
                    continue
                if len(rows) > k + 1:
                    near = near[rows]
                    slack = 1e-9 * (float(q @ q) + float(squares[rows].max()))
                    rows = rows[near <= np.partition(near, k)[k] + slack]
                score = distances(q[None], vectors[rows])[0]
                best = np.lexsort((first[rows], score))[: k + 1]
                found.append((np.full(len(best), ids[i]), node[rows[best]], score[best]))
        if not found:
            return none
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({"query_id": columns[0], "node": columns[1], "score": columns[2]})

    return run


def nearest(
    embeddings: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score (Euclidean distance)."""
    spark = embeddings.sparkSession
    work = Workspace(spark)
    rows = embeddings.select(
        embeddings[id_col].cast("long").alias("id"), embeddings[vector_col].alias("vector"), is_query.alias("query")
    ).where(usable(F.col("vector")) & F.col("id").isNotNull())
    some = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if some is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = work.keep(rows.where(F.size("vector") == some["d"]).dropDuplicates(["id", "vector"]), "rows")

    # a class is named by its least id; results need k others at most
    first = Window.partitionBy("vector").orderBy("id")
    least = rows.select("id", "vector").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    grouped = least.groupBy("vector").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))
    # the same id with two vectors would name two classes alike
    classes = work.keep(
        grouped.select("vector", "ids", F.col("node").alias("first_id"), F.monotonically_increasing_id().alias("node")),
        "classes",
    )
    n = classes.count()
    sample = classes.select("vector").sample(min(1.0, SAMPLE / n), seed=1).limit(SAMPLE) if n > SAMPLE else classes
    taken = sample.select("vector").toArrow().column(0).combine_chunks()
    points = spark.sparkContext.broadcast(taken.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(taken), -1))
    del taken

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                raw = pickle.dumps(Tree(points.value, 1000 + t))
                yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([raw], pa.binary())], names=["t", "tree"])

    planted = spark.range(0, TREES, 1, TREES).mapInArrow(plant, "t long, tree binary").collect()
    trees = [pickle.loads(bytes(r["tree"])) for r in sorted(planted, key=lambda r: r["t"])]
    del planted
    sampled = len(points.value)
    parts = spark.sparkContext.broadcast([_parts(t, n, sampled) for t in trees])
    # of a sample, fewer are as near as the k-th of all
    among = max(1, math.ceil(k * sampled / n))
    forest = spark.sparkContext.broadcast(Forest(trees, points.value.astype(np.float64), among))

    vector = rows.schema["vector"].dataType.simpleString()
    indexed = classes.select("node", "first_id", "vector").mapInArrow(
        _index(forest, parts), f"tree int, part int, leaf int, node long, first_id long, vector {vector}"
    )
    asked = work.keep(rows.where("query").select("id", "vector"), "queries")
    asked = asked.mapInArrow(
        _queries(forest, parts), f"tree int, part int, query_id long, leaves array<int>, vector {vector}"
    )
    # a part that many queries chose meets them in several tasks
    blocks = max(1, math.ceil(rows.where("query").count() / BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    keys = ["tree", "part", "block"]
    found = indexed.withColumn("block", each).groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _best(k), "query_id long, node long, score double"
    )
    # a query has k + 1 rows of each part at most; a vector found in several trees counts once
    nearest_classes = found.groupBy("query_id", "node").agg(F.min("score").alias("score")).join(classes.select("node", "ids"), "node")
    each = nearest_classes.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    by_distance = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(by_distance)).where(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")
