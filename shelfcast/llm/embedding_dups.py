"""Embedding near-duplicates by Euclidean p-stable hashing, then exact cosines.

Normalised vectors are projected on Gaussian directions, shifted and cut into steps of `WIDTH`; `k` steps make the
bucket of a table. At the least similarity wanted, two vectors lie sqrt(2 - 2 * similarity) apart and share a step
with probability p1; unrelated ones lie sqrt(2) apart and share it with p2. `k` grows with the logarithm of the number
of vectors, so that a bucket holds about `STRANGERS` unrelated ones at any size, and the number of tables is what
finds a pair at the very threshold with probability `RECALL`; closer pairs are found with more.

Equal vectors are one class with a number of copies. Pairs never leave a task: it returns, for each linked vector, the
number of its links and one vector, the same for all that are joined by these links. A link is counted in the first table that
finds it, which both sides' buckets tell. Buckets of more than `TILE` vectors are cut into tiles, compared pair by pair in tasks.

Defined results: a vector that is null, empty, zero or holds null or non-finite components links with nothing, nor
do vectors of different lengths. Repeated rows are linked rows. Null ids take part, but no component is named after
one unless it has no other id. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace
from shelfcast.llm.components import connected_components
from shelfcast.llm.shingles import mix
from shelfcast.llm.vectors import classes, matrix

WIDTH, STRANGERS, RECALL, TILE = 1.8, 32, 0.999, 2048
#: Buckets up to this size are compared together, and so many pairs at a time.
SMALL, PAIRS = 24, 1 << 16


def same_step(distance: float) -> float:
    """Probability that points this far apart share a step of one projection."""
    r = WIDTH / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


class Tables:
    """Projections of all tables for vectors of one length; the same on every machine."""

    def __init__(self, size: int, n: int, similarity: float):
        near, far = same_step(math.sqrt(2 - 2 * similarity)), same_step(math.sqrt(2))
        self.k = max(4, round(math.log(max(n / STRANGERS, 1)) / -math.log(far)))
        self.tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near**self.k))
        random = np.random.default_rng(17)
        self.directions = random.standard_normal((size, self.tables * self.k))
        self.shifts = random.uniform(0, WIDTH, self.tables * self.k)
        self.salts = random.integers(0, 2**63, self.tables * self.k, dtype=np.uint64)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table: a hash of the table and the steps."""
        steps = np.floor((unit @ self.directions + self.shifts) / WIDTH).astype(np.int64).view(np.uint64)
        scattered = mix(steps * np.uint64(0x9E3779B97F4A7C15) + self.salts)
        return mix(scattered.reshape(len(unit), self.tables, self.k).sum(axis=2, dtype=np.uint64))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _keys(n: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing: dict[int, Tables] = {}
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                t = hashing.setdefault(size, Tables(size, n, similarity))
                part = batch.filter(pa.array(sizes == size))
                keys = t.keys(units(matrix(part.column(1)))).view(np.int64)
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.ListArray.from_arrays(
                        pa.array(np.arange(rows + 1) * t.tables, pa.int32()), pa.array(keys.ravel()))],
                    names=["node", "vector", "copies", "keys"],
                )

    return run


def _links(unit: np.ndarray, starts: np.ndarray, ends: np.ndarray, sides: np.ndarray | None, similarity: float):
    """Places (i, j) of linked vectors that share a bucket; the rows of a bucket follow each other.

    Small buckets are compared all at once, each row with the one that lies 1, 2, ... behind it; a larger bucket is one
    matrix product. Cosines next to the threshold are summed again in one order, whatever the bucket was.
    """
    def exact(i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        close = np.flatnonzero(np.abs(cosines - similarity) < 1e-9)
        cosines[close] = np.einsum("ij,ij->i", unit[i[close]], unit[j[close]])
        return cosines >= similarity

    def linked(i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = exact(i, j, cosines)
        if sides is not None:
            keep &= sides[i] != sides[j]
        return i[keep], j[keep]

    sizes = ends - starts
    small = sizes <= SMALL
    first = np.concatenate([np.arange(a, b) for a, b in zip(starts[small].tolist(), ends[small].tolist(), strict=True)] or [starts[:0]])
    last = np.repeat(ends[small], sizes[small])
    for step in range(1, int(sizes[small].max(initial=0))):
        inside = first + step < last
        first, last = first[inside], last[inside]
        for at in range(0, len(first), PAIRS):
            i = first[at : at + PAIRS]
            yield linked(i, i + step, np.einsum("ij,ij->i", unit[i], unit[i + step]))
    for a, b in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
        cosines = unit[a:b] @ unit[a:b].T
        i, j = np.nonzero(cosines >= similarity - 1e-9)
        above = i < j
        i, j = i[above], j[above]
        yield linked(a + i, a + j, cosines[i, j])


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least place reachable by pairs, of every place below n."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def _compare(n: int, similarity: float):
    """Rows come sorted by bucket and pair of tiles; a bucket's rows follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing: dict[int, Tables] = {}
        waiting: list[pa.RecordBatch] = []

        def results(rows: pa.Table, size: int) -> Iterator[tuple]:
            """(node, another of its links, links counted here) of the linked vectors among buckets of one length."""
            t = hashing.setdefault(size, Tables(size, n, similarity))
            place = np.stack([rows.column(c).to_numpy() for c in ("key", "one", "two")])
            starts = np.flatnonzero(np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(axis=0)]))
            ends = np.append(starts[1:], rows.num_rows)
            unit = units(matrix(rows.column("vector").combine_chunks()))
            nodes, copies, tiles, table = (rows.column(c).to_numpy() for c in ("node", "copies", "tile", "table"))
            for crossing in (False, True):
                some = (ends - starts > 1) & ((place[1] != place[2])[starts] == crossing)
                for i, j in _links(unit, starts[some], ends[some], tiles if crossing else None, similarity):
                    for at in range(0, len(i), PAIRS):
                        yield _counted(t, nodes, unit, copies, table, i[at : at + PAIRS], j[at : at + PAIRS])

        def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            sizes = rows.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = rows if (sizes == size).all() else rows.filter(pa.array(sizes == size))
                for columns in results(part, size):
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # the last bucket of a batch may go on in the next one
            place = np.stack([batch.column(k).to_numpy() for k in range(4)])
            before = np.flatnonzero((place != place[:, -1:]).any(axis=0))
            last = int(before[-1]) + 1 if len(before) else 0
            if last or (waiting and any(waiting[-1].column(k)[-1] != batch.column(k)[0] for k in range(4))):
                waiting.append(batch.slice(0, last))
                yield from emit(pa.Table.from_batches(waiting))
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield from emit(pa.Table.from_batches(waiting))

    return run


def _counted(t: Tables, nodes, unit, copies, table, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The linked vectors of some pairs: node, the root of those it reaches by these pairs, and links not met in an earlier table."""
    some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = place[: len(i)], place[len(i) :]
    keys = t.keys(unit[some])
    earlier = (keys[a] == keys[b]) & (np.arange(t.tables)[None] < table[i][:, None])
    fresh = ~earlier.any(axis=1)
    count = np.bincount(a, np.where(fresh, copies[j], 0), len(some)) + np.bincount(b, np.where(fresh, copies[i], 0), len(some))
    return nodes[some], nodes[some][_roots(len(some), a, b)], count.astype(np.int64)


def near_duplicates(
    embeddings: DataFrame, similarity: float, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    work = Workspace(embeddings.sparkSession)
    rows = embeddings.select(embeddings[id_col].alias("id"), embeddings[vector_col].alias("vector"))
    known = classes(work, rows, "classes")
    n = known.count()
    keyed = work.keep(
        known.select("node", "vector", "copies").mapInArrow(
            _keys(n, similarity),
            f"node long, vector {rows.schema[1].dataType.simpleString()}, copies long, keys array<long>",
        ),
        "keyed",
    )
    buckets = keyed.select(
        "node", "vector", "copies", F.size("vector").cast("long").alias("size"), F.posexplode("keys").alias("table", "key")
    )
    large = buckets.groupBy("key").count().where(F.col("count") > TILE)
    large = work.keep(large.select("key", F.ceil(F.col("count") / TILE).cast("long").alias("tiles")), "large")
    tiled = buckets.join(large, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("long")))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "key", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "size",
        "node", "vector", "copies", "tile", F.col("table").cast("long").alias("table"),
    )
    found = work.keep(
        tiled.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "size")
        .mapInArrow(_compare(n, similarity), "a long, b long, n long"),
        "found",
    )
    work.drop("keyed", "large")
    labels = connected_components(work, found.select("a", "b"), "components")
    links = found.groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "node")
    named = labels.join(known.select("node", "first_id"), "node")
    least = named.groupBy("label").agg(F.min("first_id").alias("least_id"))
    linked = named.join(least, "label").select("node", "least_id")
    result = work.keep(
        known.join(linked, "node", "left").join(links, "node", "left").select(
            "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least_id", "first_id").alias("component_id"),
        ),
        "result",
    )
    component = F.coalesce("component_id", "id")
    return rows.join(result, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"),
    )
