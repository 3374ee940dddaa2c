"""Hard negatives for contrastive training: near misses of another label, by exact integer inner products.

Components become whole numbers, floor(scale * x). Anchors and candidates are dealt into blocks and tiles of bounded
size; a task multiplies one block with one tile by Strassen's recursion (`strassen.product`) and keeps a bounded heap for
each anchor. Heaps of the tiles are merged by a ranked window, which Spark cuts to the wanted ranks before it
shuffles. Two passes:

1. positives: blocks meet the tiles of their own label only, and every anchor keeps its first rows of that label;
2. negatives: blocks meet all tiles, and every (anchor, positive) keeps its first rows of other labels whose score
   lies between `low` and `high` percent of the positive's.

Labels are cut into tiles by their number of rows, so that one label with a third of all rows is more tiles, not a
larger task. What is moved is anchors x tiles + rows x blocks, the least for stated queries against all rows; no pair
leaves a task but those on a heap.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part. Vectors of
different lengths are compared as if zeros followed the shorter one; an empty vector scores 0. Equal scores are
ordered by the smaller id, null ids last, then by row. A repeated row is another row, also of an anchor of the same id; each
repeated anchor has rows of its own. Vectors so long that scores might not fit a long (2^27 or more after
scaling) take no part. An anchor without positives, or a positive without negatives in its window, gives no row. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace
from shelfcast.llm.strassen import product
from shelfcast.llm.vectors import finite, padded, whole_steps

#: Most rows of a block of anchors and of a tile of candidates, about, and least of a tile.
BLOCK, TILE, LEAST_TILE = 512, 8192, 256
#: Candidates multiplied at once inside a task.
STRIP = 2048
#: Products of two vectors shorter than this, times 100, fit a long.
LONGEST = 2.0**27


def _matrices(anchors: pa.Table, candidates: pa.Table, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number matrices of both sides, with as many columns."""
    sides = [t.column("vector").combine_chunks() for t in (anchors, candidates)]
    size = max(int(np.diff(v.offsets.to_numpy()).max(initial=0)) for v in sides)
    return tuple(whole_steps(padded(v, size), scale) for v in sides)


def _in_order(rows: pa.Table) -> pa.Table:
    """Candidates by id, null ids last, then by row: among equal scores the first one counts."""
    return rows.sort_by([("id", "ascending"), ("row", "ascending")])


def _first(heap: np.ndarray, place: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Indices of the `count` first entries of each heap: highest score, then least place."""
    order = np.lexsort((place, -score, heap))
    ordered = heap[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < count]


def _merged(found: list[tuple], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    heap, place, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    kept = _first(heap, place, score, count)
    return heap[kept], place[kept], score[kept]


def _positives(count: int, scale: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = _in_order(candidates)
        a, c = _matrices(anchors, candidates, scale)
        own, rows = anchors.column("row").to_numpy(), candidates.column("row").to_numpy()
        found = []
        for start in range(0, len(c), STRIP):
            s = product(a, c[start : start + STRIP])
            other = own[:, None] != rows[None, start : start + STRIP]
            if s.shape[1] > count + 1:
                # one place more than wanted: the anchor itself may hold one
                other &= s >= np.partition(s, -count - 1, axis=1)[:, -count - 1, None]
            i, j = np.nonzero(other)
            kept = _first(i, j, s[i, j], count)
            found.append((i[kept], start + j[kept], s[i[kept], j[kept]]))
        i, j, s = _merged(found, count)
        return pa.table({
            "anchor_row": own[i], "row": rows[j], "id": candidates.column("id").take(pa.array(j)), "score": s,
        })

    return run


def _negatives(count: int, scale: int, low: int, high: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = _in_order(candidates)
        a, c = _matrices(anchors, candidates, scale)
        labels = pa.chunked_array([*anchors.column("label").chunks, *candidates.column("label").chunks])
        codes = labels.combine_chunks().dictionary_encode().indices.to_numpy()
        mine, theirs = codes[: len(a)], codes[len(a) :]
        rows = candidates.column("row").to_numpy()
        # a heap for each (anchor, positive): the anchor's place in the block, and the positive's rank and score
        scores = anchors.column("scores").combine_chunks()
        lengths = np.diff(scores.offsets.to_numpy())
        line = np.repeat(np.arange(len(a)), lengths)
        rank = np.concatenate([np.arange(1, n + 1) for n in lengths.tolist()])
        wanted = scores.flatten().to_numpy()
        found = []
        for start in range(0, len(c), STRIP):
            s = product(a, c[start : start + STRIP])
            different = mine[:, None] != theirs[None, start : start + STRIP]
            for r in range(1, int(lengths.max()) + 1):
                here = np.flatnonzero(rank == r)
                score, positive = s[line[here]], wanted[here][:, None]
                inside = different[line[here]] & (low * positive <= 100 * score) & (100 * score <= high * positive)
                i, j = np.nonzero(inside)
                kept = _first(i, j, score[i, j], count)
                found.append((here[i[kept]], start + j[kept], score[i[kept], j[kept]]))
        heap, j, s = _merged(found, count)
        return pa.table({
            "anchor_row": anchors.column("row").to_numpy()[line[heap]], "positive_rank": rank[heap], "row": rows[j],
            "id": candidates.column("id").take(pa.array(j)), "score": s,
        })

    return run


def _numbered(count: Column, size: int, tasks: int = 1) -> Column:
    """Parts of about `size` rows at most; as many as there are tasks where that leaves `LEAST_TILE` rows or more."""
    wanted = F.greatest(F.ceil(count / size), F.least(F.lit(tasks), F.floor(count / LEAST_TILE)))
    return F.greatest(wanted.cast("long"), F.lit(1).cast("long"))


def _part(salt: int, parts: Column) -> Column:
    return F.pmod(F.xxhash64("row", F.lit(salt)), parts)


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def _ranked(heaps: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The heaps of all tiles as one for each key."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score lies between `low` and `high` percent of its positive's.
    """
    spark = rows.sparkSession
    work = Workspace(spark)
    taken = rows.select(
        rows[id_col].cast("long").alias("id"), rows[vector_col].alias("vector"), rows[label_col].alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("label").isNotNull() & finite(F.col("vector")))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    taken = taken.where(F.sqrt(squares) * scale < LONGEST)
    taken = work.keep(taken.withColumn("row", F.monotonically_increasing_id()), "rows")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    # a label's tiles and blocks follow from its number of rows
    sizes = taken.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"))
    sizes = work.keep(sizes.where("anchors > 0").select(
        "label", _numbered(F.col("n"), TILE, tasks).alias("tiles"), _numbered(F.col("anchors"), BLOCK).alias("blocks")
    ), "sizes")
    placed = taken.join(sizes, "label")
    columns = ["id", "row", "vector"]
    lines = placed.where("anchor").select(
        "label", _part(1, F.col("blocks")).alias("block"), _each(F.col("tiles")).alias("tile"), *columns
    )
    lines = lines.select(*[F.col(c).alias(c) for c in lines.columns])
    against = placed.select("label", _each(F.col("blocks")).alias("block"), _part(2, F.col("tiles")).alias("tile"), *columns)
    keys = ["label", "block", "tile"]
    heaps = lines.groupBy(*keys).cogroup(against.groupBy(*keys)).applyInArrow(
        _positives(positives, scale), "anchor_row long, row long, id long, score long"
    )
    first = work.keep(_ranked(heaps, ["anchor_row"], positives), "positives")

    # the wanted windows travel with the anchors: a heap of positives is bounded
    own = first.groupBy(F.col("anchor_row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("heap")
    )
    asked = taken.where("anchor").join(own, "row").select("row", "vector", "label", F.col("heap.score").alias("scores"))
    counts = taken.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"))
    grid = counts.select(
        _numbered(F.col("n"), TILE, tasks).alias("tiles"), _numbered(F.col("anchors"), BLOCK).alias("blocks")
    ).first()
    tiles, blocks = (F.lit(grid[c]).cast("long") for c in ("tiles", "blocks"))
    lines = asked.withColumns({"block": _part(1, blocks), "tile": _each(tiles)})
    lines = lines.select(*[F.col(c).alias(c) for c in lines.columns])
    against = taken.select("id", "row", "vector", "label", _part(2, tiles).alias("tile"), _each(blocks).alias("block"))
    keys = ["block", "tile"]
    heaps = lines.groupBy(*keys).cogroup(against.groupBy(*keys)).applyInArrow(
        _negatives(negatives, scale, low, high),
        "anchor_row long, positive_rank long, row long, id long, score long",
    )
    chosen = _ranked(heaps, ["anchor_row", "positive_rank"], negatives)
    chosen = chosen.select("anchor_row", "positive_rank", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = first.join(taken.where("anchor").select(F.col("id").alias("anchor_id"), F.col("row").alias("anchor_row")), "anchor_row")
    named = named.select(
        "anchor_row", "anchor_id", F.col("rank").cast("long").alias("positive_rank"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return named.join(chosen, ["anchor_row", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
