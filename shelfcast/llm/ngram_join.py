"""N-gram Jaccard join by group counts: blocks decide who may meet, a count-vector R-tree who is verified.

1. Every text becomes the set of its word shingles; texts with equal sets form one class, compared once.
2. Two sets of similarity s differ in at most |smaller| * (1 - s) / s shingles. Cut by their hash into one block
   more than that, two similar sets agree in a whole block. Sizes are cut into classes; a set emits the keys of its
   filled blocks for its own size class and for the smaller one whose members it may match. Where too few blocks
   are filled for the argument, the set also emits the keys of a further cut, and so on, and of every shingle after
   the last; no pair is lost.
   The first cut leaves out shingles that are common in a sample of the rows, such as those of passages that many
   documents share: two similar sets differ in no more of the others, so the argument holds for those alone.
3. Keys are sorted once. Sets that meet in a key of at most `MEET` sets are paired, and the keys that a pair shares are
   counted: similar sets agree in all filled blocks but as many as they have differing shingles, others, which met by
   a phrase that both happen to hold, in one or two. Pairs below that number are no link and go.
   Keys of more sets are only needed by sets that have too few other ones for the argument. These sets meet once more
   among themselves; in what is left of the crowded keys each set is paired with the first, not with all others.
   The components of the pairs are families, and every link lies within a family. So a family does not grow with
   the chance that two texts of a large corpus share a phrase.
4. A family's sets go into a count-vector R-tree (see `count_tree`), which bounds overlaps by summed coordinate
   minima; surviving pairs are verified on the sets. Families beyond `TILE` shingles are cut into tiles, and pairs of
   tiles are compared in separate tasks. Pairs already connected are skipped, and no pair leaves a task but the
   links of a spanning forest, whose components are the result.

An R-tree over all points would not be enough on its own: in as many dimensions as are needed here, boxes of
unrelated points overlap almost everywhere, so it serves inside families, where points lie close.

Defined results: a text without words (or null) has 0 shingles and is its own component. The component of rows
is the least non-null id among them; a row linked with nothing keeps its id, null included. Repeated rows and rows
that share an id are compared like others. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import line_dedup as bits
from shelfcast.llm.common import Workspace, slices, texts_of
from shelfcast.llm.components import connected_components
from shelfcast.llm.count_tree import links
from shelfcast.llm.shingles import mix, shingle_sets

#: Shingles of a tile, which is one side of what a task compares.
TILE = 1_000_000
#: Bytes of text whose words and shingles a task holds at once.
SLICE = 3 << 20
#: Size of the bitmap that keeps rows outside all families from being shuffled; when it fills up, more rows are.
BITS = 1 << 25
#: Shingles held by `COMMON_ROWS` or more of about `SAMPLE_ROWS` rows, a tenth of all at most, are left out of the first
#: cut; `COMMON` of them at most.
COMMON, COMMON_ROWS, SAMPLE_ROWS = 1 << 18, 4, 20_000
#: Cuts tried until one fills enough blocks.
SEEDS = 8
#: Sets of a key that are all paired, and how often the sets meet; a key gives (`MEET` - 1) / 2 pairs a set at most.
MEET, ROUNDS = 4, 2
#: The low bits of a key tell its size class, the next one whether it is of a further cut.
CLASS_BITS = 7
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


_NONE = np.zeros(0, np.uint64)


class Blocks:
    """Block keys of a set for the size classes in which it may find a partner."""

    def __init__(self, percent: int):
        self.percent = percent
        # below this size only equal sets are similar
        first = -(-percent // (100 - percent))
        self.bounds = [first]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, self.bounds[-1] * 3 // 2))
        self.cuts: dict[int, tuple[int, int]] = {}

    def cut(self, c: int) -> tuple[int, int]:
        """Most differing shingles in a class, and the number of blocks, of which a set most likely fills more."""
        if c not in self.cuts:
            least, differ = self.bounds[c], self.difference(self.bounds[c + 1] - 1)
            blocks = differ + 2
            while blocks < 4 * least:
                empty = (1 - 1 / blocks) ** least
                if blocks * (1 - empty) - 2 * (blocks * empty) ** 0.5 > differ:
                    break
                blocks += 1 + blocks // 16
            self.cuts[c] = differ, blocks
        return self.cuts[c]

    def difference(self, size: int) -> int:
        """Most shingles in which a set of at most `size` differs from a similar one at least as large."""
        return size * (100 - self.percent) // self.percent

    def classes(self, size: int) -> list[int]:
        """The class of a size, and below it that of the smallest partner."""
        own = bisect.bisect_right(self.bounds, size) - 1
        least = bisect.bisect_right(self.bounds, -(-size * self.percent // 100)) - 1
        return [c for c in range(max(least, 0), own + 1)]

    def most(self, size: int) -> list[int]:
        """For each class in which a set meets partners: most shingles in which it differs from a similar one.

        The smaller of the two decides the class.
        """
        own, *below = reversed(self.classes(size)) if size >= self.bounds[0] else [None]
        if own is None:
            return []
        rest = [(size + self.bounds[c + 1] - 1) * (100 - self.percent) // (100 + self.percent) for c in reversed(below)]
        return [*rest, self.difference(size)]

    def keys(self, hashes: np.ndarray, common: np.ndarray = _NONE) -> np.ndarray:
        """The first cut leaves out the shingles in `common` (sorted), which tell least; further ones take all."""
        marks = np.uint64((2 << CLASS_BITS) - 1)
        rare = hashes
        if len(common):
            rare = hashes[common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes]
        found = []
        for c in self.classes(len(hashes)):
            differ, blocks = self.cut(c)
            edges = (np.arange(1, blocks, dtype=np.float64) * (2.0**64 / blocks)).astype(np.uint64)
            for seed in range(SEEDS):
                h = rare if not seed else np.sort(mix(hashes + np.full(1, seed, np.uint64) * _K[0]))
                cuts = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h))])
                filled = np.flatnonzero(cuts[1:] > cuts[:-1])
                content = sums[cuts[filled + 1]] - sums[cuts[filled]]
                where = np.full(len(filled), c, np.uint64) * _K[1] + filled.astype(np.uint64) * _K[3]
                where += np.full(len(filled), seed, np.uint64) * _K[2]
                found.append(mix(content ^ mix(where)) & ~marks | np.uint64(c | (seed > 0) << CLASS_BITS))
                if len(filled) > differ:
                    break
            else:
                # every shingle a key of its own: whoever shares one is met
                found.append(mix(hashes ^ mix(np.full(1, c, np.uint64) * _K[2])) & ~marks | np.uint64(c | 1 << CLASS_BITS))
        return np.concatenate(found) if found else hashes[:0]


def _set_id(hashes: np.ndarray) -> bytes | None:
    return hashlib.md5(hashes.tobytes()).digest() if len(hashes) else None


def _common_shingles(source: DataFrame, width: int) -> np.ndarray:
    """Shingles that many rows of a sample hold: passages and boilerplate, in which a block tells little.

    They only decide how many unrelated sets meet, never the result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=0, limit=SLICE):
            hashes = np.concatenate([_NONE, *shingle_sets(texts_of(batch.column(0)), width)])
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["h"])

    rows = source.count()
    some = source.select("text").sample(min(0.1, SAMPLE_ROWS / max(rows, 1)), seed=13)
    counted = some.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= COMMON_ROWS)
    taken = counted.orderBy(F.desc("count"), "h").limit(COMMON).select("h").toArrow().column(0).to_numpy()
    return np.sort(taken.astype(np.int64).view(np.uint64))


def _features(width: int, percent: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(percent)
        for batch in slices(batches, limit=SLICE):
            sizes, ids, keys, low, filled, most = [], [], [], [], [], []
            for h in shingle_sets(texts_of(batch.column(1)), width):
                sizes.append(len(h))
                ids.append(_set_id(h))
                keys.append(blocks.keys(h, common.value))
                most.append(blocks.most(len(h)))
                low.append(blocks.classes(len(h))[0] if most[-1] else 0)
                first = keys[-1] & np.uint64((2 << CLASS_BITS) - 1)
                filled.append([int((first == low[-1] + k).sum()) for k in range(len(most[-1]))])
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            flat = np.concatenate(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(low, pa.int32()), *(pa.array(x, pa.list_(pa.int32())) for x in (filled, most)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["id", *batch.schema.names[2:], "n", "set_id", "low", "filled", "most", "keys"],
            )

    return run


def _meetings(meet: int):
    """Of rows (key, node) sorted by key the pairs (a, b) of the sets of keys of 2 to `meet`, and the rows (key, a) of larger ones."""

    def met(keys: np.ndarray, nodes: np.ndarray, crowded) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        lengths = np.diff(np.append(starts, len(keys)))
        many = lengths > meet
        if crowded is not None:
            many |= keys[starts] == crowded
        pairs = [
            (nodes[at + i], nodes[at + j])
            for n in range(2, meet + 1) for at in [starts[(lengths == n) & ~many]] for i, j in combinations(range(n), 2)
        ]
        one, two = (np.concatenate(x) for x in zip(*pairs, strict=True))
        rest = np.repeat(many, lengths)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(np.minimum(one, two)), pa.array(nodes[rest])]),
             pa.concat_arrays([pa.array(np.maximum(one, two)), pa.nulls(rest.sum(), pa.int64())]),
             pa.concat_arrays([pa.nulls(len(one), pa.int64()), pa.array(keys[rest])])],
            names=["a", "b", "key"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, crowded = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(1).to_numpy()])
            # the last key may go on in the next batch; of a crowded one only the key is remembered
            last = int(np.searchsorted(keys, keys[-1]))
            if len(keys) - last > meet or keys[-1] == crowded:
                yield met(keys, nodes, crowded)
                keys, nodes, crowded = keys[:0], nodes[:0], keys[-1]
            elif last:
                yield met(keys[:last], nodes[:last], crowded)
                keys, nodes = keys[last:], nodes[last:]
        if len(keys):
            yield met(keys, nodes, crowded)

    return run


def _candidates(work: Workspace, keyed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets whose components hold all links. `keyed` has node, n, low, filled, most and keys."""
    rows, found = keyed.select(F.explode("keys").alias("key"), "node"), []
    for k in range(ROUNDS):
        met = work.keep(
            rows.repartition("key").sortWithinPartitions("key").mapInArrow(_meetings(MEET), "a long, b long, key long"),
            f"met-{k}",
        )
        crowded = met.where("b is null").select("key", F.col("a").alias("node"))
        crowded = crowded.withColumn("class", F.col("key").bitwiseAND((1 << CLASS_BITS) - 1).cast("int"))
        lost = crowded.where(F.col("key").bitwiseAND(1 << CLASS_BITS) == 0).groupBy("node", "class").count()
        lost = lost.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("class", "count"))).alias("lost"))
        # filled blocks in keys that are not crowded
        left = F.transform("filled", lambda f, i: f - F.coalesce(F.try_element_at("lost", F.col("low") + i), F.lit(0)))
        known = work.keep(
            keyed.drop("keys").join(lost, "node", "left").select("node", "n", "low", "most", left.alias("left")), f"known-{k}"
        )
        one, two = (known.select(*(F.col(c).alias(f"{side}_{c}") for c in known.columns)) for side in "xy")
        pairs = met.where("b is not null").groupBy("a", "b").count()
        pairs = pairs.join(one, F.col("a") == F.col("x_node")).join(two, F.col("b") == F.col("y_node"))
        pairs = pairs.where((100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n")))
        of = F.least(*(F.col(f"{s}_low") + F.size(f"{s}_left") - 1 for s in "xy"))
        differ = F.floor((F.col("x_n") + F.col("y_n")) * (100 - percent) / F.lit(100 + percent))
        needed = F.greatest(*(F.get(f"{s}_left", of - F.col(f"{s}_low")) for s in "xy")) - differ
        found.append(work.keep(pairs.where(F.col("count") >= needed).select("a", "b"), f"pairs-{k}"))
        short = known.select("node", "low", F.posexplode(F.arrays_zip("left", "most"))).where("col.left <= col.most")
        short = short.select("node", (F.col("low") + F.col("pos")).alias("class"))
        rows = work.keep(crowded.join(short, ["node", "class"]).select("key", "node"), f"crowded-{k}")
        work.drop(f"met-{k}", f"known-{k}", *([f"crowded-{k - 1}"] if k else []))
    first = work.keep(
        rows.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").drop("z"), "first"
    )
    found.append(rows.join(first, "key").where("a <> node").select("a", F.col("node").alias("b")))
    pairs = work.keep(reduce(DataFrame.union, found).distinct(), "pairs")
    work.drop("first", f"crowded-{ROUNDS - 1}", *(f"pairs-{k}" for k in range(ROUNDS)))
    return pairs


def _member_bits(work: Workspace, ids: DataFrame) -> np.ndarray:
    """Bitmap of `BITS` bits with the hash of every id set: rows without their bit are no members."""
    places = ids.select(F.pmod(F.xxhash64("first_id"), F.lit(BITS)).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")
    )
    bitmap = np.zeros(BITS // 64, np.int64)
    for row in words.collect():
        bitmap[row["at"]] = row["bits"]
    return bitmap.view(np.uint64)


def _member_sets(width: int, bitmap):
    """Shingle sets, as bytes, of the rows whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            place = batch.column(2).to_numpy().astype(np.uint64)
            marked = bitmap.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
            some = batch.filter(pa.array(marked.astype(bool)))
            sets = list(shingle_sets(texts_of(some.column(1)), width))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(map(_set_id, sets), pa.binary()),
                 pa.array([h.tobytes() for h in sets], pa.binary())],
                names=["id", "set_id", "hashes"],
            )

    return run


def _compare(percent: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        nodes, tiles = group.column("node").to_numpy(), group.column("tile").to_numpy()
        nodes, first = np.unique(nodes, return_index=True)
        raw = group.column("hashes").take(pa.array(first)).to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in raw]
        sides = tiles[first] if key[1].as_py() != key[2].as_py() else None
        found = np.array(links(sets, percent, sides), np.int64).reshape(-1, 2)
        return pa.table({"a": nodes[found[:, 0]], "b": nodes[found[:, 1]]})

    return run


def jaccard_components(
    docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_shingles, component_id. Texts link when their similarity is `percent` / 100 or more."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return components_of(source, width, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one row of each component: the least id, null last, then the least hash of the text.

    Rows without words are linked with nothing and all stay.
    """
    digest = F.xxhash64(docs[text_col])
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), digest.alias("text_hash"))
    found = components_of(source, width, percent, "text_hash")
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(rank).alias("k"))
    alone = found.where("n_shingles = 0").select("id", "text_hash", F.lit(False).alias("once")).distinct()
    stay = first.select("k.id", "k.text_hash", F.lit(True).alias("once")).union(alone)
    stay = stay.select(
        F.col("id").alias("__llm_stay_id"), F.col("text_hash").alias("__llm_stay_hash"), F.col("once").alias("__llm_once")
    )
    joined = docs.withColumn("__llm_hash", digest).join(
        stay, docs[id_col].eqNullSafe(F.col("__llm_stay_id")) & (F.col("__llm_hash") == F.col("__llm_stay_hash"))
    )
    same = Window.partitionBy("__llm_stay_id", "__llm_stay_hash").orderBy("__llm_once")
    numbered = joined.withColumn("__llm_copy", F.row_number().over(same))
    return numbered.where("__llm_copy = 1 or not __llm_once").select(*docs.columns)


def components_of(source: DataFrame, width: int, percent: int, *keep: str) -> DataFrame:
    """Per row of `source` (id, text): id, the columns in `keep`, n_shingles, component_id, and `component`, a number
    that only rows of one component share (null without shingles)."""
    spark = source.sparkSession
    work = Workspace(spark)
    source = source.select("id", "text", *keep)
    rest = "".join(f", {f.name} {f.dataType.simpleString()}" for f in source.schema[2:])
    id_type = source.schema[0].dataType.simpleString()

    common = spark.sparkContext.broadcast(_common_shingles(source, width))
    features = work.keep(
        source.mapInArrow(
            _features(width, percent, common),
            f"id {id_type}{rest}, n long, set_id binary, low int, filled array<int>, most array<int>, keys array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "features",
    )
    classes = work.keep(
        features.where("n > 0").groupBy("set_id")
        .agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.min("row").alias("node")),
        "classes",
    )
    rows = work.keep(
        features.select("id", *keep, "n", "row", "set_id").join(classes.select("set_id", "node"), "set_id", "left").drop("set_id"),
        "rows",
    )
    # keys stay where they are, but those of rows that may be copies: one row of a class is wanted
    copies = rows.where("row <> node").select("row")
    place = F.pmod(F.xxhash64("row"), F.lit(bits.BITS))
    word = F.element_at(bits._bitmap(copies, place).scalar(), (F.shiftright(place, 6) + 1).cast("int"))
    marked = F.getbit(word, (place % 64).cast("int")) == 1
    sets = features.where(F.size("keys") > 0)
    keyed = sets.where(~marked).unionByName(sets.where(marked).join(copies, "row", "left_anti"))
    pairs = _candidates(work, keyed.select(F.col("row").alias("node"), "n", "low", "filled", "most", "keys"), percent)
    work.drop("features")
    families = connected_components(work, pairs, "families")
    members = families.join(classes, "node").select("node", F.col("label").alias("family"), "n", "first_id", "set_id")
    members = work.keep(members, "members")
    sizes = members.groupBy("family").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("tiles"))
    tiled = work.keep(
        members.join(sizes, "family").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .select("first_id", "set_id", "node", "family", "tile", "tiles"),
        "tiled",
    )
    bitmap = spark.sparkContext.broadcast(_member_bits(work, tiled))
    marked = source.select("id", "text").withColumn("place", F.pmod(F.xxhash64("id"), F.lit(BITS))).mapInArrow(
        _member_sets(width, bitmap), f"id {id_type}, set_id binary, hashes binary"
    )
    sets = marked.join(tiled, "set_id").where(F.col("id").eqNullSafe(F.col("first_id")))
    tasks = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "node", "family", "tile", "hashes",
        F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
    )
    found = work.keep(
        tasks.groupBy("family", "one", "two").applyInArrow(_compare(percent), "a long, b long"), "links"
    )
    work.drop("tiled", "members", "pairs")
    labels = connected_components(work, found, "components").join(classes.select("node", "first_id"), "node")
    least = labels.groupBy("label").agg(F.min("first_id").alias("least_id"))
    linked = labels.join(least, "label").select("node", "label", "least_id")
    alone = classes.select("node", "first_id").join(linked, "node", "left")
    components = work.keep(
        alone.select("node", F.coalesce("label", "node").alias("component"),
                     F.coalesce("least_id", "first_id").alias("component_id")),
        "labels",
    )
    return rows.drop("row").join(components, "node", "left").select(
        "id", *keep, F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), "component"
    )
