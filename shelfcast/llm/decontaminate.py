"""Benchmark decontamination by winnowing.

Every text is its words. Of each window of `width` consecutive words the least hash of its k-word grams is kept as a
fingerprint; neighbouring windows mostly keep the same one, so that there are few. A window of a document that equals one
of an item keeps the same fingerprint: with k grams of half a window, no shared span of `width` words is missed.

One read of the documents looks every fingerprint up in a bitmap of the items' fingerprints (of bounded size, whatever
the items; it only spares rows, the join decides) and extends those found to their windows, each named by the
grams at its two ends, which cover it. Windows are then joined on (fingerprint, window) with the distinct windows of the
items, so a pair that does not extend is never made. Windows that occur in the same items are one class: a document
meets a passage's items once, not once a window, and no pair of windows is emitted.

An item of fewer words than `width`, but not none, is one window of its own length. Lengths that occur among the items,
`width` at most, are fingerprinted alike. Texts are split and hashed as arrays of bytes.

Defined results: a null text has no words. Items of one id count as one item; an item without an id marks words and is
not counted. Repeated rows and ids of documents give a row each. No items, or only items without words: no document is hit.
An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace, slices, texts_of
from shelfcast.llm.shingles import mix

#: Text handled at once inside a task.
SLICE = 2 << 20
#: Bits for each fingerprint of the items, and the limits of the bitmap's size.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 1 << 16, 1 << 27
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = 0xD6E8FEB86659FD93

#: Word bytes: digits, letters and all of characters beyond ASCII; capitals count as small letters.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _A)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]


class Words:
    """Hashes of words: polynomials of their bytes modulo 2^64, scattered."""

    def __init__(self):
        self.powers = np.ones(1, np.uint64)

    def _upto(self, length: int) -> np.ndarray:
        if length > len(self.powers):
            base = np.full(max(length, 64), _BASE, np.uint64)
            base[0] = 1
            self.powers = np.cumprod(base)
        return self.powers

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row offsets and hashes of the words of each text."""
        ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        none = np.zeros(len(texts) + 1, np.int64)
        if ends[-1] == ends[0]:
            return none, np.zeros(0, np.uint64)
        data = np.frombuffer(texts.buffers()[2], np.uint8, ends[-1] - ends[0], ends[0])
        ends -= ends[0]
        inside = _WORD[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        # a word does not go on in the next text
        bounds = ends[:-1][ends[:-1] < len(data)]
        first[bounds] = inside[bounds]
        starts = np.flatnonzero(first)
        if not len(starts):
            return none, np.zeros(0, np.uint64)
        at = np.flatnonzero(inside)
        begin = np.searchsorted(at, starts)
        lengths = np.diff(np.append(begin, len(at)))
        place = np.arange(len(at)) - np.repeat(begin, lengths)
        terms = _VALUE[data[at]] * self._upto(int(lengths.max()))[place]
        return np.searchsorted(starts, ends), mix(np.add.reduceat(terms, begin) + lengths.astype(np.uint64) * _B)


def windows(offsets: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each stretch of `width` words: whether it lies in one row, its least gram, and its own hash."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    k = (width + 1) // 2
    grams = np.full(len(words) - k + 1, width, np.uint64)
    for j in range(k):
        grams = mix(grams * _A + words[j : j + len(grams)] + _B)
    least = grams[:n].copy()
    for j in range(1, width - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    within = np.arange(width, width + n) <= np.repeat(offsets[1:], np.diff(offsets))[:n]
    return within, least, mix(grams[:n] * _C + grams[width - k : width - k + n])


def _row_of(offsets: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, place, side="right") - 1


def _item_windows(width: int):
    """(item_id, length, print, window) of every window of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Words()
        for batch in slices(batches, limit=SLICE):
            offsets, words = hashing.of(texts_of(batch.column(1)))
            counts = np.diff(offsets)
            for length in np.unique(np.minimum(counts[counts > 0], width)).tolist():
                within, least, whole = windows(offsets, words, length)
                at = np.flatnonzero(within)
                row = _row_of(offsets, at)
                fits = (counts[row] == length) | (length == width)
                at, row = at[fits], row[fits]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(np.full(len(at), length, np.int32)),
                     pa.array(least[at].view(np.int64)), pa.array(whole[at].view(np.int64))],
                    names=["item_id", "length", "print", "window"],
                )

    return run


def _marked_windows(lengths: list[int], bits):
    """Every document with its number of words and the windows around fingerprints in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Words()
        shift = np.uint64(64 - (len(bits.value) * 64).bit_length() + 1)

        def known(prints: np.ndarray) -> np.ndarray:
            place = prints >> shift
            return (bits.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)

        for batch in slices(batches, limit=SLICE):
            offsets, words = hashing.of(texts_of(batch.column(1)))
            found = []
            for length in lengths:
                within, least, whole = windows(offsets, words, length)
                # winnowing: a fingerprint stands for the windows next to each other that keep it
                changed = np.ones(len(least), bool)
                changed[1:] = least[1:] != least[:-1]
                kept = np.flatnonzero(changed)
                held = np.repeat(known(least[kept]), np.diff(np.append(kept, len(least))))
                at = np.flatnonzero(held & within)
                row = _row_of(offsets, at)
                found.append((row, at - offsets[row], np.full(len(at), length), least[at], whole[at]))
            row, start, length, prints, whole = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (
                np.zeros(0, np.int64),) * 5
            order = np.argsort(row, kind="stable")
            each = pa.StructArray.from_arrays(
                [pa.array(start[order], pa.int32()), pa.array(length[order], pa.int32()),
                 pa.array(prints[order].view(np.int64)), pa.array(whole[order].view(np.int64))],
                names=["start", "length", "print", "window"],
            )
            ends = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)],
                names=["doc_id", "n_words", "marked"],
            )

    return run


def _bitmap(prints: DataFrame) -> np.ndarray:
    """The leading bits of every fingerprint; at most `MOST_BITS` bits whatever their number."""
    n = prints.count()
    size = LEAST_BITS
    while size < min(MOST_BITS, n * BITS_EACH):
        size *= 2
    places = prints.select(F.shiftrightunsigned("print", 65 - size.bit_length()).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")
    )
    taken = words.toArrow()
    bitmap = np.zeros(size // 64, np.int64)
    bitmap[taken.column("at").to_numpy()] = taken.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def find(
    docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    work = Workspace(spark)
    named = items.select(items[item_col].alias("item_id"), items[item_text_col].alias("text"))
    key = ["print", "window"]
    of_items = work.keep(
        named.mapInArrow(
            _item_windows(width),
            f"item_id {named.schema[0].dataType.simpleString()}, length int, print long, window long",
        ).distinct(),
        "items",
    )
    lengths = sorted(r["length"] for r in of_items.select("length").distinct().collect())
    bits = spark.sparkContext.broadcast(_bitmap(of_items.select("print").distinct()))

    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    marked = "marked array<struct<start: int, length: int, print: long, window: long>>"
    seen = texts.mapInArrow(
        _marked_windows(lengths, bits), f"doc_id {texts.schema[0].dataType.simpleString()}, n_words long, {marked}"
    )
    seen = work.keep(seen.withColumn("row", F.monotonically_increasing_id()), "documents")

    # windows of the same items are one class, named by what does not depend on their order
    hashes = [F.xxhash64("item_id", F.lit(salt)) for salt in (1, 2)]
    classes = ["items", "sum", "xor"]
    known = work.keep(
        of_items.groupBy(*key).agg(
            F.count(F.lit(1)).alias("items"), F.sum(hashes[0].cast("decimal(20,0)")).cast("string").alias("sum"),
            F.bit_xor(hashes[1]).alias("xor"),
        ),
        "windows",
    )
    one_of_each = known.groupBy(*classes).agg(F.min(F.struct(*key)).alias("w")).select(*classes, "w.*")
    members = one_of_each.join(of_items.where("item_id IS NOT NULL"), key).select(*classes, "item_id")

    touched = seen.where(F.size("marked") > 0)
    met = work.keep(touched.select("row", F.inline("marked")).join(known, key), "met")
    # words of a window beyond the furthest end of the windows before it
    before = F.max(F.col("start") + F.col("length"))
    earlier = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("start") + F.col("length") - F.greatest("start", F.coalesce(before.over(earlier), F.lit(0)))
    hits = met.select("row", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    listed = met.select("row", *classes).distinct().join(members, classes).select(
        "row", F.col("item_id").cast("string").alias("item_id")
    ).distinct().groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))

    def result(df: DataFrame, n_hit: Column, ids: Column) -> DataFrame:
        return df.select(
            F.col("doc_id").alias(id_col), "n_words", n_hit.cast("long").alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )

    nothing = F.array().cast("array<string>")
    found = touched.drop("marked").join(hits, "row", "left").join(listed, "row", "left")
    return result(found, F.coalesce("n_hit", F.lit(0)), F.coalesce("ids", nothing)).unionByName(
        result(seen.where(F.size("marked") == 0), F.lit(0), nothing)
    )
