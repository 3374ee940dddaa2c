"""Best-fit packing of token sequences with large-item matching.

Lengths are whole numbers up to the capacity, so the number of pieces of each length (at most `capacity` numbers,
however many documents there are) decides the packing. The plan is made for whole classes of equal length:
pieces longer than a third of the capacity pair up, longest first, with the longest that still fits, so that a
sequence holds two of them at most; all shorter ones, longest first, go to the smallest gap that takes them, and to
new sequences when none does. A plan row places a range of ranks of one length class; pieces find their row by
their rank. Ranks need no window over a class: a task numbers its own pieces, and the counts by task and length
give where its numbers start.

Defined results: a null text is an empty one and gives one piece holding the end id alone. Repeated rows and null
ids are separate documents; ties go by task and order of reading. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.bpe import ids_of_texts
from shelfcast.llm.common import Workspace, slices, texts_of


class _Gaps:
    """Runs of equal sequences by the room they have left. A run: [sequences, [(length, copies), ...]]."""

    def __init__(self):
        self.runs: dict[int, list] = {}
        self.rooms: list[int] = []

    def add(self, room: int, count: int, items: list) -> None:
        if room not in self.runs:
            self.runs[room] = []
            bisect.insort(self.rooms, room)
        self.runs[room].append((count, items))

    def take(self, least: int):
        """A run with the smallest room of at least `least`, or None."""
        at = bisect.bisect_left(self.rooms, least)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        count, items = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.pop(at)
        return room, count, items


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, sequences, copies in each, first sequence, offset) that place every rank once."""
    left = {length: n for length, n in counts.items() if n}
    gaps = _Gaps()
    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        a = large[-1]
        partner = bisect.bisect_right(large, capacity - a) - 1
        if partner >= 0 and large[partner] == a and left[a] == 1:
            partner -= 1
        if partner < 0:
            gaps.add(capacity - a, left[a], [(a, 1)])
            left[a] = 0
        else:
            b = large[partner]
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            gaps.add(capacity - a - b, pairs, [(a, 2)] if a == b else [(a, 1), (b, 1)])
            left[a] -= pairs
            left[b] -= pairs
            if not left[b] and a != b:
                large.pop(partner)
        if not left[a]:
            large.pop()
    for s in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        n = left[s]
        while n:
            room, count, items = gaps.take(s) or (capacity, -(-n // (capacity // s)), [])
            each = room // s
            full = min(count, n // each)
            if full:
                gaps.add(room - each * s, full, [*items, (s, each)])
                n -= full * each
            if full < count:
                if n and n < each:
                    gaps.add(room - n * s, 1, [*items, (s, n)])
                    full, n = full + 1, 0
                if full < count:
                    gaps.add(room, count - full, items)
    rows, rank, sequence = [], dict.fromkeys(left, 0), 0
    for room in gaps.rooms:
        for count, items in gaps.runs[room]:
            offset = 0
            for length, copies in items:
                rows.append((length, rank[length], count, copies, sequence, offset))
                rank[length] += count * copies
                offset += length * copies
            sequence += count
    return sorted(rows)


def _pieces(path: str, end_id: int, capacity: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, raw in enumerate(ids_of_texts(path, texts_of(batch.column(1)))):
                raw += end
                for k in range(0, len(raw), 4 * capacity):
                    part = raw[k : k + 4 * capacity]
                    rows.append(row)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            sizes = np.array(length)
            order = np.argsort(sizes, kind="stable")
            ordered = sizes[order]
            rank = np.empty(len(sizes), np.int64)
            rank[order] = np.arange(len(sizes)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(sizes, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(rows), task), pa.int32()), pa.array(rank)],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    return run


def pack(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and `end_id`; only longer ones than `capacity` are cut, into pieces of that size.
    """
    work = Workspace(docs.sparkSession)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = (
        f"id {source.schema[0].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, "
        "task int, rank long"
    )
    pieces = work.keep(source.mapInArrow(_pieces(path, end_id, capacity), schema), "pieces")
    counts = work.keep(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    # at most `capacity` rows
    by_length = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    rows = np.array(plan(by_length, capacity), np.int64).reshape(-1, 6)
    places = docs.sparkSession.sparkContext.broadcast(rows)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, count, _, sequence, offset = places.value.T
        keys = length << 44 | first
        for batch in batches:
            size, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.searchsorted(keys, size << 44 | rank, side="right") - 1
            copy, which = np.divmod(rank - first[at], count[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence[at] + which), pa.array(offset[at] + copy * size)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(firsts, ["task", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank")
    )
    out = schema.replace("task int, rank long", "sequence_id long, offset long")
    return ranked.mapInArrow(place, out).withColumnRenamed("id", id_col)
