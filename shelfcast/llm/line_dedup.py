"""Line dedup: a suffix array over line ids by prefix doubling, and the repeated runs of lines it shows.

The corpus is one sequence of lines, cut at document ends; blank lines are left out of it. Round k sorts all suffixes
by their first 2^k lines: a suffix's rank is that of its pair of ranks from the round before, its own and the one
2^(k-1) lines on. Equal ranks are an interval of the suffix array whose longest common prefix has 2^k lines or more.
Suffixes alone with their rank are in their final place and drop out, so that only repeated text goes on.

A repeated run is a stretch of lines that occurs earlier and holds `min_words` words or more; its later copies are
deleted. Every run is the union of its shortest parts of `min_words` words, one beginning and one ending at each of
its lines, and such a part of m lines lies in the interval named by the ranks of its first and its last 2^k lines,
2^k <= m < 2^(k+1). So a line is deleted if and only if a part that contains it has an earlier equal, and the rounds
end at 2^k <= `min_words`, however long the runs are.

Earlier means: smaller id, null ids first; for equal ids the smaller hash of the text; then the line number. A copy
may overlap the run it copies. Defined results: a null text stays null and has no lines; an empty text is one blank
line. Rows equal in id and text are one document listed several times, and are all treated alike. Blank lines between
two deleted lines go with them, others stay. An empty table gives an empty result. Further columns are ignored.

All steps are DataFrame operations. Lines meet by hash in aggregates with map-side combine and in joins, which Spark
splits when skewed; windows run by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace

DOC = ["id", "text_hash"]
#: Size of the bitmap that tells documents with runs from most others; its size bounds what one task collects.
BITS = 1 << 24


def _lines(source: DataFrame, min_words: int) -> DataFrame:
    """Non-blank lines with their number `idx`, and the shortest parts of `min_words` words from and to each."""
    lines = source.select(*DOC, F.posexplode(F.split("text", "\n")).alias("line", "content"))
    lines = lines.withColumn("words", F.regexp_count("content", F.lit(r"[^\x20\x09-\x0D]+"))).where("words > 0")
    # two hashes with different seeds are the line's id
    lines = lines.select(
        *DOC, "line", "words", F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(1), "content").alias("h2")
    )
    by_line = Window.partitionBy(*DOC).orderBy("line")
    lines = lines.dropDuplicates([*DOC, "line"]).withColumn("idx", F.row_number().over(by_line)).withColumn(
        "upto", F.sum("words").over(by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("before", F.col("upto") - F.col("words"))
    ahead = Window.partitionBy(*DOC).orderBy("before").rangeBetween(Window.currentRow, min_words - 1)
    back = Window.partitionBy(*DOC).orderBy("upto").rangeBetween(-(min_words - 1), Window.currentRow)
    return lines.select(
        *DOC, "idx", "line", "h1", "h2",
        F.when(F.max("upto").over(ahead) - F.col("before") >= min_words, F.struct(
            F.col("idx").alias("first"), F.max("idx").over(ahead).alias("last"),
            F.col("line").alias("first_line"), F.max("line").over(ahead).alias("last_line"),
        )).alias("from_here"),
        F.when(F.col("upto") - F.min("before").over(back) >= min_words, F.struct(
            F.min("idx").over(back).alias("first"), F.col("idx").alias("last"),
            F.min("line").over(back).alias("first_line"), F.col("line").alias("last_line"),
        )).alias("to_here"),
    )


def _ranked(work: Workspace, suffixes: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(document, idx, rank) of the suffixes that share `keys` with others; ranks rise with the keys."""
    shared = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # row numbers by sorted range: larger from one partition to the next, and inside each
    ranks = work.keep(shared.select(*keys).orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), f"{name}-ranks")
    kept = work.keep(suffixes.join(ranks, keys).select(*DOC, "idx", "rank"), name)
    work.drop(f"{name}-ranks")
    return kept


def _later(parts: DataFrame, ranks: DataFrame, size: int) -> DataFrame:
    """Parts of `size` to 2 * `size` - 1 lines that have an earlier equal."""
    length = F.col("last") - F.col("first") + 1
    wanted = parts.where((length >= size) & (length < 2 * size))
    start = ranks.select(*(F.col(c).alias(f"s_{c}") for c in [*DOC, "idx"]), F.col("rank").alias("head"))
    end = ranks.select(*(F.col(c).alias(f"e_{c}") for c in [*DOC, "idx"]), F.col("rank").alias("tail"))

    def same(prefix: str, place):
        return (
            F.col("id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("text_hash") == F.col(f"{prefix}_text_hash"))
            & (place == F.col(f"{prefix}_idx"))
        )

    named = wanted.join(start, same("s", F.col("first"))).join(end, same("e", F.col("last") - size + 1))
    named = named.select(
        F.struct("id", "text_hash", "first").alias("place"), "last", "first_line", "last_line", "head", "tail",
        length.alias("length"),
    )
    interval = ["length", "head", "tail"]
    first = named.groupBy(*interval).agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    first = first.where("earliest < latest").drop("latest")
    return named.join(first, interval).where("place > earliest").select("place.*", "last", "first_line", "last_line")


def repeated_runs(work: Workspace, source: DataFrame, min_words: int) -> DataFrame:
    """(id, text_hash, runs): line ranges to delete, as an array of (start, stop), stop included, in order.

    `source` has columns id, text and text_hash.
    """
    lines = work.keep(_lines(source, min_words), "lines")
    parts = lines.select(*DOC, F.inline(F.array("from_here", "to_here"))).where("first is not null").distinct()
    ranks = _ranked(work, lines.select(*DOC, "idx", "h1", "h2"), ["h1", "h2"], "round-1")
    # a part all of whose lines are repeated begins with a repeated line
    parts = work.keep(
        parts.join(
            ranks.select(F.col("id").alias("s_id"), F.col("text_hash").alias("s_hash"), F.col("idx").alias("s_idx")),
            F.col("id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash"))
            & (F.col("first") == F.col("s_idx")),
            "left_semi",
        ),
        "parts",
    )
    found, size = [], 1
    while True:
        found.append(work.keep(_later(parts, ranks, size), f"later-{size}"))
        if 2 * size > min_words:
            break
        ahead = Window.partitionBy(*DOC).orderBy("idx").rangeBetween(size, size)
        pairs = ranks.withColumn("next", F.first("rank").over(ahead)).where("next is not null")
        following = _ranked(work, pairs.withColumnRenamed("rank", "own"), ["own", "next"], f"round-{2 * size}")
        work.drop(f"round-{size}")
        ranks, size = following, 2 * size
        if ranks.isEmpty():
            break
    later = reduce(DataFrame.union, found).distinct()
    in_order = Window.partitionBy(*DOC).orderBy("first", "last")
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    # parts that touch, blank lines aside, are one run
    runs = later.withColumn("new", F.coalesce((F.col("first") > reached + 1).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*DOC, "run").agg(F.min("first_line").alias("start"), F.max("last_line").alias("stop"))
    runs = work.keep(runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs")), "runs")
    work.drop("lines", "parts", f"round-{size}", *(f"later-{2 ** k}" for k in range(len(found))))
    return runs


def _bitmap(keys: DataFrame, place: Column) -> DataFrame:
    """One row with an array of `BITS` / 64 numbers, in which the bit at the place of every key is set."""
    words = keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")
    )
    every = keys.sparkSession.range(BITS // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    filled = words.unionByName(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "bits")))
    return filled.agg(F.transform(in_order, lambda w: w["bits"]).alias("words"))


def delete_later_copies(
    docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: id, the columns of `docs` named in `keep` as a struct `kept`, the remaining text, n_lines and n_deleted
    (of the lines, blank included)."""
    work = Workspace(docs.sparkSession)
    source = docs.select(
        docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"),
        *([F.struct(*(docs[c] for c in keep)).alias("kept")] if keep else []),
    )
    runs = repeated_runs(work, source.select("id", "text", "text_hash"), min_words)
    # documents without runs, most of them, stay where they are; only the others are shuffled to their runs
    place = F.pmod(F.xxhash64("id", "text_hash"), F.lit(BITS))
    word = F.element_at(_bitmap(runs, place).scalar(), (F.shiftright(place, 6) + 1).cast("int"))
    marked = F.coalesce(F.getbit(word, (place % 64).cast("int")) == 1, F.lit(False))
    keyed = runs.select(F.col("id").alias("r_id"), F.col("text_hash").alias("r_hash"), "runs")
    found = source.where(marked).join(
        keyed, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left"
    ).drop("r_id", "r_hash")
    joined = found.unionByName(source.where(~marked).withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType)))
    lines = F.split("text", "\n")
    stay = F.filter(lines, lambda _, i: ~F.exists("runs", lambda r: (i >= r["start"]) & (i <= r["stop"])))
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    deleted = F.aggregate("runs", F.lit(0), lambda n, r: n + r["stop"] - r["start"] + 1)
    return joined.select(
        F.col("id").alias(id_col), *(["kept"] if keep else []), text.alias(text_col),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("runs").isNull(), 0).otherwise(deleted).cast("long").alias("n_deleted"),
    )
