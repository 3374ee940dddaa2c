"""Token counts by a two-tier lookup, with no shuffle of pre-tokens.

A SentencePiece BPE model whose pieces hold the space mark only at their start never merges across a space, so
the count of a text is the sum over its pre-tokens: each word with the spaces before it. Tier one is a compact
hash table, broadcast to all tasks: the pre-tokens seen most often in a sample, with their token counts (at most
`FREQUENT` strings of at most `LONGEST` bytes). Tier two is a cache in each Python worker, bounded by `CACHED`
entries; what it misses is encoded by the library. Which pre-tokens the table holds affects speed only.

Defined results: a null text is an empty one, with 0 bytes and 0 tokens. Rows are independent: repeated rows, null
ids and further columns (ignored) change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import encode_dictionary, slices, sums_by_row, texts_of

FREQUENT, LONGEST, SAMPLE_ROWS, CACHED = 32_768, 48, 4_096, 600_000
SPACED = re.compile(" +[^ ]*")


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = [model.id_to_piece(i) for i in range(model.get_piece_size()) if "▁" in model.id_to_piece(i).lstrip("▁")]
    if inner:
        raise ValueError(f"pieces of {path} span words, for instance {inner[0]!r}")
    return model


@lru_cache(maxsize=4)
def worker_cache(path: str) -> dict[str, int]:
    return {"": 1}


def counts_of(path: str, tokens: list[str]) -> list[int]:
    """Tokens of each pre-token, given without its first space; nothing left over counts as the lone mark."""
    cache = worker_cache(path)
    if len(cache) + len(tokens) > CACHED:
        cache.clear()
        cache[""] = 1
    missing = [t for t in tokens if t not in cache]
    if missing:
        cache.update(zip(missing, map(len, processor(path).encode(missing, num_threads=1)), strict=True))
    return [cache[t] for t in tokens]


def frequent_tokens(texts: DataFrame) -> list[str]:
    """The most frequent pre-tokens of about `SAMPLE_ROWS` rows taken over the whole table."""
    total = texts.count()
    if not total:
        return []
    words = texts.sample(min(1.0, SAMPLE_ROWS / total), seed=7).select(F.explode(F.split("text", " ")).alias("w"))
    top = words.filter(F.octet_length("w").between(1, LONGEST)).groupBy("w").count()
    return [r[0] for r in top.orderBy(F.desc("count"), "w").limit(FREQUENT).collect()]


def pre_tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row offsets and flat pre-tokens, each without its first space."""
    texts = pc.replace_substring(texts, "▁", " ")
    runs = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
    lists = pc.split_pattern(texts, " ")
    if pc.any(runs).as_py():
        # runs of spaces belong to the word after them
        values = [
            [w[1:] for w in SPACED.findall(" " + t)] if run else None
            for t, run in zip(texts.to_pylist(), runs.to_pylist(), strict=True)
        ]
        lists = pc.if_else(runs, pa.array(values, lists.type), lists)
    return lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_bytes, n_tokens, and over_limit (more than `limit` tokens)."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    spark = docs.sparkSession
    tokens = frequent_tokens(source.select("text"))
    lengths = [len(x) for x in processor(path).encode(tokens, num_threads=1)]
    table = spark.sparkContext.broadcast((tokens, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(table.value[0], pa.string())
        known_length = np.array([*table.value[1], 0], np.int64)
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            offsets, flat = pre_tokens(texts)
            at = pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy(zero_copy_only=False)
            counts = known_length[at]
            missed = np.flatnonzero(at == len(known))
            if len(missed):
                index, distinct = encode_dictionary(flat.take(pa.array(missed)))
                counts[missed] = np.array(counts_of(path, distinct.to_pylist()), np.int64)[index]
            n = np.where(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0, sums_by_row(offsets, counts), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()),
                 pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = (
        f"id {source.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
