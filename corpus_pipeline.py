"""From raw documents to packed training sequences: five stages, each one operator of `shelfcast.llm`.

toxicity        documents scored as toxic go
line_dedup      later copies of repeated line runs are deleted; a document left without words by that goes
near_dups       one document of each group of near-duplicates stays (five words, similarity 0.8)
pii             personal data is masked by its kind
packing         what is left becomes pieces in sequences of 4,096 tokens

Every stage takes and returns the columns of documents, the last one returns pieces. `n_chars` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import line_dedup, ngram_join, packing, pii, toxicity
from shelfcast.llm.common import Workspace, table
from shelfcast.llm.queries import CAPACITY, LINE_RUN_WORDS, WORDS, fold

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in ("doc_id", "text"))


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`docs` with the length of its texts, where a column holds it."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(
        docs, table(spark, sf_dir, "labels"), fold(3, "doc_id"), keep=tuple(c for c in docs.columns if c != "doc_id")
    )
    return scored.where("predicted = 0").select("doc_id", "kept.*").select(*docs.columns)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.delete_later_copies(docs, LINE_RUN_WORDS, keep=_others(docs))
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = left.where(~F.coalesce(emptied, F.lit(False)))
    return _measured(left.select("doc_id", "text", *(["kept.*"] if _others(docs) else [])), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.mask(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(WORDS), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", delete_repeated_lines),
    ("near_dups", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: Learned scores and learned spans have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written and read again."""
    work = Workspace(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
