"""One query for each operator of this folder, over its whole table, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    ann, bpe, decontaminate, embedding_dups, hard_negatives, line_dedup, lm_scoring, ngram_join, packing, pii, token_counts, toxicity,
    whitening,
)
from shelfcast.llm.common import table

WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
CAPACITY = 4096
#: Least words of a repeated run of lines.
LINE_RUN_WORDS = 50


def fold(parts: int, id_col: str) -> Column:
    """Held out: rows whose CRC-32 of the id in text leaves 1. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == 1, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.delete_later_copies(table(spark, sf_dir, "documents"), min_words=LINE_RUN_WORDS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels, fold(3, "doc_id"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), CAPACITY)


def op4_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"), similarity=0.9)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows["vec_id"] % 100 == 0, k=10)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), fold(5, "doc_id"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), CAPACITY)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    # some rows move to the next of the ten labels first
    moved = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(rows.withColumn("label", moved), rows["vec_id"] % 50 == 0)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: `op1_line_dedup` from the definition: all stretches of lines, no ranks.
LINE_DEDUP_SQL = f"""
WITH all_lines AS (
    SELECT doc_id, UNNEST(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS line
    FROM documents WHERE text IS NOT NULL),
counted AS (SELECT *, len(regexp_extract_all(content, '[^\\x20\\x09-\\x0D]+')) AS words FROM all_lines),
filled AS (
    SELECT *, ROW_NUMBER() OVER w AS idx, SUM(words) OVER w AS upto FROM counted WHERE words > 0
    WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
stretches AS (
    SELECT a.doc_id, a.idx AS first, b.idx AS last FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.idx >= a.idx
    WHERE b.upto - a.upto + a.words >= {LINE_RUN_WORDS}),
parts AS (
    SELECT doc_id, first, MIN(last) AS last FROM stretches GROUP BY ALL
    UNION SELECT doc_id, MAX(first), last FROM stretches GROUP BY ALL),
spelled AS (
    SELECT doc_id, first, last, string_agg(content, chr(10) ORDER BY idx) AS content
    FROM parts JOIN filled USING (doc_id) WHERE idx BETWEEN first AND last GROUP BY ALL),
copies AS (
    SELECT * FROM spelled QUALIFY ROW_NUMBER() OVER (PARTITION BY content ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT doc_id, idx, line FROM copies JOIN filled USING (doc_id) WHERE idx BETWEEN first AND last),
gone_lines AS (
    SELECT doc_id, line FROM gone
    UNION SELECT c.doc_id, c.line FROM counted c JOIN gone a ON a.doc_id = c.doc_id AND a.line < c.line
    JOIN gone b ON b.doc_id = c.doc_id AND b.idx = a.idx + 1 AND b.line > c.line WHERE c.words = 0),
kept AS (
    SELECT doc_id, COUNT(*) AS n_lines, COUNT(g.line) AS n_deleted,
           COALESCE(string_agg(content, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '') AS text
    FROM all_lines l LEFT JOIN gone_lines g USING (doc_id, line) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN k.text END AS text, COALESCE(k.n_lines, 0) AS n_lines,
       COALESCE(k.n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id)"""


#: `op4_embedding_near_dups`: all pairs, and what is reachable by links.
NEAR_DUPS_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
    SELECT a.vec_id AS one, b.vec_id AS other FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_inner_product(a.x, b.x) >= 0.9 * sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))),
reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION SELECT r.vec_id, l.other FROM reached r JOIN links l ON l.one = r.other),
components AS (SELECT vec_id, MIN(other) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE one = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM components"""

#: `op11_hard_negatives`: every anchor against every row.
HARD_NEGATIVES_SQL = """
WITH taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM taken a JOIN taken b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT * FROM scored WHERE alike
    QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INT) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""

#: `op13_decontamination`: windows compared as text.
DECONTAMINATION_SQL = r"""
WITH texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
worded AS (
    SELECT kind, r, id, regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts),
item_windows AS (
    SELECT DISTINCT id AS item_id, least(len(words), 10) AS length,
           array_to_string(words[s : s + least(len(words), 10) - 1], ' ') AS content
    FROM (SELECT *, UNNEST(generate_series(1, greatest(len(words) - 9, 1))) AS s FROM worded WHERE kind = 'b' AND len(words) > 0)),
doc_windows AS (
    SELECT r, s, length, array_to_string(words[s : s + length - 1], ' ') AS content
    FROM (SELECT r, words, length, UNNEST(generate_series(1, len(words) - length + 1)) AS s
          FROM worded, (SELECT DISTINCT length FROM item_windows) WHERE kind = 'd' AND len(words) >= length)),
met AS (SELECT r, s, i.length, item_id FROM doc_windows d JOIN item_windows i ON i.length = d.length AND i.content = d.content),
hits AS (
    SELECT r, COUNT(DISTINCT place) AS n_hit FROM (SELECT r, UNNEST(generate_series(s, s + length - 1)) AS place FROM met) GROUP BY r),
listed AS (
    SELECT r, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT w.id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN hits USING (r) LEFT JOIN listed USING (r) WHERE kind = 'd'"""


def statements() -> dict[str, str]:
    """SQL where it expresses a query at the speed of a check; the others are tested against brute force."""
    return {"op1_line_dedup": LINE_DEDUP_SQL, "op4_embedding_near_dups": NEAR_DUPS_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL,
            "op13_decontamination": DECONTAMINATION_SQL}
