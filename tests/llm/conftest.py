"""Tables that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PARAGRAPH = " ".join(f"alpha{i} beta{i % 7} gamma{i % 11}" for i in range(30))
#: Names that operators use inside.
CLASHING = (
    "id", "n", "node", "label", "row", "spans", "score", "kept", "predicted", "held_out", "text_hash", "n_tokens", "rank",
    "component_id", "piece", "length", "word", "c", "toxic", "component", "keys", "_copy",
)


def edge_rows() -> list[tuple]:
    long_text = "\n".join(f"line {i} of a very long text with number {i * 7919}" for i in range(6000))
    return [
        (1, "One short text. Mail jo.doe@mail.example.com now", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t \n", "en", None, 5),
        (None, "a text without an id", "en", "a", 1),
        (5, PARAGRAPH, "en", "a", 1),
        (6, PARAGRAPH, "en", "a", 1),
        (6, PARAGRAPH, "en", "a", 1),
        (6, "another text under the same id " + PARAGRAPH, "de", "b", 1),
        (7, "x" * 50_000, "en", "a", 1),
        (8, long_text, "fr", "a", 1),
        (9, "Ünïcödé — ВЕЛИКИЙ Σ 日本語 😀 don't STOP", "fr", "a", 1),
        (None, None, None, None, None),
        (-10, PARAGRAPH.replace("alpha3 ", "alpha4 "), "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    from pyspark.sql import functions as F

    return edge_docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (5, 1, 1), (None, 0, 1), (9, 0, None), (9, 0, 0), (9, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
