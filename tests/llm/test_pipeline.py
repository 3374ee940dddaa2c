"""The stages on edge cases, and each decision on a small corpus."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from llm_rows import rows_of
from shelfcast.llm import queries
from test_duplicates import jaccard_groups, later_copies
from test_tokens import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.choice('lmnrst')}{r.randrange(400)}" for _ in range(n))


def corpus():
    rows = [(i, prose(i)) for i in range(60)]
    rows += [(100 + i, prose(i)) for i in range(5)]
    near = prose(7).split(" ")
    near[50] = "changed"
    rows.append((200, " ".join(near)))
    rows.append((201, prose(201) + "\n" + prose(9) + "\n" + prose(202)))
    rows += [(300 + i, prose(300 + i) + f" you vileword{i} idiot scum " + prose(400 + i, 20)) for i in range(40)]
    rows.append((500, prose(500) + " write to jo.doe@mail.example.com or 10.1.2.3 " + prose(501)))
    return [(i, t, "en", "s", len(t)) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 400)) for i, *_ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_queries_are_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert names == {q.split("_")[0] for q in queries.callables()} and set(queries.callables()) <= set(contract.queries())
    assert "pipeline" in contract.queries() and set(queries.statements()) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dups", "pii", "packing"]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    clean = spark.createDataFrame(stages["toxicity"](spark, docs, folder).collect(), docs.schema)
    assert clean.columns == COLUMNS
    ids = {i for (i,) in rows_of(clean, "doc_id")}
    assert ids == {i for i, *_ in corpus() if not 300 <= i < 400}

    left = spark.createDataFrame(stages["line_dedup"](spark, clean, folder).collect(), docs.schema)
    want = {i: t for i, t, _, gone in later_copies(rows_of(clean, "doc_id", "text"), 50) if t or not gone}
    assert {i: t for i, t in rows_of(left, "doc_id", "text")} == want
    # copies are gone, the shared passage too, and lengths follow
    assert not {100, 101, 102, 103, 104} & set(want) and want[201] == prose(201) + "\n" + prose(202)
    assert all(n == len(t) for t, n in rows_of(left, "text", "n_chars"))

    single = spark.createDataFrame(stages["near_dups"](spark, left, folder).collect(), docs.schema)
    groups = jaccard_groups(rows_of(left, "doc_id", "text"), 5, 80)
    assert sorted(i for (i,) in rows_of(single, "doc_id")) == sorted(i for i, _, c in groups if c == i)
    assert 200 not in {i for (i,) in rows_of(single, "doc_id")}

    masked = spark.createDataFrame(stages["pii"](spark, single, folder).collect(), docs.schema)
    texts = dict(rows_of(masked, "doc_id", "text"))
    assert " write to <EMAIL> or <IP> " in texts[500]
    assert {i: t for i, t in texts.items() if i != 500} == {i: t for i, t in rows_of(single, "doc_id", "text") if i != 500}

    pieces = stages["packing"](spark, masked, folder).collect()
    assert {r["doc_id"] for r in pieces} == set(texts)
    check_packing(pieces, 4096)
    whole = corpus_pipeline.run(spark, folder)
    places = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(rows_of(whole, *places)) == Counter(tuple(r[c] for c in places) for r in pieces)


def test_stages_take_edge_cases(spark, folder, clashing_docs, no_docs):
    for docs in (clashing_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, folder)
            if name != "packing":
                assert found.columns == docs.columns
            assert found.count() <= (2 * docs.count() + 200 if name == "packing" else docs.count())
