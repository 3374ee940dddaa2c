"""Words, windows and decontamination against plain versions."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_rows import rows_of
from shelfcast.llm import decontaminate
from shelfcast.llm.queries import DECONTAMINATION_SQL, op13_decontamination

ITEMS = "item_id long, text string"
DATA = "/root/testdata/sf0.01"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZz09 .,-\n éЖ日😀@[`{\x7f"), st.text()), max_size=8))
def test_equal_words_have_equal_hashes(texts):
    column = pa.array(["a b", *texts], pa.string()).fill_null("").slice(1)
    offsets, hashes = decontaminate.Words().of(column)
    want = [words_of(t) for t in texts]
    assert np.diff(offsets).tolist() == [len(w) for w in want]
    flat = [w for row in want for w in row]
    assert len(set(hashes.tolist())) == len(set(flat)) == len(set(zip(flat, hashes.tolist())))


@pytest.mark.parametrize("width", [1, 2, 3, 5, 9, 10])
def test_a_window_keeps_the_same_fingerprint_wherever_it_stands(width):
    r = np.random.default_rng(width)
    offsets = np.array([0, 0, 4, 40, 40, 61, 64])
    words = r.integers(0, 3, 64).astype(np.uint64)
    within, least, whole = decontaminate.windows(offsets, words, width)
    spelled = {}
    for i in range(64 - width + 1):
        row = int(np.searchsorted(offsets, i, side="right")) - 1
        assert within[i] == (i + width <= offsets[row + 1])
        spelled.setdefault(tuple(words[i : i + width].tolist()), set()).add((int(least[i]), int(whole[i])))
    assert all(len(found) == 1 for found in spelled.values())
    assert len({w for found in spelled.values() for _, w in found}) == len(spelled)


def brute(docs, items, width=10):
    spans = {}
    for item, text in items:
        words = words_of(text)
        length = min(len(words), width)
        for s in range(len(words) - length + 1 if words else 0):
            spans.setdefault(tuple(words[s : s + length]), set()).add(item)
    found = []
    for doc, text in docs:
        words, hit, met = words_of(text), set(), set()
        for length in range(1, width + 1):
            for s in range(len(words) - length + 1):
                if tuple(words[s : s + length]) in spans:
                    hit.update(range(s, s + length))
                    met |= spans[tuple(words[s : s + length])]
        ids = sorted(str(i) for i in met if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        found.append((doc, len(words), len(hit), len(ids), digest, bool(hit)))
    return sorted(found, key=str)


def check(spark, docs, items, width=10):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    left = left.withColumns({c: F.lit(f"own {c}") for c in ("row", "n_words", "marked", "print", "window", "items")})
    right = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit(1) for c in ("length", "doc_id", "sum")})
    got = decontaminate.find(left, right, width)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute(docs, items, width)
    assert sorted(rows_of(got), key=str) == want
    return want


def test_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 3000)
    r = np.random.default_rng(2)
    def text(n, v):
        return " ".join(f"W{x}" for x in r.integers(0, v, n))
    items = [(i, text(int(r.integers(1, 40)), 400)) for i in range(60)]
    items += [(100, items[3][1]), (101, items[3][1].lower()), (3, items[4][1]), (None, items[5][1]), (102, None), (103, "?!")]
    docs = []
    for d in range(150):
        parts = [text(int(r.integers(0, 30)), 4000)]
        for _ in range(int(r.integers(0, 4))):
            words = (items[int(r.integers(0, 60))][1]).split()
            a = int(r.integers(0, len(words)))
            parts += [" ".join(words[a : a + int(r.integers(1, 25))]).upper(), text(int(r.integers(0, 3)), 4000)]
        docs.append((d, "... ".join(parts)))
    docs += [(7, docs[7][1]), (None, docs[8][1]), (200, None), (201, ""), (202, " .\n"), (203, text(30_000, 60)), (204, "x" * 50_000)]
    assert sum(row[-1] for row in check(spark, docs, items)) > 50
    check(spark, docs[:40] + docs[-4:], items, width=4)


def test_no_items_and_no_documents(spark):
    docs = [(1, "some words of a text"), (2, None)]
    assert not any(row[-1] for row in check(spark, docs, []))
    assert not any(row[-1] for row in check(spark, docs, [(1, None), (2, " ")]))
    assert check(spark, [], [(1, "some words")]) == []


def test_query_equals_sql(spark):
    assert difference(op13_decontamination(spark, DATA), DECONTAMINATION_SQL, DATA) is None
