"""Integer products by Strassen's recursion, and hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import rows_of
from shelfcast.llm import hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 0, 2), (0, 4, 5), (33, 64, 65), (70, 35, 130), (257, 100, 41)])
def test_products_are_exact(shape, monkeypatch):
    monkeypatch.setattr(strassen, "LEAF", 4)
    m, k, n = shape
    r = np.random.default_rng(m)
    a, c = r.integers(-(2**28), 2**28, (m, k)), r.integers(-(2**28), 2**28, (n, k))
    whole = a.astype(object) @ c.T.astype(object)
    assert (strassen.product(a, c) == whole).all()
    assert (strassen.product(a.astype(object) * 10**30, c.astype(object)) == whole * 10**30).all()


def brute(rows, positives=5, negatives=3, low=50, high=95, scale=256):
    """Rows are (place, id, vector, label, is_anchor); places number the rows as ties need them."""
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    taken = [(p, i, [math.floor(scale * x) for x in v], y, a) for p, i, v, y, a in rows if y is not None and good(v)]
    by_id = lambda t: (-t[0], math.inf if t[2] is None else t[2], t[1])
    found = []
    for place, anchor, x, label, is_anchor in taken:
        if not is_anchor:
            continue
        scored = [(sum(a * b for a, b in zip(x, z)), p, i, y) for p, i, z, y, _ in taken if p != place]
        same = sorted((t for t in scored if t[3] == label), key=by_id)[:positives]
        for t in same:
            window = [o for o in scored if o[3] != label and low * t[0] <= 100 * o[0] <= high * t[0]]
            for rank, o in enumerate(sorted(window, key=by_id)[:negatives], 1):
                found.append((anchor, t[2], rank, o[2], t[0], o[0]))
    return sorted(found, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, y) for i, v, y in rows], SCHEMA).coalesce(1)
    df = df.withColumns({c: F.lit(f"own {c}") for c in ("row", "id", "vector", "anchor", "tile", "rank", "score")})
    got = hard_negatives.mine(df, df["vec_id"] % 5 == 0, **options)
    places = [(p, i, v, y, i is not None and i % 5 == 0) for p, (i, v, y) in enumerate(rows)]
    want = brute(places, **options)
    assert sorted(rows_of(got), key=str) == want
    return want


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 7), ("TILE", 40), ("LEAST_TILE", 8), ("STRIP", 16)):
        monkeypatch.setattr(hard_negatives, name, value)
    r = np.random.default_rng(4)
    x = r.standard_normal((230, 40)).astype(np.float32) / 4 + 0.1
    # a third of all rows under one label, and many ties
    rows = [(k, [float(v) for v in row], int(r.choice([0, 0, 0, 1, 2, 3, 4, -5]))) for k, row in enumerate(x)]
    rows += [(300 + k, rows[3][1], 1) for k in range(40)]
    assert len(check(spark, rows)) > 500
    assert check(spark, rows, positives=2, negatives=1, low=70, high=90, scale=64)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (5, [0.5, 0.25, 0.5], 1), (None, [1.0, 0.5], 1), (1, [0.7, 0.2], 2),
        (2, None, 1), (3, [nan, 1.0], 1), (10, [inf, 1.0], 2), (15, [None, 1.0], 1), (20, [1.0, 1.0], None), (25, [], 1),
        (4, [0.0, 0.0], 2), (6, [-1.0, -1.0], 2), (None, [0.6, 0.2], 2), (7, [0.6, 0.2], 2), (8, [0.6, 0.2], 2), (30, [0.1], 7),
    ]
    assert check(spark, rows)
    assert rows_of(hard_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 5 == 0)) == []
    # longer than a long can score: left out
    far = [(0, [1e30, 0.0], 1), (1, [1e30, 0.0], 1), (5, [1.0, 0.0], 1), (6, [0.8, 0.0], 2), (7, [1.0, 0.0], 1)]
    got = rows_of(hard_negatives.mine(spark.createDataFrame(far, SCHEMA), F.col("vec_id") % 5 == 0))
    assert got == [(5, 7, 1, 6, 65536, 256 * math.floor(256 * np.float32(0.8)))]
