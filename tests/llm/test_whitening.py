"""Exact polynomials, roots and null spaces, and whitened vectors against a plain decomposition."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_rows import rows_of
from shelfcast.llm import exact_roots, whitening

SCHEMA = "vec_id long, embedding array<float>"


def polynomial_of(a):
    """By traces of powers."""
    size, c, m = len(a), [1], np.zeros((len(a), len(a)), object)
    a = np.array(a, dtype=object)
    for k in range(1, size + 1):
        m = a @ m + c[-1] * np.diag([1] * size).astype(object)
        c.append(-int(np.trace(a @ m)) // k)  # divides without rest
    return c[::-1]


def characteristic(a):
    a = np.array(a, dtype=object)
    bound = math.prod(1 + int(np.abs(row).sum()) for row in a)
    primes = exact_roots.moduli(2 * bound + 1)
    residues = np.stack([(a % p).astype(np.int64) for p in primes])
    return exact_roots.lifted(exact_roots.polynomials(residues, np.array(primes)), primes)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7).flatmap(lambda d: st.lists(
    st.lists(st.one_of(st.just(0), st.integers(-9, 9), st.integers(-(10**15), 10**15)), min_size=d, max_size=d), min_size=d, max_size=d)))
def test_characteristic_polynomial(a):
    assert characteristic(a) == polynomial_of(a)


def test_primes():
    assert [n for n in range(60) if exact_roots.is_prime(n)] == [n for n in range(2, 60) if all(n % k for k in range(2, n))]
    found = exact_roots.moduli(2**200)
    assert found[0] == 2**31 - 1 and len(set(found)) == len(found) and math.prod(found) > 2**200


@pytest.mark.parametrize("roots", [
    [5], [0, 0, 3], [1, 2, 3, 4], [7, 7, 7], [1, 10**12, 10**12 + 1], [2, 2, 9, 9, 9, 0], [1, 10**40], [2**20, 2**20, 2**21],
])
def test_roots_with_their_multiplicity(roots):
    c = [1]
    for r in roots:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    found = exact_roots.Roots(c)
    positive = sorted((r for r in roots if r), reverse=True)
    assert found.degree == len(positive)
    for k, r in enumerate(positive):
        v, bits, higher, alike = found.largest(k)
        assert higher == sum(x > r for x in roots) and alike == roots.count(r)
        assert abs(Fraction(v, 1 << bits) - r) <= Fraction(max(roots), 2**80)


def test_close_roots_have_their_own_vectors():
    """Two eigenvalues that differ by 1e-16 of their size: doubles cannot tell them apart."""
    big = 10**18
    basis = np.array([[2, 1, 2], [1, 2, -2], [2, -2, -1]], dtype=object)  # orthogonal, each of length 3
    a = sum((big + k) * np.outer(basis[k], basis[k]) for k in range(3))
    found = exact_roots.Roots(characteristic(a))
    for k in range(3):
        v, bits, higher, alike = found.largest(k)
        assert alike == 1 and higher == k
        unit = exact_roots.null_space(a, v, bits, 1)[0]
        assert abs(abs(unit @ (basis[2 - k].astype(float) / 3)) - 1) < 1e-15


def plain(rows, components, scale):
    good = [(i, np.float32(v).tolist()) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for size in {len(v) for _, v in good} - {0}:
        own = [(i, [math.floor(scale * x) for x in v]) for i, v in good if len(v) == size]
        n, x = len(own), np.array([v for _, v in own], dtype=object)
        sums = x.sum(axis=0)
        d = n * x - sums
        centred = np.array([[float(Fraction(int(v), n)) for v in row] for row in d])
        value, vector = np.linalg.eigh(centred.T @ centred / n)
        order = np.argsort(-value)[:components]
        out[size] = ([(i, int((row**2).sum())) for (i, _), row in zip(own, d)], centred, value[order], vector[:, order], value.sum())
    return out


def check(spark, rows, components=4, scale=64):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("id", "size", "k", "n", "whitened")})
    got = whitening.whiten(df, components, scale).collect()
    want = plain(rows, components, scale)
    assert len(got) == sum(len(w[0]) * len(w[2]) for w in want.values())
    for named, centred, value, vector, total in want.values():
        mine = [r for r in got if r["n"] == len(named) and r["deviation"] in {d for _, d in named}]
        for k in range(len(value)):
            axis = [r for r in mine if r["component"] == k + 1]
            assert sorted(((r["vec_id"], r["deviation"]) for r in axis), key=str) == sorted(named, key=str)
            if value[k] < 1e-9:
                assert all(r["whitened"] is None and not r["explained"] for r in axis)
                continue
            assert all(r["explained"] == pytest.approx(value[k] / total, rel=1e-9) and r["identity_error"] < 1e-9 for r in axis)
            numbers = sorted(r["whitened"] for r in axis)
            expected = sorted(centred @ vector[:, k] / math.sqrt(value[k]))
            if not np.allclose(numbers, expected, atol=1e-8):
                assert np.allclose(numbers, sorted(-x for x in expected), atol=1e-8)
    return got


def test_whitened_like_a_plain_decomposition(spark):
    r = np.random.default_rng(3)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(r.standard_normal((160, 9)) @ np.diag(np.arange(1, 10.0)))]
    rows += [rows[3], (None, rows[4][1])]
    check(spark, rows)
    got = check(spark, rows[:5], components=9)  # fewer vectors than entries
    assert {r["component"] for r in got if r["whitened"] is None} == {5, 6, 7, 8, 9}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.5, 0.1]), (2, [0.1, 0.9, -0.4]), (3, [0.3, 0.2, 0.2]), (4, None), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]),
            (7, [None, 1.0, 1.0]), (8, []), (None, [0.5, -0.5, 0.5]), (9, [1.0, 2.0]), (10, [3.0, 4.0]), (11, [0.0])]
    got = check(spark, rows, components=2)
    assert {r["vec_id"] for r in got} == {1, 2, 3, None, 9, 10, 11}
    assert [(r["whitened"], r["explained"], r["identity_error"]) for r in got if r["vec_id"] == 11] == [(None, None, None)]
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_entries_beyond_longs(spark):
    rows = [(1, [1e30, 1.0]), (2, [2e30, 5.0]), (3, [-1e30, 2.0]), (4, [0.0, 8.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert all(r["deviation"] is None and r["deviation_exact"] is None and r["identity_error"] < 1e-9 for r in got)
    rows = [(k, [float(np.float32(x * 2e9))] ) for k, x in enumerate([0.25, 1.5, -3.0])]
    whole = [math.floor(64 * v[0]) for _, v in rows]
    got = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA), 1).collect()}
    for k, x in enumerate(whole):
        exact = (3 * x - sum(whole)) ** 2
        assert int(got[k]["deviation_exact"]) == exact and got[k]["deviation"] == (exact if exact < 2**63 else None)
