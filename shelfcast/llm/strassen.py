"""Exact integer matrix products by Strassen's recursion."""

from __future__ import annotations

import numpy as np

#: Below this length of a side the seven products cost more than the eight they replace.
LEAF = 32


def _even(a: np.ndarray) -> np.ndarray:
    """`a` with a row and a column of zeros where a side is odd."""
    rows, columns = a.shape
    if rows % 2 == columns % 2 == 0:
        return a
    wide = np.zeros((rows + rows % 2, columns + columns % 2), a.dtype)
    wide[:rows, :columns] = a
    return wide


def product(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """`a @ c.T` of integer matrices whose rows are vectors of one length.

    Seven half-size products and exact additions replace eight; sides of odd length get zeros. In int64 the sums
    wrap, and as additions and products modulo 2^64 are exact, so is every result that fits.
    """
    (m, k), n = a.shape, len(c)
    if min(m, k, n) <= LEAF:
        return a @ c.T
    a, c = _even(a), _even(c)
    i, j, h = a.shape[0] // 2, c.shape[0] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    # the right factor is c transposed: its block in row p and column q is the block (q, p) of c
    b11, b21, b12, b22 = c[:j, :h], c[:j, h:], c[j:, :h], c[j:, h:]
    m1 = product(a11 + a22, b11 + b22)
    m2 = product(a21 + a22, b11)
    m3 = product(a11, b12 - b22)
    m4 = product(a22, b21 - b11)
    m5 = product(a11 + a12, b22)
    m6 = product(a21 - a11, b11 + b12)
    m7 = product(a12 - a22, b21 + b22)
    whole = np.empty((2 * i, 2 * j), m1.dtype)
    whole[:i, :j] = m1 + m4 - m5 + m7
    whole[:i, j:] = m3 + m5
    whole[i:, :j] = m2 + m4
    whole[i:, j:] = m1 - m2 + m3 + m6
    return whole[:m, :n]
