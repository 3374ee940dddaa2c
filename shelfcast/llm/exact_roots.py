"""Exact characteristic polynomials of integer matrices, and roots and null spaces of positive semidefinite ones."""

from __future__ import annotations

import math

import numpy as np

#: Roots closer than 2^-APART of the trace count as one of several dimensions; a single one is narrowed to 2^-NARROW.
APART, NARROW = 90, 180
#: Fractional bits while a system is solved.
GUARD = 256


def is_prime(n: int) -> bool:
    """Strong probable primes to the bases 2, 3, 5 and 7 are primes below 2^31."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def moduli(limit: int) -> list[int]:
    """The largest primes below 2^31, as many as have a product over `limit`."""
    found, product, n = [], 1, 2**31 - 1
    while product <= limit:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bound(trace: int, size: int) -> int:
    """No coefficient exceeds this: a sum of products of k roots is greatest where all are equal."""
    mean = trace // max(size, 1) + 1
    return max(math.comb(size, k) * mean**k for k in range(size + 1))


def _inverse(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """a^(p - 2) modulo p, elementwise; 0 of 0."""
    result, power, e = np.ones_like(a), a.copy(), p - 2
    while e.any():
        result = np.where(e & 1, result * power % p, result)
        power, e = power * power % p, e >> 1
    return result


def polynomials(residues: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients, lowest first, of det(x - A) modulo each prime; `residues` are as many matrices as primes.

    All matrices are brought to Hessenberg form at once by row and column operations that keep the polynomial,
    then it follows from the leading minors one by one.
    """
    a, (count, size, _) = residues.copy(), residues.shape
    q, qq, each = p[:, None], p[:, None, None], np.arange(len(p))
    for k in range(size - 2):
        # the first row with a non-zero entry in this column becomes row k + 1, and the same for columns
        pivot = (a[:, k + 1 :, k] != 0).argmax(axis=1) + k + 1
        for view in (a, a.transpose(0, 2, 1)):
            held = view[each, pivot].copy()
            view[each, pivot] = view[:, k + 1]
            view[:, k + 1] = held
        u = a[:, k + 2 :, k] * _inverse(a[:, k + 1, k], p)[:, None] % q
        a[:, k + 2 :] = (a[:, k + 2 :] - u[:, :, None] * a[:, None, k + 1]) % qq
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * u[:, None, :] % qq).sum(axis=2)) % q
    minors = np.zeros((size + 1, count, size + 1), np.int64)
    minors[0, :, 0] = 1
    for m in range(1, size + 1):
        now = np.zeros((count, size + 1), np.int64)
        now[:, 1:] = minors[m - 1, :, :-1]
        now = (now - a[:, m - 1, m - 1, None] * minors[m - 1]) % q
        below = np.ones(count, np.int64)
        for i in range(1, m):
            below = below * a[:, m - i, m - i - 1] % p
            now = (now - (a[:, m - i - 1, m - 1] * below % p)[:, None] * minors[m - i - 1]) % q
        minors[m] = now
    return minors[size]


def lifted(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integers of least size with these residues (one row for each prime)."""
    product = math.prod(primes)
    weights = []
    for p in primes:
        rest = product // p
        weights.append(rest * pow(rest % p, -1, p))
    found = []
    for column in residues.T.tolist():
        value = sum(r * w for r, w in zip(column, weights, strict=True)) % product
        found.append(value - product if value * 2 > product else value)
    return found


class Roots:
    """Roots of a polynomial all of whose roots are real and none negative.

    A place p of level l stands for p * 2^(top - l), where 2^top is greater than every root.
    """

    def __init__(self, coefficients: list[int]):
        zeros = next(i for i, c in enumerate(coefficients) if c)
        self.coefficients = coefficients[zeros:]
        self.degree = len(self.coefficients) - 1
        self.top = (-self.coefficients[-2] + 1 if self.degree else 1).bit_length()

    def whole(self, place: int, level: int) -> tuple[int, int]:
        """The same as v / 2^bits."""
        return (place << self.top - level, 0) if level <= self.top else (place, level - self.top)

    def above(self, place: int, level: int) -> int:
        """Roots greater than a place, each as often as it counts.

        The coefficients of the polynomial moved to that place change sign once for each, by the rule of Descartes,
        which is exact where all roots are real.
        """
        v, bits = self.whole(place, level)
        c = [x << bits * (self.degree - i) for i, x in enumerate(self.coefficients)]
        for i in range(self.degree):
            for j in range(self.degree - 1, i - 1, -1):
                c[j] += v * c[j + 1]
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def sign(self, place: int, level: int) -> int:
        v, bits = self.whole(place, level)
        value, unit = 0, 0
        for c in reversed(self.coefficients):
            value, unit = value * v + (c << unit), unit + bits
        return (value > 0) - (value < 0)

    def largest(self, k: int) -> tuple[int, int, int, int]:
        """The root with k greater or equal ones before it: v and bits of v / 2^bits, the number of roots greater
        than it, and of those that cannot be told from it, itself included."""
        # the root lies above `low` and not above the next place; `upto` roots are above the one, `higher` above the other
        low, level, upto, higher = 0, 0, self.degree, 0
        while upto - higher > 1 and level < APART:
            low, level = 2 * low, level + 1
            n = self.above(low + 1, level)
            if n > k:
                low, upto = low + 1, n
            else:
                higher = n
        if upto - higher == 1:
            end = self.sign(low + 1, level)
            while end and low.bit_length() < NARROW:
                low, level = 2 * low, level + 1
                middle = self.sign(low + 1, level)
                if middle and middle != end:
                    low += 1
                else:
                    end = middle
            if not end:
                return *self.whole(low + 1, level), higher, 1
        return *self.whole(2 * low + 1, level + 1), higher, upto - higher


def null_space(matrix: np.ndarray, place: int, bits: int, count: int) -> np.ndarray:
    """Orthonormal rows that span what `matrix - place / 2^bits` all but annihilates, by inverse iteration.

    `matrix` holds Python integers. Elimination and iteration run on integers with `GUARD` fractional bits, so that the rows
    are right to the last places of a double also where roots are close.
    """
    size = len(matrix)
    w = (matrix * (1 << bits) - np.diag([place] * size).astype(object)) * (1 << GUARD)
    order = np.arange(size)
    for k in range(size):
        pivot = k + max(range(size - k), key=lambda i: abs(w[k + i, k]))
        w[[k, pivot]], order[[k, pivot]] = w[[pivot, k]], order[[pivot, k]]
        # an exact root leaves nothing to divide by: the least there is takes its place
        w[k, k] = w[k, k] or 1
        w[k + 1 :, k] = (w[k + 1 :, k] << GUARD) // w[k, k]
        w[k + 1 :, k + 1 :] -= w[k + 1 :, k, None] * w[None, k, k + 1 :] >> GUARD

    def scaled(x: np.ndarray) -> np.ndarray:
        by = GUARD - max(max(abs(v) for v in x), 1).bit_length()
        return x << by if by >= 0 else x >> -by

    def solved(b: np.ndarray) -> np.ndarray:
        y = b[order]
        for k in range(size):
            y[k + 1 :] -= w[k + 1 :, k] * y[k] >> GUARD
        for k in reversed(range(size)):
            y[k] = (y[k] << 2 * GUARD) // w[k, k]
            y[:k] -= w[:k, k] * y[k] >> 2 * GUARD
        return scaled(y)

    random, found = np.random.default_rng(size), []
    for _ in range(count):
        x = random.integers(-(2**60), 2**60, size).astype(object)
        for _ in range(3):
            x = solved(scaled(x))
            for u in found:
                x = x - (u * (int((x * u).sum()) >> GUARD) >> GUARD)
        length = math.isqrt(int((x * x).sum()))
        found.append((x << GUARD) // length)
    unit = 1 << GUARD
    return np.array([[v / unit for v in x] for x in found])
