"""Embedding whitening on exact principal components.

Entries become whole numbers, floor(scale * c). One read of the vectors sums them and their products exactly; the sums of all
tasks meet as digits of 40 bits, added up by Spark. The integer scatter n * sum(x x') - S S' is n^2 times the covariance
and unmoved by a constant added to x. Its characteristic polynomial is computed modulo many primes at once
(`exact_roots.polynomials`; blocks of primes are tasks), lifted to integers by Chinese remaindering, and each component is
a task of its own: isolate one real root, narrow it to 180 bits, and span its null space by inverse iteration. A
second read centres and projects every vector; its products give `identity_error`, measured on the returned numbers.

What meets at the driver are the squared length of a vector in sums, a polynomial and 32 components, for each length that
vectors have; rows never do.

Defined results: rows with a null vector or a null or non-finite entry are dropped. Vectors of different lengths are whitened
apart, each length as a table of its own; an empty vector has no components and no row. Along a component without
variance (a single vector, equal vectors, fewer vectors than entries) `whitened` is null and `explained` 0, or null where
there is no variance at all; such components are no part of `identity_error`, which is null if all are such. Equal eigenvalues
share a space, of which any orthonormal vectors are returned, the same for all rows. Repeated rows and null ids count and are
returned. `deviation` is null where it does not fit a long; `deviation_exact` holds it up to 38 digits. An empty table gives an
empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace
from shelfcast.llm.exact_roots import Roots, coefficient_bound, lifted, moduli, null_space, polynomials
from shelfcast.llm.vectors import finite, largest, matrix, whole_steps

#: Bits of a digit while sums are added up, and primes of one task.
DIGIT, PRIMES = 40, 16


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch apart by the length of their vectors; empty vectors go."""
    sizes = np.diff(batch.column(column).offsets.to_numpy())
    for size in np.unique(sizes[sizes > 0]).tolist():
        yield size, batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


def _total(x: np.ndarray) -> np.ndarray:
    return (x if x.dtype != object and largest(x) * len(x) < 2**62 else x.astype(object)).sum(axis=0)


def _gram(x: np.ndarray) -> np.ndarray:
    """Exact x' x."""
    most = largest(x)
    if x.dtype != object and most * most * len(x) < 2**53:
        # whole numbers that doubles hold exactly, sums included
        return (x.T.astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
    return x.T @ x if x.dtype != object and most * most * len(x) < 2**62 else x.T.astype(object) @ x.astype(object)


def _moments(scale: int):
    """(size, i, j, digit, value): digits of the sums of x_i x_j, of x_i (j = -1), and of the rows (both -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for size, part in _by_length(batch, 0):
                x = whole_steps(matrix(part.column(0)), scale)
                n, total, gram = sums.setdefault(size, [0, np.zeros(size, object), np.zeros((size, size), object)])
                sums[size] = [n + len(x), total + _total(x), gram + _gram(x)]
        for size, (n, total, gram) in sums.items():
            named = [(-1, -1, n), *((i, -1, int(v)) for i, v in enumerate(total))]
            named += [(i, j, int(gram[i, j])) for i in range(size) for j in range(i, size)]
            rows = []
            for i, j, value in named:
                digit = 0
                while True:
                    rest = value >> DIGIT
                    if rest in (0, -1):
                        # the last digit keeps the sign
                        rows.append((size, i, j, digit, value))
                        break
                    rows.append((size, i, j, digit, value - (rest << DIGIT)))
                    value, digit = rest, digit + 1
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[k] for r in rows], pa.int32()) for k in range(4)), pa.array([r[4] for r in rows], pa.int64())],
                names=["size", "i", "j", "digit", "value"],
            )

    return run


def _fit_lists(rows: DataFrame, scale: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the number of vectors, their sums, and the scatter n * sum(x x') - S S', exactly."""
    digits = rows.select("vector").mapInArrow(_moments(scale), "size int, i int, j int, digit int, value long")
    summed = digits.groupBy("size", "i", "j", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    totals: dict[int, dict[tuple[int, int], int]] = {}
    taken = summed.toArrow()
    for size, i, j, digit, value in zip(*(taken.column(c).to_pylist() for c in taken.column_names), strict=True):
        own = totals.setdefault(size, {})
        own[i, j] = own.get((i, j), 0) + (int(value) << DIGIT * digit)
    found = {}
    for size, own in totals.items():
        n, sums = own[-1, -1], np.array([own[i, -1] for i in range(size)], dtype=object)
        scatter = np.zeros((size, size), object)
        for i in range(size):
            for j in range(i, size):
                scatter[i, j] = scatter[j, i] = n * own[i, j] - sums[i] * sums[j]
        found[size] = (n, sums, scatter)
    return found


def _primes(scatter: np.ndarray) -> list[int]:
    return moduli(2 * coefficient_bound(int(np.trace(scatter)), len(scatter)) + 1)


def _characteristic(spark: SparkSession, scatters: dict[int, np.ndarray]) -> dict[int, list[int]]:
    """The characteristic polynomial of each scatter, lowest coefficient first."""
    shared = spark.sparkContext.broadcast(scatters)
    blocks = [
        (size, primes[k : k + PRIMES]) for size, scatter in scatters.items() for primes in [_primes(scatter)]
        for k in range(0, len(primes), PRIMES)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, primes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p = np.array(primes, np.int64)
                found = polynomials(np.stack([(shared.value[size] % q).astype(np.int64) for q in primes]), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(p), pa.int32()), pa.array(p), pa.array(found.tolist(), pa.list_(pa.int64()))],
                    names=["size", "prime", "residues"],
                )

    tasks = spark.createDataFrame(blocks, "size int, primes array<long>").repartition(len(blocks), F.monotonically_increasing_id())
    rows = tasks.mapInArrow(run, "size int, prime long, residues array<long>").collect()
    found = {}
    for size in scatters:
        own = [r for r in rows if r["size"] == size]
        found[size] = lifted(np.array([r["residues"] for r in own], dtype=object), [r["prime"] for r in own])
    return found


def _components(spark: SparkSession, fits: dict, polynomials_of: dict[int, list[int]], most: int) -> dict[int, list]:
    """Per length, the first components as (eigenvalue of the covariance, share of its trace, unit vector); no variance: (0, 0, None)."""
    shared = spark.sparkContext.broadcast({size: (fits[size][0], fits[size][2], polynomials_of[size]) for size in fits})
    wanted = [(size, k) for size in fits for k in range(min(size, most))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, scatter, coefficients = shared.value[size]
                roots = Roots(coefficients)
                value, share, unit = 0.0, 0.0, None
                if k < roots.degree:
                    v, bits, higher, alike = roots.largest(k)
                    unit = null_space(scatter, v, bits, alike)[k - higher].tolist()
                    value, share = v / (n * n << bits), v / (int(np.trace(scatter)) << bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([k], pa.int32()), pa.array([value]), pa.array([share]),
                     pa.array([unit], pa.list_(pa.float64()))],
                    names=["size", "k", "value", "share", "unit"],
                )

    tasks = spark.createDataFrame(wanted, "size int, k int").repartition(len(wanted), F.monotonically_increasing_id())
    rows = tasks.mapInArrow(run, "size int, k int, value double, share double, unit array<double>").collect()
    return {
        size: [(r["value"], r["share"], r["unit"]) for r in sorted((r for r in rows if r["size"] == size), key=lambda r: r["k"])]
        for size in fits
    }


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly."""
    if x.dtype != object and n * largest(x) + largest(sums) < 2**62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _projected(scale: int, shared):
    """Rows with their exact deviation and whitened entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch, 1):
                n, sums, components = shared.value[size]
                d = _centred(whole_steps(matrix(part.column(1)), scale), n, sums)
                if d.dtype == object or largest(d) ** 2 * size >= 2**63:
                    squares = [int(v) for v in (d.astype(object) ** 2).sum(axis=1)]
                    deviation = pa.array([v if v < 2**63 else None for v in squares], pa.int64())
                    exact = pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
                    x = np.array([[int(v) / n for v in row] for row in d]) if d.dtype == object else d / n
                else:
                    deviation = pa.array((d * d).sum(axis=1))
                    exact, x = deviation.cast(pa.decimal128(38, 0)), d / n
                some = [k for k, (_, _, unit) in enumerate(components) if unit]
                whitened = np.full((len(x), len(components)), np.nan)
                if some:
                    axes = np.array([components[k][2] for k in some]) / np.sqrt([[components[k][0]] for k in some])
                    whitened[:, some] = x @ axes.T
                flat = pa.array(whitened.ravel(), from_pandas=True)
                ends = pa.array(np.arange(len(x) + 1) * len(components), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(x), size, np.int32)), deviation, exact, pa.ListArray.from_arrays(ends, flat)],
                    names=["id", "size", "deviation", "deviation_exact", "whitened"],
                )

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, i, j, value): sums of the products of whitened entries, and of the entries (j = -1)."""
    sums: dict[int, list] = {}
    for batch in batches:
        sizes = batch.column(0).to_numpy()
        for size in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == size)).column(1)
            w = pc.fill_null(part.flatten(), 0.0).to_numpy(zero_copy_only=False).reshape(len(part), -1)
            total, gram = sums.setdefault(size, [0.0, 0.0])
            sums[size] = [total + w.sum(axis=0), gram + w.T @ w]
    for size, (total, gram) in sums.items():
        k = len(total)
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k + k * k, size, np.int32)), pa.array(np.append(np.arange(k), i), pa.int32()),
             pa.array(np.append(np.full(k, -1), j), pa.int32()), pa.array(np.append(total, gram.ravel()))],
            names=["size", "i", "j", "value"],
        )


def _identity_errors(whitened: DataFrame, fits: dict, components: dict[int, list]) -> dict[int, float | None]:
    """Per length, the largest entry of the covariance of what was written, less the identity."""
    summed = whitened.select("size", "whitened").mapInArrow(_products, "size int, i int, j int, value double")
    found: dict[int, tuple] = {}
    for r in summed.groupBy("size", "i", "j").agg(F.sum("value").alias("value")).collect():
        found.setdefault(r["size"], {})[r["i"], r["j"]] = r["value"]
    errors = {}
    for size, own in found.items():
        n, some = fits[size][0], [k for k, (_, _, unit) in enumerate(components[size]) if unit]
        mean = {k: own[k, -1] / n for k in some}
        errors[size] = max((abs(own[i, j] / n - mean[i] * mean[j] - (i == j)) for i in some for j in some), default=None)
    return errors


def whiten(
    embeddings: DataFrame, components: int = 32, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error, deviation_exact."""
    spark = embeddings.sparkSession
    work = Workspace(spark)
    rows = embeddings.select(embeddings[id_col].alias("id"), embeddings[vector_col].alias("vector"))
    rows = rows.where(finite(F.col("vector")))
    fits = _fit_lists(rows, scale)
    varied = {size: fit for size, fit in fits.items() if np.trace(fit[2])}
    units = {size: [(0.0, None, None)] * min(size, components) for size in fits}
    if varied:
        exact = _characteristic(spark, {size: fit[2] for size, fit in varied.items()})
        units |= _components(spark, varied, exact, components)
    shared = spark.sparkContext.broadcast({size: (n, sums, units[size]) for size, (n, sums, _) in fits.items()})
    whitened = work.keep(
        rows.mapInArrow(
            _projected(scale, shared),
            f"id {rows.schema[0].dataType.simpleString()}, size int, deviation long, deviation_exact decimal(38,0), "
            "whitened array<double>",
        ),
        "whitened",
    )
    errors = _identity_errors(whitened, fits, units)
    # a row for each length of vectors, of 32 numbers
    facts = spark.createDataFrame(
        [(size, fits[size][0], [share for _, share, _ in units[size]], errors.get(size)) for size in fits],
        "size int, n long, explained array<double>, identity_error double",
    )
    each = whitened.join(F.broadcast(facts), "size").select(
        "id", "n", "deviation", "deviation_exact", "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "entry"),
    )
    return each.select(
        F.col("id").alias(id_col), (F.col("k") + 1).alias("component"), "n", "deviation", "entry.whitened", "entry.explained",
        "identity_error", "deviation_exact",
    )
