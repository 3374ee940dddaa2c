"""Many Tweedie regressions at once, by iteratively reweighted least squares in Spark.

A model belongs to a group of rows (a store, or all of them) and to a variant: a window of training days and the inputs
it may use. Every step is one scan of the rows for all models that have not converged: a task adds up, for each model, the
Gram matrix and the right side of the weighted least squares at the model's present coefficients; the sums of the tasks meet
by (group, variant) and are solved there. So the number of jobs is that of the steps, whatever the number of models, and a
group's rows are never brought together: only its sums are, of a size that depends on the inputs alone.

Inputs are standardised by the moments of a model's own window; an input that does not vary there is left out. A step that
makes the penalised deviance worse is halved. A model has converged when its deviance changes by less than `TOL` of itself;
those that have not after `max_iter` steps are named in a warning and marked.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative change of the deviance that counts as none, steps, and the weight of the penalty on standardised inputs.
TOL, MAX_ITER, RIDGE = 1e-8, 60, 1e-3
#: Variance grows with the mean to this power.
POWER = 1.1
#: Coefficients that a step may send to every task, in bytes, and partial sums that a task may hold.
SENT_BYTES, HELD_SUMS = 64 << 20, 64
#: Sums of tasks meet in so many parts of a model first.
FAN = 64
_EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class Variant:
    """Training days from `start` to `end`, and the positions of the inputs used."""

    name: str
    start: date
    end: date
    inputs: tuple[int, ...]

    @property
    def days(self) -> tuple[int, int]:
        return (self.start - _EPOCH).days, (self.end - _EPOCH).days


@dataclass
class Model:
    """Coefficients on standardised inputs, the intercept first; `used` are positions in the row's inputs."""

    used: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    beta: np.ndarray
    n_rows: int
    #: Of a squared standardised coefficient in the penalised deviance.
    penalty: float = 0.0
    deviance: float = np.inf
    steps: int = 0
    converged: bool = False

    def linear(self, x: np.ndarray) -> np.ndarray:
        """The logarithm of the prediction."""
        scaled = (x[:, self.used] - self.mean) / self.spread
        return np.clip(self.beta[0] + scaled @ self.beta[1:], -30, 30)


def deviance(y: np.ndarray, mu: np.ndarray) -> float:
    """Twice the distance of the log likelihoods of y and mu."""
    a, b = 1 - POWER, 2 - POWER
    return float(2 * (y**b / (a * b) - y * mu**a / a + mu**b / b).sum())


def groups_of(batch: pa.RecordBatch, column: int) -> Iterator[tuple[str, np.ndarray]]:
    """Each group's name and the places of its rows."""
    codes = batch.column(column).dictionary_encode()
    index, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
    order = np.argsort(index, kind="stable")
    cuts = np.searchsorted(index[order], np.arange(len(names) + 1))
    for k, name in enumerate(names):
        yield name, order[cuts[k] : cuts[k + 1]]


def matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The inputs of all rows; they have the same number of them."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _emit(names: list[tuple], sums: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sums])])
    return pa.RecordBatch.from_arrays(
        [pa.array([g for g, _ in names]), pa.array([v for _, v in names], pa.int32()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sums)))],
        names=["group", "variant", "sums"],
    )


SUMS = "group string, variant int, sums array<double>"


def _added(rows: DataFrame, summing) -> DataFrame:
    """(group, variant, sums): what `summing` yields for each batch and model, added up over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, sums in summing(batch):
                held[key] = held[key] + sums if key in held else sums
            if len(held) > HELD_SUMS:
                yield _emit(list(held), list(held.values()))
                held = {}
        if held:
            yield _emit(list(held), list(held.values()))

    def total(parts: pa.Table) -> pa.Table:
        first = parts.slice(0, 1).combine_chunks()
        flat = pc.list_flatten(parts.column("sums")).to_numpy().reshape(parts.num_rows, -1).sum(axis=0)
        sums = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))
        return pa.table([first.column("group"), first.column("variant"), sums], names=["group", "variant", "sums"])

    part = F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("part")
    parts = rows.mapInArrow(run, SUMS).select("group", "variant", "sums", part)
    parts = parts.groupBy("group", "variant", "part").applyInArrow(total, SUMS)
    return parts.groupBy("group", "variant").applyInArrow(total, SUMS)


def _moments(rows: DataFrame, windows: Sequence[tuple[int, int]]) -> dict[tuple[str, int], np.ndarray]:
    """Rows, labels, inputs and their squares, summed by group and window."""

    def summing(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
        day, y, x = batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch, 3)
        for group, places in groups_of(batch, 0):
            for k, (start, end) in enumerate(windows):
                own = places[(day[places] >= start) & (day[places] <= end)]
                if len(own):
                    part = x[own]
                    yield (group, k), np.concatenate([[len(own), y[own].sum()], part.sum(axis=0), (part * part).sum(axis=0)])

    return {(r["group"], r["variant"]): np.array(r["sums"]) for r in _added(rows, summing).collect()}


def _start(sums: np.ndarray, inputs: Sequence[int], ridge: float) -> Model:
    """The mean of the labels, on the inputs that vary."""
    n, total = sums[0], sums[1]
    half = (len(sums) - 2) // 2
    mean, square = sums[2 : 2 + half] / n, sums[2 + half :] / n
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    used = np.array([k for k in inputs if spread[k] > 1e-9 * (1 + abs(mean[k]))], dtype=np.int64)
    beta = np.zeros(len(used) + 1)
    beta[0] = np.log(total / n) if total > 0 else -30.0
    # without any sale there is nothing to fit
    # the penalty is a share of the weights of all rows at the start
    penalty = ridge * n * float(np.exp(beta[0] * (2 - POWER)))
    return Model(used, mean[used], spread[used], beta, int(n), penalty, converged=total <= 0)


def _step(rows: DataFrame, variants: Sequence[Variant], models: dict) -> dict:
    """(deviance, next coefficients) of each model at its present coefficients, from one scan."""
    shared = rows.sparkSession.sparkContext.broadcast(models)
    days = [v.days for v in variants]

    def summing(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
        day, y, x = batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch, 3)
        for group, places in groups_of(batch, 0):
            for k, (start, end) in enumerate(days):
                model = shared.value.get((group, k))
                if model is None:
                    continue
                own = places[(day[places] >= start) & (day[places] <= end)]
                if not len(own):
                    continue
                part, label = x[own], y[own]
                eta = model.linear(part)
                mu = np.exp(eta)
                weight = mu ** (2 - POWER)
                scaled = np.empty((len(own), len(model.beta)))
                scaled[:, 0] = 1
                scaled[:, 1:] = (part[:, model.used] - model.mean) / model.spread
                weighted = scaled * weight[:, None]
                yield (group, k), np.concatenate([
                    [deviance(label, mu)], weighted.T @ (eta + (label - mu) / mu), (weighted.T @ scaled).ravel()
                ])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, k, flat in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                model, flat = shared.value[group, k], np.array(flat)
                size = len(model.beta)
                gram = flat[1 + size :].reshape(size, size).copy()
                gram[np.arange(1, size), np.arange(1, size)] += model.penalty
                yield _emit([(group, k)], [np.append(flat[0], np.linalg.solve(gram, flat[1 : 1 + size]))])

    found = _added(rows, summing).mapInArrow(solve, SUMS).collect()
    shared.destroy()
    return {(r["group"], r["variant"]): (r["sums"][0], np.array(r["sums"][1:])) for r in found}


def _waves(rows: DataFrame, variants: Sequence[Variant], n_inputs: int) -> int:
    groups = rows.agg(F.approx_count_distinct("group")).first()[0]
    return -(-int(1.1 * groups) * len(variants) * (n_inputs + 8) * 3 * 8 // SENT_BYTES) or 1


def fit(
    rows: DataFrame, variants: Sequence[Variant], n_inputs: int, max_iter: int = MAX_ITER, ridge: float = RIDGE
) -> dict[tuple[str, str], Model]:
    """Models by (group, variant name) from rows of (group string, day int, y double, x array<double>).

    `rows` are read once a step: they should be a stored table. Groups without rows in a variant's window have no model.
    Where the coefficients of all groups are more than a step may send, the groups are fitted in several waves.
    """
    windows = sorted({v.days for v in variants})
    waves = _waves(rows, variants, n_inputs)
    found: dict[tuple[str, str], Model] = {}
    for wave in range(waves):
        part = rows if waves == 1 else rows.where(F.pmod(F.xxhash64("group"), F.lit(waves)) == wave)
        sums = _moments(part, windows)
        models = {
            (group, k): _start(sums[group, windows.index(v.days)], v.inputs, ridge)
            for group in {g for g, _ in sums} for k, v in enumerate(variants) if (group, windows.index(v.days)) in sums
        }
        before: dict[tuple, tuple[float, np.ndarray]] = {}
        for _ in range(max_iter):
            open_ = {key: model for key, model in models.items() if not model.converged}
            if not open_:
                break
            for key, (dev, ahead) in _step(part, variants, open_).items():
                model = models[key]
                model.steps += 1
                value = dev + model.penalty * float(model.beta[1:] @ model.beta[1:])
                old, at = before.get(key, (np.inf, model.beta))
                if value > old + TOL * abs(old):
                    model.beta = (model.beta + at) / 2
                    continue
                model.deviance = dev
                if abs(old - value) <= TOL * (abs(value) + 0.1):
                    model.converged = True
                    continue
                before[key] = (value, model.beta)
                model.beta = ahead
        found |= {(group, variants[k].name): model for (group, k), model in models.items()}
    late = sorted(f"{group} {name}".strip() for (group, name), model in found.items() if not model.converged)
    if late:
        warnings.warn(f"{len(late)} of {len(found)} regressions have not converged: {', '.join(late[:10])}", stacklevel=2)
    return found


def predict(rows: DataFrame, models: dict[tuple[str, str], Model], windows: dict[str, tuple[date, date]]) -> DataFrame:
    """`rows` (group, day, x and further columns) by variant: `variant` and `prediction` on the days of its window.

    A row whose group has no model of the variant gets a null prediction.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(models)
    spans = {name: ((a - _EPOCH).days, (b - _EPOCH).days) for name, (a, b) in windows.items()}
    names = rows.columns
    group, day, x = (names.index(c) for c in ("group", "day", "x"))
    kept = [k for k, c in enumerate(names) if c != "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            days, inputs = batch.column(day).to_numpy(), matrix(batch, x)
            for name, (start, end) in spans.items():
                inside = (days >= start) & (days <= end)
                if not inside.any():
                    continue
                predicted = np.full(batch.num_rows, np.nan)
                for g, places in groups_of(batch, group):
                    own = places[inside[places]]
                    model = shared.value.get((g, name))
                    if model is not None and len(own):
                        predicted[own] = np.exp(model.linear(inputs[own]))
                at = pa.array(np.flatnonzero(inside))
                columns = [batch.column(k).take(at) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([name] * len(at)), pa.array(predicted[inside], from_pandas=True)],
                    names=[*(names[k] for k in kept), "variant", "prediction"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "x")
    return rows.mapInArrow(run, f"{fields}, variant string, prediction double")


def permuted_errors(
    rows: DataFrame, models: dict[tuple[str, str], Model], windows: dict[str, tuple[date, date]], seed: int = 42
) -> DataFrame:
    """(group, variant, position, abs_error, volume): the absolute error of each model when one input is shuffled.

    `rows` have group, day, y and x. They are dealt out by a hash first, so that a batch is a random part of them; inside a
    batch an input changes places among the rows of a model, one input at a time, in one scan for all inputs and models.
    Position -1 is the error with nothing shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)
    spans = {name: ((a - _EPOCH).days, (b - _EPOCH).days) for name, (a, b) in windows.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            day, y, x = batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch, 3)
            for group, places in groups_of(batch, 0):
                for name, (start, end) in spans.items():
                    model = shared.value.get((group, name))
                    own = places[(day[places] >= start) & (day[places] <= end)]
                    if model is None or not len(own):
                        continue
                    part, label = x[own], y[own]
                    eta, order = model.linear(part), np.random.default_rng([seed, number]).permutation(len(own))
                    errors = [np.abs(np.exp(eta) - label).sum()]
                    for k, b, spread in zip(model.used.tolist(), model.beta[1:], model.spread, strict=True):
                        moved = eta + b * (part[order, k] - part[:, k]) / spread
                        errors.append(np.abs(np.exp(np.clip(moved, -30, 30)) - label).sum())
                    n = len(errors)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group] * n), pa.array([name] * n), pa.array([-1, *model.used.tolist()], pa.int32()),
                         pa.array(errors), pa.array(np.full(n, label.sum()))],
                        names=["group", "variant", "position", "abs_error", "volume"],
                    )

    dealt = rows.select("group", "day", "y", "x", F.xxhash64("day", "y", "x", F.lit(seed)).alias("_place"))
    dealt = dealt.repartition("_place").sortWithinPartitions("_place").drop("_place")
    found = dealt.mapInArrow(run, "group string, variant string, position int, abs_error double, volume double")
    return found.groupBy("group", "variant", "position").agg(
        F.sum("abs_error").alias("abs_error"), F.sum("volume").alias("volume")
    )
