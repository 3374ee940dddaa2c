"""Error measures as aggregate columns. An empty denominator gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mae(actual="sales", predicted="prediction") -> Column:
    return F.avg(F.abs(_col(actual) - _col(predicted)))


def rmse(actual="sales", predicted="prediction") -> Column:
    error = _col(actual) - _col(predicted)
    return F.sqrt(F.avg(error * error))


def wmape(actual="sales", predicted="prediction") -> Column:
    """Sum of absolute errors over the sum of absolute actuals."""
    return ratio(F.sum(F.abs(_col(actual) - _col(predicted))), F.sum(F.abs(_col(actual))))


def bias(actual="sales", predicted="prediction") -> Column:
    """Positive when the forecast is too high."""
    return ratio(F.sum(_col(predicted) - _col(actual)), F.sum(_col(actual)))


def rmsse(mean_squared_error: Column, scale: Column) -> Column:
    """Root of the error scaled by the one-day naive error; NULL without a positive scale."""
    return F.sqrt(mean_squared_error / F.when(scale > 0, scale))


def simple_metrics(actual="sales", predicted="prediction") -> list[Column]:
    return [
        wmape(actual, predicted).alias("wmape"),
        mae(actual, predicted).alias("mae"),
        rmse(actual, predicted).alias("rmse"),
        bias(actual, predicted).alias("bias"),
    ]


#: Names of `error_sums`.
ERROR_SUMS = ("abs_error", "sq_error", "error", "volume", "size", "n")


def error_sums(actual="sales", predicted="prediction") -> list[Column]:
    """Sums from which the simple metrics follow; sums of finer groups add up to those of coarser ones."""
    y, e = _col(actual), _col(predicted) - _col(actual)
    sums = (F.sum(F.abs(e)), F.sum(e * e), F.sum(e), F.sum(y), F.sum(F.abs(y)), F.count(e))
    return [total.alias(name) for total, name in zip(sums, ERROR_SUMS, strict=True)]


def metrics_of_sums() -> list[Column]:
    """The simple metrics of rows that hold error sums."""
    return [
        ratio(F.col("abs_error"), F.col("size")).alias("wmape"), ratio(F.col("abs_error"), F.col("n")).alias("mae"),
        F.sqrt(ratio(F.col("sq_error"), F.col("n"))).alias("rmse"), ratio(F.col("error"), F.col("volume")).alias("bias"),
    ]
