"""Baseline forecasts. Every function serves any number of origins in one pass.

`history` holds (id, date, sales) rows; the result is (id, as_of, date, horizon, prediction). Rows meet their
origins through a small (origin, day) table, so a day that serves several origins is read once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS = 90
OUTPUT = ("id", "as_of", "date", "horizon", "prediction")


def _within(history: DataFrame, origins: list[date], days: int) -> DataFrame:
    """Rows of the `days` days up to each origin, once per origin."""
    windows = (
        history.sparkSession.createDataFrame([(o,) for o in origins], "as_of date")
        .select("as_of", F.explode(F.sequence(F.date_sub("as_of", days - 1), "as_of")).alias("date"))
    )
    first, last = min(origins), max(origins)
    recent = history.filter(F.col("date").between(F.date_sub(F.lit(first), days - 1), F.lit(last)))
    return recent.filter(F.col("sales").isNotNull()).join(windows, "date")


def _over_horizon(levels: DataFrame, horizon: int, prediction: Column) -> DataFrame:
    """One row per forecast day, generated inside each series row."""
    return (
        levels.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("date", F.date_add("as_of", F.col("horizon")))
        .withColumn("prediction", prediction)
        .select(*OUTPUT)
    )


def seasonal_naive(history: DataFrame, origins: list[date], horizon: int = 28, lag_days: int = 28) -> DataFrame:
    """The sales of `lag_days` earlier, for the first `min(horizon, lag_days)` days."""
    target = F.date_add("date", lag_days)
    return (
        _within(history, origins, lag_days)
        .select(
            "id", "as_of", target.alias("date"), F.datediff(target, "as_of").alias("horizon"),
            F.col("sales").cast("double").alias("prediction"),
        )
        .filter(F.col("horizon").between(1, horizon))
    )


def moving_average(history: DataFrame, origins: list[date], horizon: int = 28, window: int = 28) -> DataFrame:
    """Mean of the last `window` days, the same for every forecast day."""
    levels = _within(history, origins, window).groupBy("id", "as_of").agg(F.avg("sales").alias("level"))
    return _over_horizon(levels, horizon, F.coalesce("level", F.lit(0.0)))


def dow_mean(
    history: DataFrame, origins: list[date], horizon: int = 28, n_weeks: int = 8, lookback: int = LOOKBACK_DAYS
) -> DataFrame:
    """Mean of the same weekday over `n_weeks` weeks, 0 where that weekday has no fact.

    Seven conditional means per series in one aggregation; the weekday of each forecast
    day then picks its own, so there is no join back to a grid.
    """
    recent = F.col("date") > F.date_sub("as_of", n_weeks * 7)
    weekday = F.weekday("date")
    means = F.array(*[F.avg(F.when(recent & (weekday == k), F.col("sales"))) for k in range(7)])
    levels = _within(history, origins, lookback).groupBy("id", "as_of").agg(means.alias("levels"))
    picked = F.element_at("levels", F.weekday(F.date_add("as_of", F.col("horizon"))) + 1)
    return _over_horizon(levels, horizon, F.coalesce(picked, F.lit(0.0)))


BASELINES = {"seasonal_naive": seasonal_naive, "moving_average": moving_average, "dow_mean": dow_mean}


def all_baselines(history: DataFrame, origins: list[date], horizon: int = 28) -> DataFrame:
    """All baselines for all origins, told apart by `baseline`."""
    parts = [
        make(history, origins, horizon).withColumn("baseline", F.lit(name)) for name, make in BASELINES.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
