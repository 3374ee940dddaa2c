"""Read-side queries over forecasts, facts and scores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import metrics as m


def forecast_for_pair(forecast: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """The newest forecast of one item in one store. The pair's filter runs before the ranking of origins."""
    pair = forecast.filter((F.col("item_id") == item_id) & (F.col("store_id") == store_id))
    newest = pair.withColumn("_last", F.max("as_of").over(Window.partitionBy("id")))
    return newest.filter(F.col("as_of") == F.col("_last")).select(
        "item_id", "store_id", "as_of", "date", "horizon", "prediction", "model_version"
    )


def as_points(forecast: DataFrame) -> DataFrame:
    """One row per pair with its points in order; at most `horizon` points each."""
    points = F.sort_array(F.collect_list(F.struct("horizon", "date", "prediction")))
    return forecast.groupBy("item_id", "store_id", "as_of", "model_version").agg(points.alias("points"))


def forecast_for_store(forecast: DataFrame, store_id: str, as_of: date, start: date, end: date) -> DataFrame:
    return (
        forecast.filter(
            (F.col("store_id") == store_id) & (F.col("as_of") == F.lit(as_of))
            & F.col("date").between(F.lit(start), F.lit(end))
        )
        .select("item_id", "store_id", "date", "horizon", "prediction")
        .orderBy("item_id", "date")
    )


def forecast_health(forecast: DataFrame, today: date, max_lag_days: int = 2) -> DataFrame:
    """Version and age of the newest forecast."""
    return forecast.agg(
        F.max("as_of").alias("as_of"), F.max_by("model_version", "as_of").alias("model_version")
    ).withColumn("lag_days", F.datediff(F.lit(today), "as_of")).withColumn(
        "status", F.when(F.col("lag_days") <= max_lag_days, "ok").otherwise("degraded")
    )


def overview_tiles(forecast: DataFrame, actual: DataFrame, window_days: int = 28) -> DataFrame:
    """Newest origin, WMAPE and bias of the last `window_days` known days, change of WMAPE to the window before."""
    scored = forecast.join(actual.select("id", "date", "sales"), ["id", "date"])
    last = scored.agg(F.max("date").alias("_last")).withColumn("_one", F.lit(1))
    bucket = F.floor(F.datediff("_last", "date") / window_days)
    periods = (
        scored.withColumn("_one", F.lit(1)).join(F.broadcast(last), "_one")
        .withColumn("_bucket", bucket)
        .filter(F.col("_bucket") <= 1)
        .groupBy("_bucket")
        .agg(m.wmape().alias("wmape"), m.bias().alias("bias"), F.max("as_of").alias("as_of"))
    )
    # two rows
    previous = F.lead("wmape").over(Window.orderBy("_bucket"))
    return (
        periods.withColumn("wmape_delta", F.col("wmape") - previous)
        .filter(F.col("_bucket") == 0)
        .select("as_of", F.col("wmape").alias("wmape_28d"), "wmape_delta", F.col("bias").alias("bias_28d"))
    )


def forecast_explorer(actual: DataFrame, forecast: DataFrame, series_id: str, as_of: date, days: int = 90) -> DataFrame:
    """The last facts of a series followed by its forecast."""
    facts = actual.filter(
        (F.col("id") == series_id) & F.col("date").between(F.date_sub(F.lit(as_of), days - 1), F.lit(as_of))
    ).select("id", "date", F.col("sales").cast("double").alias("value"), F.lit("fact").alias("kind"))
    ahead = forecast.filter((F.col("id") == series_id) & (F.col("as_of") == F.lit(as_of))).select(
        "id", "date", F.col("prediction").alias("value"), F.lit("forecast").alias("kind")
    )
    return facts.unionByName(ahead)


def forecast_coverage(forecast: DataFrame) -> DataFrame:
    """Rows, series and days of each origin. Ids are grouped first, so they are never a set in one task."""
    by_id = forecast.groupBy("as_of", "id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.min("model_version").alias("model_version"),
    )
    return by_id.groupBy("as_of").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_series"), F.min("first").alias("min_date"),
        F.max("last").alias("max_date"), F.min("model_version").alias("model_version"),
    )


def store_day_forecast(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("as_of", "store_id", "date").agg(F.sum("prediction").alias("units"))


def top_series(forecast: DataFrame, n: int = 1) -> DataFrame:
    """Series with the largest forecast total."""
    return (
        forecast.groupBy("id").agg(F.sum("prediction").alias("total")).orderBy(F.desc("total"), "id").limit(n)
    )


def recent_history(panel: DataFrame, series_id: str, n: int = 70) -> DataFrame:
    """The last `n` known days of a series, oldest first."""
    return (
        panel.filter((F.col("id") == series_id) & F.col("sales").isNotNull())
        .select("id", "date", "sales")
        .orderBy(F.desc("date"))
        .limit(n)
        .orderBy("date")
    )


def store_head(forecast: DataFrame, store_id: str, n: int = 40) -> DataFrame:
    """First `n` forecast rows of a store by day and item."""
    return (
        forecast.filter(F.col("store_id") == store_id)
        .select("item_id", "store_id", "date", "prediction")
        .orderBy("date", "item_id")
        .limit(n)
    )
