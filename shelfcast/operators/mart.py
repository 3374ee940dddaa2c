"""The feature mart: one computation for training and inference.

The modes differ in the last day only. In inference the days after `as_of` are kept without a target,
whatever the panel knows about them, so any past origin can be replayed.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import holidays as holiday_ops
from shelfcast.operators import lags as lag_ops
from shelfcast.operators import sales as sales_ops
from shelfcast.operators import weather as weather_ops

KEYS = ("id", "date", "item_id", "dept_id", "cat_id", "store_id", "state_id")
GROUP_ROLLING = ("dept_roll_mean_28", "cat_roll_mean_28")
NOT_FEATURES = ("id", "date", "sales", "weather_source", "days_since_first_sale", "store_id")
CATEGORICAL = (
    "item_id", "dept_id", "cat_id", "state_id", "event_name_1", "event_type_1", "event_name_2",
    "event_type_2", "holiday_name", "holiday_type",
)


def last_day(as_of: date, mode: str, horizon: int = lag_ops.HORIZON) -> date:
    if mode not in ("train", "inference"):
        raise ValueError(f"mode must be 'train' or 'inference', got {mode!r}")
    return as_of if mode == "train" else as_of + timedelta(days=horizon)


def empty_weather(spark) -> DataFrame:
    """Typed empty input, so that a missing source leaves the mart's columns in place, as NULLs."""
    return spark.createDataFrame([], weather_ops.SCHEMA)


def mart_columns(min_lag: int = lag_ops.HORIZON) -> list[str]:
    calendar = [c for c in sales_ops.CALENDAR_COLUMNS if c not in ("wm_yr_wk", "has_event")]
    return [
        *KEYS, "sales", *lag_ops.lag_columns(min_lag), *lag_ops.ROLLING_COLUMNS, *GROUP_ROLLING,
        *calendar, "snap", *sales_ops.PRICE_COLUMNS, *sales_ops.RELATIVE_PRICE_COLUMNS,
        *weather_ops.FEATURES, *holiday_ops.FEATURES, "days_since_first_sale", "is_out_of_assortment",
    ]


def build_mart(
    panel: DataFrame,
    days: DataFrame,
    snap: DataFrame,
    prices: DataFrame,
    weather: DataFrame | None,
    holidays: DataFrame | None,
    as_of: date,
    mode: str = "train",
    horizon: int = lag_ops.HORIZON,
    stores: list[str] | None = None,
    min_lag: int = lag_ops.HORIZON,
    *,
    stage_all,
) -> DataFrame:
    """Feature rows up to `as_of` (train) or `as_of + horizon` (inference).

    `panel` is the dense panel hashed by series. Windows run on its narrow rows; the wide day, price, weather
    and holiday attributes are joined afterwards and never sorted or shuffled. Lags and rolling statistics are
    columns of the same pass, so no self join is needed. `weather` and `holidays` are feature tables by
    (state, date); None leaves their columns NULL. `stage_all` writes the three side tables to the shared folder
    first: with their true size known, Spark broadcasts them if they are small and otherwise hashes both
    sides by all join keys, never the panel by its few states.
    """
    end = F.lit(last_day(as_of, mode, horizon))
    known = F.when(F.col("date") <= F.lit(as_of), F.col("sales"))
    rows = panel.filter(F.col("date") <= end).withColumn("sales", known)
    if stores:
        # group totals are by store, too
        rows = rows.filter(F.col("store_id").isin(*stores))
    spark = panel.sparkSession
    if weather is None:
        weather = weather_ops.weather_features(empty_weather(spark))
    if holidays is None:
        holidays = _empty_holiday_features(spark)
    side = stage_all({
        "groups": lag_ops.group_rolling(rows, min_lag).select("store_id", "dept_id", "date", *GROUP_ROLLING),
        "weather": weather.select("state_id", "date", *weather_ops.FEATURES),
        "holidays": holidays.select("state_id", "date", *holiday_ops.FEATURES),
    })
    features = lag_ops.add_rolling(lag_ops.add_lags(rows, min_lag), min_lag)
    # a series never sold has no first sale and drops out here
    features = features.filter(F.col("days_since_first_sale") >= 0)
    features = sales_ops.sales_enriched(features, days, snap, prices)
    return (
        features.join(side["groups"], ["store_id", "dept_id", "date"], "left")
        .join(side["weather"], ["state_id", "date"], "left")
        .join(side["holidays"], ["state_id", "date"], "left")
        .select(*mart_columns(min_lag))
    )


def _empty_holiday_features(spark) -> DataFrame:
    typed = {
        "is_holiday": "int", "is_public_holiday": "boolean", "holiday_name": "string", "holiday_type": "string",
    }
    fields = [f"{c} {typed.get(c, 'int')}" for c in holiday_ops.FEATURES]
    return spark.createDataFrame([], ", ".join(["state_id string", "date date", *fields]))


def feature_columns(mart: DataFrame) -> list[str]:
    """Model inputs in the mart's own order, so that training and prediction cannot disagree on it."""
    return [c for c in mart.columns if c not in NOT_FEATURES]


def assortment_features(prices: DataFrame, days: DataFrame) -> DataFrame:
    """Weekly price against the store's mean of the week, and the day its series got its first price."""
    means = prices.groupBy("store_id", "wm_yr_wk").agg(F.avg("sell_price").alias("_mean"))
    weeks = days.groupBy(F.col("wm_yr_wk").alias("first_price_week")).agg(F.min("date").alias("first_price_date"))
    return (
        prices.join(means, ["store_id", "wm_yr_wk"])
        .join(weeks, "first_price_week")
        .select(
            "store_id", "item_id", "wm_yr_wk",
            (F.col("sell_price") / F.nullif("_mean", F.lit(0.0))).alias("price_rel_store_mean"),
            "first_price_date",
        )
    )


def with_assortment_features(panel: DataFrame, prices: DataFrame, days: DataFrame) -> DataFrame:
    """Price relative to the store and days since the first price; `panel` carries `wm_yr_wk`."""
    weekly = assortment_features(prices, days)
    return (
        panel.join(weekly, ["store_id", "item_id", "wm_yr_wk"], "left")
        .withColumn("days_since_first_price", F.datediff("date", "first_price_date"))
        .drop("first_price_date")
    )
