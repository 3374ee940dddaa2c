"""Public-holiday features by state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import distances, flag

FEATURES = (
    "is_holiday", "is_public_holiday", "holiday_name", "holiday_type", "days_to_next_holiday",
    "days_since_prev_holiday", "is_day_before_holiday", "is_day_after_holiday", "is_pre_holiday_week",
    "is_holiday_window",
)
SCHEMA = (
    "date date, country_code string, subdivision string, holiday_name string, holiday_type string, "
    "is_public_holiday boolean, state_id string"
)


def one_per_state_day(holidays: DataFrame) -> DataFrame:
    """Holidays that share a day in a state collapse to one row (the first name), public if any is."""
    return holidays.groupBy("state_id", "date").agg(
        F.min("holiday_name").alias("holiday_name"),
        F.min_by("holiday_type", "holiday_name").alias("holiday_type"),
        F.bool_or("is_public_holiday").alias("is_public_holiday"),
    )


def holiday_features(holidays: DataFrame, states: DataFrame, start: date, end: date) -> DataFrame:
    """One row per state and day with the distances to the nearest holidays of that state.

    `states` has a `state_id` column. Days are generated inside each state row and the nearest holidays come
    from two running aggregates over the state's days.
    """
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
    grid = states.select("state_id").distinct().select("state_id", days.alias("date"))
    named = grid.join(one_per_state_day(holidays), ["state_id", "date"], "left")
    ahead, behind = distances(F.col("date"), F.col("holiday_name").isNotNull(), by=["state_id"])
    before, since = F.col("days_to_next_holiday"), F.col("days_since_prev_holiday")
    return (
        named.withColumn("days_to_next_holiday", ahead)
        .withColumn("days_since_prev_holiday", behind)
        .select(
            "date", "state_id",
            flag(F.col("holiday_name").isNotNull()).alias("is_holiday"),
            F.coalesce("is_public_holiday", F.lit(False)).alias("is_public_holiday"),
            F.coalesce("holiday_name", F.lit("none")).alias("holiday_name"),
            F.coalesce("holiday_type", F.lit("none")).alias("holiday_type"),
            before.alias("days_to_next_holiday"),
            since.alias("days_since_prev_holiday"),
            flag(before == 1).alias("is_day_before_holiday"),
            flag(since == 1).alias("is_day_after_holiday"),
            flag(before <= 3).alias("is_pre_holiday_week"),
            flag((before <= 3) | (since <= 3)).alias("is_holiday_window"),
        )
    )


def with_long_weekend(features: DataFrame) -> DataFrame:
    """Flag the three days of a weekend that a Friday or Monday holiday makes longer."""
    days = Window.partitionBy("state_id").orderBy("date")
    weekday, holiday = F.weekday("date"), F.col("is_holiday")  # 0 = Monday
    friday = (
        F.when(weekday == 4, holiday).when(weekday == 5, F.lag(holiday, 1).over(days))
        .when(weekday == 6, F.lag(holiday, 2).over(days))
    )
    monday = (
        F.when(weekday == 0, holiday).when(weekday == 6, F.lead(holiday, 1).over(days))
        .when(weekday == 5, F.lead(holiday, 2).over(days))
    )
    return features.withColumn("is_long_weekend", flag((friday == 1) | (monday == 1)))


def compare_events(holidays: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days named by the holiday source, by the calendar's own events, or by both."""
    left = holidays.groupBy("date").agg(F.min("holiday_name").alias("holiday_name"))
    right = calendar.filter(F.col("has_event") == 1).select("date", "event_name_1")
    return left.join(right, "date", "full").select(
        "date", "holiday_name", "event_name_1",
        F.when(F.col("holiday_name").isNull(), "only_calendar")
        .when(F.col("event_name_1").isNull(), "only_holidays")
        .otherwise("both")
        .alias("found_in"),
    )
