"""Calendar: typed days, flags, event distances and benefit-day flags by state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import distances, flag

SNAP_PREFIX = "snap_"


def stage_calendar(raw: DataFrame) -> DataFrame:
    """One row per day. `wday` counts from 1 = Saturday; `dayofweek` from 0 = Sunday."""
    day = F.to_date("date")
    event_1, event_2 = F.nullif("event_name_1", F.lit("")), F.nullif("event_name_2", F.lit(""))
    return raw.select(
        day.alias("date"),
        "d",
        F.regexp_replace("d", "^d_", "").cast("int").alias("day_index"),
        "wm_yr_wk",
        "wday",
        "weekday",
        "month",
        "year",
        (F.dayofweek(day) - 1).alias("dayofweek"),
        F.dayofmonth(day).alias("dayofmonth"),
        F.weekofyear(day).alias("weekofyear"),
        F.dayofyear(day).alias("dayofyear"),
        F.quarter(day).alias("quarter"),
        flag(F.col("wday").isin(1, 2)).alias("is_weekend"),
        flag(F.dayofmonth(day) <= 7).alias("is_month_start"),
        flag(F.dayofmonth(day) >= 24).alias("is_month_end"),
        event_1.alias("event_name_1"),
        F.nullif("event_type_1", F.lit("")).alias("event_type_1"),
        event_2.alias("event_name_2"),
        F.nullif("event_type_2", F.lit("")).alias("event_type_2"),
        flag(event_1.isNotNull() | event_2.isNotNull()).alias("has_event"),
        *[F.col(f"`{c}`") for c in raw.columns if c.startswith(SNAP_PREFIX)],
    )


def snap_by_state(calendar: DataFrame) -> DataFrame:
    """(date, state_id, snap) from one flag column per state, in one scan."""
    flags = [c for c in calendar.columns if c.startswith(SNAP_PREFIX)]
    pairs = F.array(
        *[F.struct(F.lit(c[len(SNAP_PREFIX):]).alias("state_id"), F.col(f"`{c}`").alias("snap")) for c in flags]
    )
    return calendar.select("date", F.inline(pairs))


def with_event_distances(calendar: DataFrame) -> DataFrame:
    """Days to the next and since the previous event, 0 on an event day.

    The window has no partition key: it runs over the calendar only, which has one row per day.
    """
    ahead, behind = distances(F.col("date"), F.col("has_event") == 1)
    return calendar.withColumns({"days_to_next_event": ahead, "days_since_prev_event": behind})


def day_index_to_date(origin: date, day_index: Column) -> Column:
    """Day 1 is the origin."""
    return F.date_add(F.lit(origin), day_index.cast("int") - 1)


def date_to_day_index(origin: date, day: Column) -> Column:
    return F.datediff(day, F.lit(origin)) + 1


def week_of(first_day: date, day: Column, first_week: int) -> Column:
    """Number of the seven-day week of a day; weeks are counted from the first day."""
    return F.lit(first_week) + F.floor(F.datediff(day, F.lit(first_day)) / 7).cast("int")
