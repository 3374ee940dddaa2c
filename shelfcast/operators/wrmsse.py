"""Weighted root mean squared scaled error over twelve aggregation levels."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio
from shelfcast.functions.metrics import rmsse

# The twelve levels.
LEVELS = {
    1: (),
    2: ("state_id",),
    3: ("store_id",),
    4: ("cat_id",),
    5: ("dept_id",),
    6: ("state_id", "cat_id"),
    7: ("state_id", "dept_id"),
    8: ("store_id", "cat_id"),
    9: ("store_id", "dept_id"),
    10: ("item_id",),
    11: ("item_id", "state_id"),
    12: ("item_id", "store_id"),
}
Stage = Callable[[DataFrame, str], DataFrame]
_STORE_SIDE = ("state_id", "store_id", "cat_id", "dept_id")


def roll_up(rows: DataFrame, measures: list[str], extra=("date",), stage: Stage = lambda df, name: df) -> DataFrame:
    """Sums of the measures at all levels: (level, key, *extra, *measures).

    Grouping sets over twelve levels would copy every row twelve times. Sums can be built from finer
    sums instead: the rows themselves are level 12, they are aggregated once by item and state and once by store
    and department, and the other levels come from those two much smaller results. `rows` must be
    unique by item, store and `extra`, and are read three times; `stage` stores the one result that has two readers.
    """
    sums = [F.sum(c).alias(c) for c in measures]

    def labelled(df: DataFrame, level: int) -> DataFrame:
        return df.select(
            F.lit(level).alias("level"), F.concat_ws("|", *LEVELS[level]).alias("key"), *extra, *measures
        )

    by_item_state = stage(rows.groupBy("item_id", "state_id", *extra).agg(*sums), "by_item_state")
    by_item = by_item_state.groupBy("item_id", *extra).agg(*sums)
    by_store_dept = rows.groupBy(*_STORE_SIDE, *extra).agg(*sums)

    store_levels = {n: cols for n, cols in LEVELS.items() if set(cols) <= set(_STORE_SIDE)}
    level = F.lit(None).cast("int")
    for n, cols in store_levels.items():
        grouped_out = sum(1 << (len(_STORE_SIDE) + len(extra) - 1 - i)
                          for i, c in enumerate(_STORE_SIDE) if c not in cols)
        level = F.when(F.grouping_id(*_STORE_SIDE, *extra) == grouped_out, n).otherwise(level)
    sets = [[F.col(c) for c in (*cols, *extra)] for cols in store_levels.values()]
    store_side = (
        by_store_dept.groupingSets(sets, *_STORE_SIDE, *extra)
        .agg(level.alias("level"), *sums)
        # columns grouped out are NULL and skipped by concat_ws
        .select("level", F.concat_ws("|", *_STORE_SIDE).alias("key"), *extra, *measures)
    )
    return (
        labelled(rows, 12)
        .unionByName(labelled(by_item_state, 11))
        .unionByName(labelled(by_item, 10))
        .unionByName(store_side)
    )


#: What is kept of an aggregated series: enough to go on from its last selling day without the days before.
STATE = ("first_date", "first_value", "last_date", "last_value", "sum_sq")


def scale_states(sold: DataFrame, stage: Stage) -> DataFrame:
    """State of every aggregated series from sparse sales; days without a row count as zero.

    Between two selling days that follow each other lies one step; otherwise a fall to zero and a rise from it. So the
    quiet days, most of the panel, are never generated.
    """
    daily = roll_up(sold.filter(F.col("sales") > 0), ["sales"], stage=stage)
    days = Window.partitionBy("level", "key").orderBy("date")
    value = F.col("sales").cast("double")
    before, before_date = F.lag(value).over(days), F.lag("date").over(days)
    step = F.when(F.datediff("date", before_date) == 1, (value - before) * (value - before)).otherwise(
        value * value + before * before
    )
    return (
        daily.select("level", "key", "date", value.alias("v"), F.coalesce(step, F.lit(0.0)).alias("step"))
        .groupBy("level", "key").agg(
            F.min("date").alias("first_date"), F.min_by("v", "date").alias("first_value"), F.max("date").alias("last_date"),
            F.max_by("v", "date").alias("last_value"), F.sum("step").alias("sum_sq"),
        )
    )


def join_states(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """States of two spans of days as one; all days of `later` come after those of `earlier`."""
    a, b = ({c: F.col(f"{side}.{c}") for c in STATE} for side in ("a", "b"))
    gap = F.when(
        F.datediff(b["first_date"], a["last_date"]) == 1,
        (b["first_value"] - a["last_value"]) * (b["first_value"] - a["last_value"]),
    ).otherwise(b["first_value"] * b["first_value"] + a["last_value"] * a["last_value"])
    joined = earlier.select("level", "key", F.struct(*STATE).alias("a")).join(
        later.select("level", "key", F.struct(*STATE).alias("b")), ["level", "key"], "full"
    )
    return joined.select(
        "level", "key",
        *[F.coalesce(a[c], b[c]).alias(c) for c in ("first_date", "first_value")],
        *[F.coalesce(b[c], a[c]).alias(c) for c in ("last_date", "last_value")],
        (F.coalesce(a["sum_sq"], F.lit(0.0)) + F.coalesce(b["sum_sq"], F.lit(0.0)) + F.coalesce(gap, F.lit(0.0))).alias("sum_sq"),
    )


def scales_of(states: DataFrame, end: date) -> DataFrame:
    """Mean squared one-day difference up to `end` per aggregated series, from its own first non-zero day on.

    Leading zeros are cut on the aggregated series, not on its items. NULL where no day follows the first one.
    """
    tail = F.when(F.col("last_date") < F.lit(end), F.col("last_value") * F.col("last_value")).otherwise(F.lit(0.0))
    n = F.datediff(F.lit(end), "first_date")
    return states.select("level", "key", ratio(F.col("sum_sq") + tail, n).alias("scale"))


def scales(sold: DataFrame, end: date, stage: Stage) -> DataFrame:
    return scales_of(scale_states(sold, stage), end)


def weights(series: DataFrame, sold: DataFrame, as_of: date, stage: Stage, window_days: int = 28) -> DataFrame:
    """Share of revenue (sales x price) in the last `window_days` days, summing to 1 per level.

    `sold` are sparse sales with `sell_price`; `series` lists all series, those without a sale weigh nothing.
    """
    revenue = (F.col("sales") * F.coalesce("sell_price", F.lit(0.0))).cast("decimal(28,2)")
    recent = (
        sold.filter(F.col("date").between(F.date_sub(F.lit(as_of), window_days - 1), F.lit(as_of)))
        .groupBy("item_id", "store_id").agg(F.sum(revenue).alias("revenue"))
    )
    nothing = F.lit(0).cast("decimal(38,2)")
    rows = series.select("item_id", *_STORE_SIDE).join(recent, ["item_id", "store_id"], "left").withColumn(
        "revenue", F.coalesce("revenue", nothing)
    )
    leveled = stage(roll_up(stage(rows, "revenue"), ["revenue"], (), stage), "revenue_levels")
    totals = leveled.groupBy("level").agg(F.sum("revenue").alias("_total"))
    # twelve rows by construction
    return leveled.join(F.broadcast(totals), "level").select(
        "level", "key", ratio(F.col("revenue"), F.col("_total")).alias("weight")
    )


def scored_levels(matched: DataFrame, stage: Stage) -> DataFrame:
    """Mean squared error per aggregated series from rows with `sales` and `prediction`, which are stored once.

    A fact without a forecast is an error.
    """
    checked = F.when(F.col("prediction").isNotNull(), F.col("prediction")).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("no forecast for"), "item_id", "store_id", F.col("date").cast("string")))
    )
    rows = stage(
        matched.select("item_id", *_STORE_SIDE, "date", "sales", checked.cast("double").alias("prediction")), "matched"
    )
    error = F.col("sales") - F.col("prediction")
    return (
        roll_up(rows, ["sales", "prediction"], stage=stage).groupBy("level", "key").agg(F.avg(error * error).alias("mse"))
    )


def wrmsse_by_series(matched: DataFrame, scale: DataFrame, weight: DataFrame, stage: Stage) -> DataFrame:
    return (
        scored_levels(matched, stage)
        .join(scale, ["level", "key"], "left")
        .join(weight, ["level", "key"], "left")
        .withColumn("rmsse", rmsse(F.col("mse"), F.col("scale")))
    )


def wrmsse_by_level(matched: DataFrame, scale: DataFrame, weight: DataFrame, stage: Stage) -> DataFrame:
    """Weighted error of each level over the series that can be scored.

    A series without a scale (constant in training) has no scaled error. Weighted ones among them are counted with
    their weight, and the other weights are scaled up to one, so that they do not count as perfect forecasts.
    """
    scored = F.col("rmsse").isNotNull()
    share = F.coalesce("weight", F.lit(0.0))
    return (
        wrmsse_by_series(matched, scale, weight, stage)
        .groupBy("level")
        .agg(
            ratio(F.sum(F.when(scored, share * F.col("rmsse"))), F.sum(F.when(scored, share))).alias("wrmsse"),
            F.count_if(~scored & (share > 0)).alias("n_unscored"),
            F.coalesce(F.sum(F.when(~scored, share)), F.lit(0.0)).alias("weight_unscored"),
        )
    )


def wrmsse(matched: DataFrame, scale: DataFrame, weight: DataFrame, stage: Stage) -> DataFrame:
    """One row: the plain mean over the levels."""
    return wrmsse_by_level(matched, scale, weight, stage).agg(F.avg("wrmsse").alias("wrmsse"))
