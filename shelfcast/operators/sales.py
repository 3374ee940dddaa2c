"""Sales: wide to long, series attributes, first sale, the dense series-by-day panel and its attributes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import SERIES, by_series, flag

SERIES_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
CALENDAR_COLUMNS = (
    "wm_yr_wk", "dayofweek", "dayofmonth", "weekofyear", "dayofyear", "month", "year", "quarter",
    "is_weekend", "is_month_start", "is_month_end",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2", "has_event",
    "days_to_next_event", "days_since_prev_event",
)
PRICE_COLUMNS = (
    "sell_price", "price_change_1w", "price_momentum_4w", "is_price_drop",
    "price_rel_own_mean", "price_rel_own_max", "price_std_item_store", "price_nunique_item",
)
RELATIVE_PRICE_COLUMNS = ("price_rel_item_mean", "price_rel_dept_mean", "price_rel_cat_mean")


def unpivot_days(wide: DataFrame, id_columns=SERIES_COLUMNS) -> DataFrame:
    """(id, d, sales) from one column per day; empty cells are dropped.

    One array per row and one generator, so the plan does not grow with the number of day columns
    and nothing is shuffled.
    """
    days = [c for c in wide.columns if c not in id_columns]
    names = F.array(*[F.lit(c) for c in days])
    cells = wide.select("id", F.posexplode(F.array(*[F.col(f"`{c}`") for c in days])).alias("pos", "sales"))
    return cells.filter(F.col("sales").isNotNull()).select(
        "id", F.element_at(names, F.col("pos") + 1).alias("d"), "sales"
    )


def sales_long(wide: DataFrame, calendar: DataFrame) -> DataFrame:
    """Unpivoted cells with their date. The calendar is small enough for Spark to broadcast it by size."""
    return (
        unpivot_days(wide)
        .join(calendar.select("d", "date", "day_index"), "d")
        .select("id", "day_index", "date", F.col("sales").cast("int").alias("sales"))
    )


def hierarchy(df: DataFrame) -> DataFrame:
    return df.select(*SERIES_COLUMNS).distinct()


def sale_span() -> list[Column]:
    """Aggregates of `sales` by series: first and last selling day and their number."""
    sold = F.when(F.col("sales") > 0, F.col("date"))
    return [
        F.min(sold).alias("first_sale_date"),
        F.max(sold).alias("last_sale_date"),
        F.count(sold).alias("n_nonzero_days"),
    ]


def first_sale(sales: DataFrame, by=("id",)) -> DataFrame:
    """Selling span per series. Series without a positive sale are kept with NULL dates."""
    return sales.groupBy(*by).agg(*sale_span())


def history_start(last_fact: date, origin: date, keep_last_days: int | None) -> date:
    """First day of the panel: `keep_last_days` before the last fact, not before the origin."""
    if keep_last_days is None:
        return origin
    return max(origin, last_fact - timedelta(days=keep_last_days))


def series_day_grid(series: DataFrame, start: date, end: date, from_first_sale: bool = False) -> DataFrame:
    """Every series on every day from `start` to `end`.

    The days are generated inside each series row, so there is no cross join and the rows keep the
    partitioning of `series`. With `from_first_sale` the days before it are never generated;
    a series that was never sold keeps all days.
    """
    first = F.lit(start)
    if from_first_sale:
        first = F.greatest(first, F.coalesce("first_sale_date", F.lit(start)))
    # `sequence` counts downwards when its ends are reversed, so guard the empty case
    days = F.when(first <= F.lit(end), F.sequence(first, F.lit(end), F.expr("interval 1 day")))
    return series.withColumn("date", F.explode(days))


def dense_panel(
    series: DataFrame, sales: DataFrame, start: date, end: date, known_until: date, partitions: int | None = None
) -> DataFrame:
    """Series x day panel: observed sales, 0 on quiet days up to `known_until`, NULL after it.

    `series` needs the series columns and `first_sale_date`. Both inputs are hashed by series before the
    days are generated: only the sparse sales and the series list cross the network, never the panel,
    and every later window by series finds its rows in place. Rows per series are bounded by the calendar;
    `partitions` should be sized by the rows of the panel.
    """
    grid = series_day_grid(by_series(series, partitions), start, end, from_first_sale=True)
    observed = by_series(
        sales.filter(F.col("date").between(F.lit(start), F.lit(known_until))).select(*SERIES, "date", "sales"),
        partitions,
    )
    return (
        grid.join(observed, [*SERIES, "date"], "left")
        .withColumn("sales", F.when(F.col("date") <= F.lit(known_until), F.coalesce("sales", F.lit(0))))
        .withColumn("days_since_first_sale", F.datediff("date", "first_sale_date"))
    )


def with_price_columns(panel: DataFrame, days: DataFrame, prices: DataFrame) -> DataFrame:
    """Week of each day and the weekly prices of that week; a week without a price leaves NULLs.

    The prices come hashed by series, as the panel does, so the join needs no shuffle of the panel.
    """
    key = [*SERIES, "wm_yr_wk"]
    weekly = prices.select(*key, *PRICE_COLUMNS, *RELATIVE_PRICE_COLUMNS)
    return (
        panel.join(days.select("date", "wm_yr_wk"), "date", "left")
        .join(weekly, key, "left")
        .withColumn("is_out_of_assortment", flag(F.col("sell_price").isNull()))
    )


def with_calendar_columns(panel: DataFrame, days: DataFrame, snap: DataFrame) -> DataFrame:
    """Day attributes (`days` is the calendar with event distances) and the benefit-day flag of the state.

    Both tables are as long as the calendar; Spark knows their size and broadcasts them by it.
    """
    columns = [c for c in CALENDAR_COLUMNS if c not in panel.columns]
    return panel.join(days.select("date", "day_index", *columns), "date").join(
        snap, ["date", "state_id"], "left"
    )


def sales_enriched(panel: DataFrame, days: DataFrame, snap: DataFrame, prices: DataFrame) -> DataFrame:
    """The panel with its calendar, event, benefit-day and price attributes."""
    return with_calendar_columns(with_price_columns(panel, days, prices), days, snap)
