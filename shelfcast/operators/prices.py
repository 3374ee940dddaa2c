"""Weekly prices: change, momentum and position against own history and against peers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import SERIES, flag, ratio


def stage_prices(raw: DataFrame, as_of_safe: bool = False) -> DataFrame:
    """Price features per (store, item, week).

    Lags count priced weeks, not calendar weeks. By default the own-history statistics span all weeks, also later
    ones; `as_of_safe` limits them to the weeks up to the row's own. All windows share one shuffle by
    (store, item), where a group has one row per week.
    """
    history = Window.partitionBy(*SERIES).orderBy("wm_yr_wk")
    span = history.rowsBetween(
        Window.unboundedPreceding, Window.currentRow if as_of_safe else Window.unboundedFollowing
    )
    price = F.col("sell_price")
    src = raw.select(*SERIES, "wm_yr_wk", price.cast("double").alias("sell_price"))
    # a price is counted at the first week it occurs in; the sum of those marks is a distinct count,
    # which Spark does not offer as a window aggregate
    first_week_of_price = Window.partitionBy(*SERIES, "sell_price").orderBy("wm_yr_wk")
    return (
        src.withColumns({
            "_prev": F.lag(price, 1).over(history),
            "_back4": F.lag(price, 4).over(history),
            "first_price_week": F.min("wm_yr_wk").over(span),
            "_mean": F.avg(price).over(span),
            "price_std_item_store": F.stddev_pop(price).over(span),
            "_max": F.max(price).over(span),
            "_new": flag(F.lag(price, 1).over(first_week_of_price).isNull()),
        })
        .withColumn("price_nunique_item", F.sum("_new").over(span))
        .select(
            *SERIES,
            "wm_yr_wk",
            "sell_price",
            (ratio(price, F.col("_prev")) - 1).alias("price_change_1w"),
            (ratio(price, F.col("_back4")) - 1).alias("price_momentum_4w"),
            flag(price < F.col("_prev")).alias("is_price_drop"),
            ratio(price, F.col("_mean")).alias("price_rel_own_mean"),
            ratio(price, F.col("_max")).alias("price_rel_own_max"),
            "price_std_item_store",
            "price_nunique_item",
            "first_price_week",
        )
    )


def peer_means(prices: DataFrame, peer: str) -> DataFrame:
    """Mean price per week and peer group, combined map-side: a group may hold most of a week's rows."""
    return prices.groupBy("wm_yr_wk", peer).agg(F.avg("sell_price").alias(f"_{peer}_mean"))


def with_relative_prices(prices: DataFrame, items: DataFrame, stage_all) -> DataFrame:
    """Price against the mean of its department, category and of the same item elsewhere, same week.

    Adds three columns to any weekly price table. `stage_all` writes tables to the shared folder and reads
    them back. The peer means are a small fraction of the prices; once written, Spark sees their true size and
    broadcasts them below its threshold, and falls back to a sort-merge join above it. A window over a week
    and category would instead put an unbounded group into one task.
    """
    attributes = items.select("item_id", "dept_id", "cat_id").distinct()
    keyed = prices.join(attributes, "item_id")
    peers = ("dept_id", "cat_id", "item_id")
    means = stage_all({p: peer_means(keyed, p) for p in peers})
    result = keyed
    for peer in peers:
        result = result.join(means[peer], ["wm_yr_wk", peer]).withColumn(
            f"price_rel_{peer.removesuffix('_id')}_mean", ratio(F.col("sell_price"), F.col(f"_{peer}_mean"))
        )
    return result.drop("dept_id", "cat_id", *[f"_{p}_mean" for p in peers])
