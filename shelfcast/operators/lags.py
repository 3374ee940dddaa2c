"""Lagged and rolling demand features.

Every feature of a day reads days at least `min_lag` earlier. With `min_lag` equal to the horizon the same
columns are valid for training and for all 28 forecast days; smaller values serve direct forecasts of the
nearer days only. Offsets count rows, which equal days because the panel is dense after the first sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio, series_window
from shelfcast.functions.rolling import MovingFrames, mean_of_known

HORIZON = 28


def lag_days(min_lag: int = HORIZON) -> list[int]:
    """Four lags on the weekday of the shortest one, and the year before."""
    return [min_lag, min_lag + 7, min_lag + 14, min_lag + 28, 364]


def add_lags(panel: DataFrame, min_lag: int = HORIZON) -> DataFrame:
    if min_lag < 1:
        raise ValueError(f"min_lag must be positive, got {min_lag}")
    window = series_window()
    days = lag_days(min_lag)
    first, second, third, fourth, _ = [F.col(f"sales_lag_{n}") for n in days]
    return panel.withColumns(
        {f"sales_lag_{n}": F.lag("sales", n).over(window) for n in days}
    ).withColumns(
        {
            f"sales_diff_{days[0]}_{days[1]}": first - second,
            f"sales_diff_{days[0]}_{days[3]}": first - fourth,
            "sales_same_dow_mean_3w": (first + second + third).cast("double") / F.lit(3.0),
        }
    )


def lag_columns(min_lag: int = HORIZON) -> list[str]:
    days = lag_days(min_lag)
    return [
        *[f"sales_lag_{n}" for n in days],
        f"sales_diff_{days[0]}_{days[1]}", f"sales_diff_{days[0]}_{days[3]}", "sales_same_dow_mean_3w",
    ]


ROLLING_COLUMNS = (
    "roll_mean_7", "roll_std_7", "roll_max_7", "roll_mean_28", "roll_std_28", "roll_max_28",
    "roll_mean_180", "roll_std_180", "zero_ratio_28", "zero_ratio_180", "nonzero_days_28",
    "dow_mean_8w", "trend_28_over_180",
)


def add_rolling(panel: DataFrame, min_lag: int = HORIZON) -> DataFrame:
    """Statistics of the 7, 28 and 180 rows that end `min_lag` rows back, in the window of the lags."""
    window = series_window()
    frames = MovingFrames("sales", window, min_lag, (7, 28, 180))
    weeks_back = -(-min_lag // 7)
    same_weekday = {f"_week_{k}": F.lag("sales", 7 * (weeks_back + k)).over(window) for k in range(8)}
    maxima = {f"roll_max_{n}": frames.max(n) for n in (7, 28)}
    return (
        frames.with_edges(panel.withColumns({**same_weekday, **maxima}))
        .withColumns({
            **{f"roll_mean_{n}": frames.mean(n) for n in (7, 28, 180)},
            **{f"roll_std_{n}": frames.std(n) for n in (7, 28, 180)},
            **{f"zero_ratio_{n}": frames.zero_share(n) for n in (28, 180)},
            "nonzero_days_28": frames.selling_rows(28),
            "dow_mean_8w": mean_of_known([F.col(c).cast("long") for c in same_weekday]),
        })
        .withColumn("trend_28_over_180", ratio(F.col("roll_mean_28"), F.col("roll_mean_180")))
        .select(*panel.columns, *ROLLING_COLUMNS)
    )


def daily_totals(panel: DataFrame, by: list[str]) -> DataFrame:
    """Sales per group and day, combined map-side; NULL on days without any known fact."""
    return panel.groupBy(*by, "date").agg(F.sum("sales").alias("sales"))


def group_rolling(panel: DataFrame, min_lag: int = HORIZON) -> DataFrame:
    """28-day means of department and category sales per store, ending `min_lag` days back.

    The category window runs over the category's own days. (Taken after a join to departments it would see each
    day once per department, which shortens both the window and the protective shift.)
    """

    def rolled(totals: DataFrame, by: list[str], name: str) -> DataFrame:
        # a narrow table and a narrow frame: no running sums needed
        days = Window.partitionBy(*by).orderBy("date").rowsBetween(-(min_lag + 27), -min_lag)
        return totals.select(*by, "date", F.avg("sales").over(days).alias(name))

    departments = daily_totals(panel, ["store_id", "cat_id", "dept_id"])
    categories = departments.groupBy("store_id", "cat_id", "date").agg(F.sum("sales").alias("sales"))
    return rolled(departments, ["store_id", "cat_id", "dept_id"], "dept_roll_mean_28").join(
        rolled(categories, ["store_id", "cat_id"], "cat_roll_mean_28"), ["store_id", "cat_id", "date"]
    )
