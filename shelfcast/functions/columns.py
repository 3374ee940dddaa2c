"""Small column helpers. Every one returns an unevaluated Spark column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A series is one item in one store; `id` is only its label. Partitioning by these two
# columns lets the daily panel and the weekly prices share one shuffle.
SERIES = ("store_id", "item_id")


def series_window():
    """Days of one series in order. At most one row per calendar day, so no partition is unbounded."""
    return Window.partitionBy(*SERIES).orderBy("date")


def by_series(df: DataFrame, partitions: int | None) -> DataFrame:
    """Hash rows by series. A given number of partitions is kept by adaptive execution, which would
    otherwise merge the small list of series before its days are generated."""
    return df.repartition(partitions, *SERIES) if partitions else df.repartition(*SERIES)


def panel_partitions(n_series: int, n_days: int, at_least: int, rows_per_task: int = 2_000_000) -> int:
    """Partitions for a panel, sized by the rows it will have rather than by its sparse inputs."""
    return max(at_least, -(-n_series * n_days // rows_per_task))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL instead of raising on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def lookup(key: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Literal lookup as a chain of WHEN branches."""
    result = F.lit(default).cast("string")
    for name, value in mapping.items():
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def distances(date: Column, is_marked: Column, by=()) -> tuple[Column, Column]:
    """Days to the next and since the previous marked day, both inclusive (0 on the day itself).

    One ordered pass instead of a self join on an inequality.
    """
    ordered = Window.partitionBy(*by).orderBy("date")
    marked = F.when(is_marked, date)
    ahead = F.min(marked).over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    behind = F.max(marked).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.datediff(ahead, date), F.datediff(date, behind)
