"""Moving statistics from running sums.

A moving frame of width n re-aggregates n rows for every row. Running sums do it in constant
time per row, whatever the width: a frame is the difference of two running sums, both read with
`lag` in the same window specification, so Spark needs a single shuffle and a single sort.
Sales are whole numbers, hence the running sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


class MovingFrames:
    """Frames of `widths` rows that end `shift` rows before the current one.

    `with_edges` adds the running sums at both ends of every frame, one structure per offset; the
    expressions below read them. `kept` drops the helpers again.
    """

    def __init__(self, value: str, window: WindowSpec, shift: int, widths: Iterable[int]):
        self.value, self.window, self.shift = value, window, shift
        self.offsets = [shift, *(shift + w for w in widths)]

    def with_edges(self, df: DataFrame) -> DataFrame:
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        value = F.col(self.value).cast("long")
        running = {
            "total": F.sum(value),
            "squares": F.sum(value * value),
            "known": F.count(value),
            "rows": F.count(F.lit(1)),
            "zeros": F.count(F.when(value == 0, 1)),
            "sold": F.count(F.when(value > 0, 1)),
        }
        summed = df.withColumns({f"_{part}": agg.over(upto) for part, agg in running.items()})
        one = summed.withColumn("_run", F.struct(*[F.col(f"_{p}").alias(p) for p in running]))
        return one.drop(*[f"_{p}" for p in running]).withColumns(
            {f"_at_{n}": F.lag("_run", n).over(self.window) for n in self.offsets}
        )

    def _within(self, part: str, width: int) -> Column:
        end, before = F.col(f"_at_{self.shift}.{part}"), F.col(f"_at_{self.shift + width}.{part}")
        return F.coalesce(end, F.lit(0)) - F.coalesce(before, F.lit(0))

    def mean(self, width: int) -> Column:
        return self._within("total", width).cast("double") / F.nullif(self._within("known", width), F.lit(0))

    def std(self, width: int) -> Column:
        """Population standard deviation; the whole-number form avoids cancellation."""
        n = F.nullif(self._within("known", width), F.lit(0)).cast("double")
        total = self._within("total", width).cast("double")
        squares = self._within("squares", width).cast("double")
        return F.sqrt(F.greatest(n * squares - total * total, F.lit(0.0))) / n

    def max(self, width: int) -> Column:
        """No running form exists for a maximum, so this keeps a (narrow) moving frame."""
        return F.max(self.value).over(self.window.rowsBetween(-(self.shift + width - 1), -self.shift))

    def zero_share(self, width: int) -> Column:
        """Share of zero rows; a row with an unknown value counts as not zero."""
        rows = F.nullif(self._within("rows", width), F.lit(0))
        return self._within("zeros", width).cast("double") / rows

    def selling_rows(self, width: int) -> Column:
        return self._within("sold", width)


def mean_of_known(columns: Iterable[Column]) -> Column:
    """Mean over the columns that are not NULL; NULL when none is known."""
    known = F.filter(F.array(*columns), lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0).cast("long"), lambda acc, v: acc + v)
    return total.cast("double") / F.nullif(F.size(known), F.lit(0))
