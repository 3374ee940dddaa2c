"""Categories as numbers, however many labels they have: what a label has sold, by what was known at the time.

The statistic of a row reads facts up to a horizon before it and no others. So it is the same in training, validation and
inference, no row sees its own target, and no fold needs statistics of its own: sums by label and day are made once, and every
expanding window is a running sum of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.lags import HORIZON

#: Rows of average sales that every label starts with.
PRIOR = 5
#: Stands for a missing label, which is a label of its own.
MISSING = "\x00"


def _label(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def running_sums(rows: DataFrame, columns: Sequence[str], counts: Column, horizon: int = HORIZON) -> DataFrame:
    """(feature, label, date, total, n): sales and rows of each label up to `horizon` days before each of its days.

    Rows where `counts` is false are days of the label, but not facts. The label and day pairs are summed map-side; a
    window holds the days of one label.
    """
    known = counts & F.col("sales").isNotNull()
    pairs = F.array(
        F.struct(F.lit("").alias("feature"), F.lit("").alias("label")),
        *[F.struct(F.lit(c).alias("feature"), _label(c).alias("label")) for c in columns],
    )
    daily = rows.select("date", F.when(known, F.col("sales")).alias("s"), F.inline(pairs)).groupBy("feature", "label", "date").agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("double").alias("s"), F.count("s").alias("n")
    )
    day = F.unix_date("date")
    past = Window.partitionBy("feature", "label").orderBy(day).rangeBetween(Window.unboundedPreceding, -horizon)
    return daily.select(
        "feature", "label", "date", F.coalesce(F.sum("s").over(past), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum("n").over(past), F.lit(0)).alias("n"),
    )


def with_target_means(
    rows: DataFrame, columns: Sequence[str], counts: Column, stage, horizon: int = HORIZON, prior: float = PRIOR
) -> DataFrame:
    """`rows` with `<column>_mean` for each category: the logarithm of the label's mean sales over that of all rows.

    Labels with few rows lean towards 0, the mean of all; so do new and unseen ones. `stage` stores the sums, so that Spark
    knows their size when it joins them.
    """
    sums = stage(running_sums(rows, columns, counts, horizon), "target_sums")
    everything = sums.where("feature = ''").select("date", F.col("total").alias("_total"), F.col("n").alias("_n"))
    rows = rows.join(everything, "date", "left")
    mean = F.col("_total") / F.nullif("_n", F.lit(0))
    for c in columns:
        own = sums.where(F.col("feature") == c).select(
            F.col("label").alias("_label"), "date", F.col("total").alias("_s"), F.col("n").alias("_k")
        )
        share = (F.col("_s") + prior * mean) / ((F.col("_k") + prior) * mean)
        rows = rows.withColumn("_label", _label(c)).join(own, ["_label", "date"], "left").withColumn(
            f"{c}_mean", F.coalesce(F.when(mean > 0, F.log(share)), F.lit(0.0))
        ).drop("_label", "_s", "_k")
    return rows.drop("_total", "_n")
