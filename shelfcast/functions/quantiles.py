"""Exact quantiles of groups that do not fit into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, by: str, value: str, probabilities: dict[str, float], n_bins: int = 256):
    """Interpolated quantiles per group as columns named by `probabilities`.

    The built-in exact percentile keeps all distinct values of a group in one task. Here a bounded
    sketch proposes bin edges, bins are counted, and only the one or two bins that hold a wanted rank are
    put in order. Equal values are counted before anything is shuffled, so a hot value is one row.
    """
    values = df.filter(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("_v"))
    counts = values.groupBy(by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    grid = [i / n_bins for i in range(1, n_bins)]
    edges = values.groupBy(by).agg(F.percentile_approx("_v", grid, 10000).alias("_edges"))
    binned = counts.join(edges, by).select(
        by, "_v", "_n", F.size(F.filter("_edges", lambda e: e < F.col("_v"))).alias("_bin")
    )
    # at most n_bins rows per group
    totals = binned.groupBy(by, "_bin").agg(F.sum("_n").alias("_in_bin"))
    upto = Window.partitionBy(by).orderBy("_bin")
    totals = totals.withColumn("_upto", F.sum("_in_bin").over(upto)).withColumn(
        "_all", F.sum("_in_bin").over(Window.partitionBy(by))
    )
    ranks = F.array(*[
        F.struct(F.lit(name).alias("_name"), F.lit(float(p)).alias("_p")) for name, p in probabilities.items()
    ])
    wanted = totals.select(by, "_bin", "_upto", "_in_bin", "_all", F.inline(ranks)).withColumn(
        "_pos", F.col("_p") * (F.col("_all") - 1)
    )
    before = F.col("_upto") - F.col("_in_bin")
    wanted = wanted.filter((F.ceil("_pos") >= before) & (F.floor("_pos") < F.col("_upto"))).select(
        by, "_bin", "_name", "_pos", before.alias("_before")
    )
    ordered = Window.partitionBy(by, "_bin", "_name").orderBy("_v")
    inside = wanted.join(binned, [by, "_bin"]).withColumn("_last", F.col("_before") + F.sum("_n").over(ordered) - 1)
    first = F.col("_last") - F.col("_n") + 1

    def at(rank):
        return F.max(F.when((rank >= first) & (rank <= F.col("_last")), F.col("_v")))

    found = inside.groupBy(by, "_name").agg(
        at(F.floor("_pos")).alias("_lo"), at(F.ceil("_pos")).alias("_hi"),
        F.max(F.col("_pos") - F.floor("_pos")).alias("_frac"),
    )
    quantile = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
    return found.groupBy(by).agg(
        *[F.max(F.when(F.col("_name") == name, quantile)).alias(name) for name in probabilities]
    )
