"""Forecasts against facts: scores, breakdowns, fold tables and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import metrics as m
from shelfcast.functions.columns import ratio

METRICS = ("wmape", "mae", "rmse", "bias")


def match(actual: DataFrame, preds: DataFrame, on: list[str]) -> DataFrame:
    """Facts with their forecast, `is_missing` where there was none (then predicted as 0).

    A forecast key that occurs twice is an error. The check groups by the join key, so it reuses the
    shuffle of the join.
    """
    one = F.when(F.count(F.lit(1)) == 1, F.max("prediction")).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("duplicate forecast for"), *[F.col(c).cast("string") for c in on]))
    )
    unique = preds.groupBy(*on).agg(one.alias("_pred"), F.lit(True).alias("_found"))
    return (
        actual.join(unique, on, "left")
        .withColumn("is_missing", F.col("_found").isNull())
        .withColumn("prediction", F.coalesce("_pred", F.lit(0.0)))
        .drop("_pred", "_found")
    )


def score(actual: DataFrame, preds: DataFrame, on=("id", "date"), by=()) -> DataFrame:
    """Simple metrics per group with the number of rows and of missing forecasts."""
    return match(actual, preds, list(on)).groupBy(*by).agg(
        *m.simple_metrics(), F.count(F.lit(1)).alias("n_rows"), F.count_if("is_missing").alias("n_missing")
    )


def score_baselines(facts_by_fold: DataFrame, preds: DataFrame, baselines: list[str]) -> DataFrame:
    """Baseline x fold metrics. `facts_by_fold` are validation rows with `fold` and `origin`."""
    actual = facts_by_fold.withColumn("as_of", F.col("origin")).withColumn(
        "baseline", F.explode(F.array(*[F.lit(b) for b in baselines]))
    )
    return score(actual, preds, on=["baseline", "as_of", "id", "date"], by=["baseline", "fold"])


def horizon_breakdown(actual: DataFrame, preds: DataFrame) -> DataFrame:
    """Metrics per forecast day; only days with both a fact and a forecast count."""
    return (
        actual.join(preds, ["id", "date"])
        .groupBy("horizon")
        .agg(m.wmape().alias("wmape"), m.mae().alias("mae"), m.bias().alias("bias"), F.count(F.lit(1)).alias("n"))
    )


def error_by_series(actual: DataFrame, preds: DataFrame) -> DataFrame:
    """Absolute error and sales per series."""
    return (
        actual.join(preds, ["id", "date"])
        .groupBy("id")
        .agg(F.sum(F.abs(F.col("sales") - F.col("prediction"))).alias("abs_error"), F.sum("sales").alias("sales"))
    )


def error_analysis(actual: DataFrame, preds: DataFrame, stage, top_n: int = 50) -> DataFrame:
    """The `top_n` series with the largest error, their share of all error and that of the list.

    The errors, a row a series, are stored once; the total is a scalar of them, not a window over all series in one task.
    """
    errors = stage(error_by_series(actual, preds), "errors")
    total = errors.agg(F.sum("abs_error")).scalar()
    worst = errors.orderBy(F.desc("abs_error"), "id").limit(top_n)
    share = F.round(ratio(F.col("abs_error"), F.col("total_error")) * 100, 2)
    # fifty rows
    return worst.withColumn("total_error", total).withColumn("error_share_pct", share).withColumn(
        "top_share_pct", F.sum("error_share_pct").over(Window.partitionBy())
    )


def fold_summary(scores: DataFrame, by=()) -> DataFrame:
    """Mean and population deviation of each metric over folds."""
    columns: list[Column] = []
    for name in METRICS:
        columns += [F.avg(name).alias(f"{name}_mean"), F.stddev_pop(name).alias(f"{name}_std")]
    return scores.groupBy(*by).agg(*columns, F.count(F.lit(1)).alias("n_folds"))


def beats_baseline(scores: DataFrame, baseline: DataFrame, metric="wmape", min_improvement=0.0) -> DataFrame:
    """Mean over folds against the baseline's on the same folds (both one row per fold)."""
    paired = scores.select("fold", F.col(metric).alias("_model")).join(
        baseline.select("fold", F.col(metric).alias("_base")), "fold"
    )
    return paired.agg(
        F.avg("_model").alias("model_mean"), F.avg("_base").alias("baseline_mean"), F.count(F.lit(1)).alias("n_folds")
    ).withColumn(
        "beats_baseline",
        F.coalesce(F.col("model_mean") < F.col("baseline_mean") * (1 - min_improvement), F.lit(False)),
    )


def backtest_report(scores: DataFrame, baseline: DataFrame, counts: DataFrame, metric: str = "wmape") -> DataFrame:
    """Scores by fold beside the baseline's on the same fold, the gain in percent, and the rows of both periods."""
    beside = baseline.select("fold", F.col(metric).alias(f"baseline_{metric}"))
    gain = F.round((1 - ratio(F.col(metric), F.col(f"baseline_{metric}"))) * 100, 4)
    return scores.join(beside, "fold").withColumn("gain_pct", gain).join(counts, "fold")


def compare_models(scores: DataFrame, reference: str, metric: str = "wmape") -> DataFrame:
    """Configurations on the same folds: mean, deviation and difference to the reference one in percent.

    One row per configuration, so the unpartitioned window spans a handful of rows.
    """
    summary = scores.groupBy("config").agg(
        F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std")
    )
    everything = Window.partitionBy()
    base = F.max(F.when(F.col("config") == reference, F.col(f"{metric}_mean"))).over(everything)
    return summary.withColumn("delta_pct", F.round((ratio(F.col(f"{metric}_mean"), base) - 1) * 100, 2))


def metrics_report(matched: DataFrame, total_wrmsse: DataFrame | None = None) -> DataFrame:
    """All metrics overall and by horizon bucket (1-7, 8-14, 15-21, 22-28, and `other` for the rest).

    `matched` are facts with their forecast; rows without one are left out here.
    """
    h = F.col("horizon")
    bucket = (
        F.when(h <= 7, "h01_07").when(h <= 14, "h08_14").when(h <= 21, "h15_21").when(h <= 28, "h22_28")
        .otherwise("other")
    )
    report = (
        matched.filter(F.col("prediction").isNotNull()).withColumn("bucket", bucket).rollup("bucket")
        .agg(*m.simple_metrics(), F.count(F.lit(1)).alias("n_rows"))
        .withColumn("bucket", F.coalesce("bucket", F.lit("all")))
    )
    if total_wrmsse is None:
        return report
    overall = total_wrmsse.select(F.lit("all").alias("bucket"), "wrmsse")
    return report.join(overall, "bucket", "left")


def promotion_gate(scores: DataFrame, metric: str = "wmape", min_improvement: float = 0.01) -> DataFrame:
    """Should the candidate replace production? One row with the verdict and its reason.

    `scores` has one row per `role` (candidate, production) with `model_version` and the metric. No
    production, or one without the metric, promotes; no candidate, or one without the metric, refuses.
    """
    def of(role: str, column: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(column)))

    row = scores.agg(
        of("candidate", "model_version").alias("candidate_version"),
        of("candidate", metric).alias("candidate_score"),
        of("production", "model_version").alias("production_version"),
        of("production", metric).alias("production_score"),
    ).withColumn("threshold", F.col("production_score") * (1 - min_improvement))
    better = F.col("candidate_score") < F.col("threshold")
    return row.withColumn(
        "promote",
        F.when(F.col("candidate_score").isNull(), False)
        .when(F.col("production_score").isNull(), True)
        .otherwise(better),
    ).withColumn(
        "reason",
        F.when(F.col("candidate_version").isNull(), "there is nothing to promote")
        .when(F.col("candidate_score").isNull(), F.format_string(f"%s has no {metric}", "candidate_version"))
        .when(F.col("production_version").isNull(), F.format_string("%s is the first version", "candidate_version"))
        .when(F.col("production_score").isNull(), F.format_string(f"%s has no {metric} to defend", "production_version"))
        .otherwise(F.format_string(f"{metric} %.4f against a limit of %.4f", "candidate_score", "threshold")),
    )
