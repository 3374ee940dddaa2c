"""Actual quality once facts arrive, drift, freshness and the retraining rule."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.functions import metrics as m
from shelfcast.functions.columns import ratio
from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.sources.published import PublishedTable, stamped

# Report levels and their columns.
REPORT_LEVELS = {
    "total": (),
    "state": ("state_id",),
    "store": ("store_id",),
    "cat": ("cat_id",),
    "dept": ("dept_id",),
    "store_dept": ("store_id", "dept_id"),
    "item_store": ("item_id", "store_id"),
}
_LEVEL_COLUMNS = ("state_id", "store_id", "cat_id", "dept_id", "item_id")


def actual_accuracy(forecast: DataFrame, actual: DataFrame, series: DataFrame, stage) -> DataFrame:
    """Metrics per origin, day and level for forecast days whose fact is known.

    A cascade of error sums: rows are the finest level; they are added up once by store and department, and the coarser levels
    come from those few sums, so no row is copied for each of its levels. `stage` stores both tables.
    """
    extra = ("as_of", "date", "horizon", "model_version")
    attributes = ("state_id", "store_id", "cat_id", "dept_id")
    rows = (
        forecast.select("id", "date", "as_of", "horizon", "prediction", "model_version")
        .join(actual.select("id", "date", "sales"), ["id", "date"])
        .join(series.select("id", *_LEVEL_COLUMNS), "id")
    )
    finest = stage(rows.groupBy("item_id", *attributes, *extra).agg(*m.error_sums()), "errors_by_series")
    sums = [F.sum(c).alias(c) for c in m.ERROR_SUMS]
    by_department = stage(finest.groupBy(*attributes, *extra).agg(*sums), "errors_by_department")
    columns = (*attributes, *extra)
    coarse = {name: kept for name, kept in REPORT_LEVELS.items() if "item_id" not in kept}
    level: Column = F.lit(None).cast("string")
    for name, kept in coarse.items():
        grouped_out = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c in attributes and c not in kept)
        level = F.when(F.grouping_id(*columns) == grouped_out, name).otherwise(level)
    sets = [[F.col(c) for c in (*kept, *extra)] for kept in coarse.values()]
    label = F.when(F.col("level") == "total", "total").otherwise(F.concat_ws("|", *attributes))
    coarser = by_department.groupingSets(sets, *columns).agg(level.alias("level"), *sums).withColumn("level_value", label)
    named = finest.withColumns({"level": F.lit("item_store"), "level_value": F.concat_ws("|", "item_id", "store_id")})
    result = ("as_of", "date", "horizon", "level", "level_value", "model_version")
    return coarser.select(*result, *m.ERROR_SUMS).unionByName(named.select(*result, *m.ERROR_SUMS)).select(
        *result, *m.metrics_of_sums()
    )


#: The published accuracy; one row for each origin, day, level and member of it.
ACCURACY_SCHEMA = (
    "date date, horizon int, level string, level_value string, model_version string, mae double, wmape double, rmse double, "
    "bias double, computed_at timestamp_ntz, as_of date"
)
ACCURACY_KEYS = ("as_of", "date", "level", "level_value")


def accuracy_table(spark: SparkSession, path: str) -> PublishedTable:
    return PublishedTable(spark, path, StructType.fromDDL(ACCURACY_SCHEMA), ACCURACY_KEYS)


def publish_accuracy(accuracy: DataFrame, path: str, at: Column | None = None) -> int:
    """Replace the rows of the same origin, day, level and member; days of an origin that are not in `accuracy` stay."""
    table = accuracy_table(accuracy.sparkSession, path)
    rows = stamped(accuracy, "computed_at", at)
    return table.publish(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]))


def accuracy_trend(periods: DataFrame, n_periods: int = 12) -> DataFrame:
    """Quality per origin, the last `n_periods` origins, from pooled scores: a day counts by what was sold on it."""
    return periods.orderBy(F.desc("as_of")).limit(n_periods)


def period_scores(forecast: DataFrame, actual: DataFrame, by: DataFrame | None = None, level: str = "total") -> DataFrame:
    """Pooled metrics per origin or, with the series table `by`, per origin and member of a report level."""
    rows = forecast.join(actual.select("id", "date", "sales"), ["id", "date"])
    columns = REPORT_LEVELS[level]
    if columns:
        rows = rows.join(by.select("id", *(c for c in columns if c not in rows.columns)), "id")
    label = F.concat_ws("|", *sorted(columns)).alias("level_value")
    return rows.groupBy("as_of", *([label] if columns else [])).agg(*m.simple_metrics(), F.count(F.lit(1)).alias("n_rows"))


def should_retrain(periods: DataFrame, threshold_pct: float = 15.0, n_before: int = 3) -> DataFrame:
    """Has WMAPE of the newest period risen over the mean of the periods before it?

    One row per period, so the window without partitions stays small.
    """
    before = Window.orderBy("as_of").rowsBetween(-n_before, -1)
    change = (ratio(F.col("wmape"), F.col("reference")) - 1) * 100
    return (
        periods.select("as_of", "wmape", F.avg("wmape").over(before).alias("reference"))
        .orderBy(F.desc("as_of"))
        .limit(1)
        .withColumn("change_pct", F.round(change, 4))
        .withColumn("retrain", F.coalesce(F.col("change_pct") > threshold_pct, F.lit(False)))
        .withColumn(
            "reason",
            F.when(F.col("reference").isNull(), "no earlier periods to compare with").otherwise(
                F.format_string(
                    "WMAPE changed by %.1f %% against a limit of " + f"{threshold_pct:.1f} %%", F.col("change_pct")
                )
            ),
        )
    )


def prediction_drift(forecast: DataFrame, window_days: int = 28) -> DataFrame:
    """Distribution of the latest `window_days` forecast days against the window before it."""
    last = forecast.agg(F.max("date")).first()[0]
    age = F.datediff(F.lit(last), F.col("date"))
    labelled = (
        forecast.filter(age < 2 * window_days)
        .withColumn("period", F.when(age < window_days, "current").otherwise("previous"))
    )
    shape = labelled.groupBy("period").agg(
        F.count("prediction").alias("n"),
        F.avg("prediction").alias("mean"),
        F.avg(F.when(F.col("prediction") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("zero_share"),
    )
    return shape.join(exact_quantiles(labelled, "period", "prediction", {"median": 0.5, "p95": 0.95}), "period")


def weather_source_mix(weather: DataFrame, start: date, end: date, by=()) -> DataFrame:
    """Shares of archive, forecast and climatology days in a date window."""
    counts = weather.filter(F.col("date").between(F.lit(start), F.lit(end))).groupBy(*by, "source").agg(
        F.count(F.lit(1)).alias("n_days")
    )
    # at most three rows per group
    return counts.withColumn(
        "share", ratio(F.col("n_days"), F.sum("n_days").over(Window.partitionBy(*by)))
    )


def external_freshness(
    weather: DataFrame, holidays: DataFrame, as_of: date, stale_after: int = 7, temperature=(-60, 60)
) -> DataFrame:
    """Per state: last day, lag, holes and implausible temperatures of the weather, years of the holidays."""
    observed = weather.groupBy("state_id").agg(
        F.max("date").alias("weather_max_date"),
        F.datediff(F.lit(as_of), F.max("date")).alias("weather_lag_days"),
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.count_distinct("date")).alias("weather_holes"),
        F.count_if(~F.col("temperature_2m_mean").between(*temperature)).alias("implausible_days"),
    )
    covered = holidays.groupBy("state_id").agg(
        F.min(F.year("date")).alias("holidays_min_year"), F.max(F.year("date")).alias("holidays_max_year")
    )
    late = F.col("weather_lag_days") > stale_after
    ended = F.coalesce(F.col("holidays_max_year") < F.lit(as_of.year), F.lit(True))
    return observed.join(covered, "state_id", "full").withColumn(
        "is_stale", F.coalesce(late, F.lit(True)) | ended
    )


def reference_sample(rows: DataFrame, per_stratum: int, by: str = "store_id", keys=("id", "date"), seed: int = 42) -> DataFrame:
    """Of each stratum the `per_stratum` rows whose hashed key comes first, to keep beside a model.

    The same rows whatever their order and partitioning; samples of parts of the rows are merged by sampling their union again.
    Each task passes on as many rows of a stratum only. `data_drift` takes a sample or whole rows as its reference.
    """
    place = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys]))
    order = Window.partitionBy(by).orderBy("_place", *keys)
    return (
        rows.withColumn("_place", place).withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= per_stratum).drop("_place", "_rank")
    )


def data_drift(
    reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], n_bins: int = 10,
    threshold: float = 0.2,
) -> DataFrame:
    """Population stability index per feature; a feature above `threshold` has drifted.

    Numeric features share the bin edges of the reference's quantile sketch (bounded state); categories are
    their own bins, NULL is a bin. The features become (feature, bin) rows that are counted map-side.
    """
    grid = [i / n_bins for i in range(1, n_bins)]
    edges = reference.agg(
        *[F.percentile_approx(F.col(c).cast("double"), grid, 1000).alias(c) for c in numeric]
    ).first().asDict()

    cuts = F.array(*[F.array(*[F.lit(float(e)) for e in sorted(set(edges[c] or [0.0]))]) for c in numeric])
    names = F.array(*[F.lit(c) for c in [*numeric, *categorical]])

    def binned(df: DataFrame, sample: str) -> DataFrame:
        """(position of the feature, bin): numbers travel as numbers, names are attached after counting."""
        numbers = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in numeric])).alias("pos", "value"))
        own = F.element_at(cuts, F.col("pos") + 1)
        bins = numbers.select(
            "pos",
            F.when(F.col("value").isNull(), "null").otherwise(
                F.size(F.filter(own, lambda e: e < F.col("value"))).cast("string")
            ).alias("bin"),
        )
        if categorical:
            labels = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in categorical])
            bins = bins.unionByName(
                df.select(F.posexplode(labels).alias("pos", "bin")).withColumn("pos", F.col("pos") + len(numeric))
            )
        return bins.withColumn("sample", F.lit(sample))

    counts = (
        binned(reference, "reference").unionByName(binned(current, "current"))
        .groupBy("pos", "bin")
        .agg(
            F.count_if(F.col("sample") == "reference").alias("n_reference"),
            F.count_if(F.col("sample") == "current").alias("n_current"),
        )
        .select(F.element_at(names, F.col("pos") + 1).alias("feature"), "bin", "n_reference", "n_current")
    )
    # a bin per row from here on; categories with many values have many bins but few rows each
    totals = counts.groupBy("feature").agg(
        F.sum("n_reference").alias("t_reference"), F.sum("n_current").alias("t_current")
    )
    floor = F.lit(1e-4)
    p = F.greatest(F.col("n_reference") / F.nullif("t_reference", F.lit(0)), floor)
    q = F.greatest(F.col("n_current") / F.nullif("t_current", F.lit(0)), floor)
    return (
        counts.join(totals, "feature")
        .groupBy("feature")
        .agg(F.sum((q - p) * F.log(q / p)).alias("distance"))
        .withColumn("drifted", F.coalesce(F.col("distance") > threshold, F.lit(False)))
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count_if("drifted").alias("n_drifted"),
        F.avg(F.col("drifted").cast("double")).alias("share_drifted"),
        F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_columns"),
    )


def drift_decision(
    drift: DataFrame, freshness: DataFrame, predictions: DataFrame, threshold_share=0.3, max_mean_change=0.5
) -> DataFrame:
    """One row: is an alert due, and for which of the three reasons? All inputs are summaries."""
    def mean_of(period: str) -> Column:
        return F.max(F.when(F.col("period") == period, F.col("mean")))

    change = F.abs(ratio(mean_of("current"), mean_of("previous")) - 1)
    one = F.lit(1).alias("_one")
    summary = drift_summary(drift).select("*", one)
    stale = freshness.agg(F.bool_or("is_stale").alias("is_stale")).select("*", one)
    moved = predictions.agg(change.alias("mean_change")).select("*", one)
    return (
        summary.join(F.broadcast(stale), "_one").join(F.broadcast(moved), "_one").drop("_one")
        .withColumn(
            "alert",
            (F.col("share_drifted") >= threshold_share) | F.col("is_stale")
            | F.coalesce(F.col("mean_change") > max_mean_change, F.lit(False)),
        )
    )
