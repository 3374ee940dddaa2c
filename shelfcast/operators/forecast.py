"""From raw predictions to published forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.sources.published import PublishedTable, stamped

COLUMNS = (
    "id", "item_id", "store_id", "date", "horizon", "prediction", "model_version", "run_id", "as_of",
)
#: The published table; a series has one prediction a day and origin.
SCHEMA = (
    "id string, item_id string, store_id string, date date, horizon int, prediction double, model_version string, run_id string, "
    "created_at timestamp_ntz, as_of date"
)
KEYS = ("id", "date", "as_of")
#: Forecast volume as a share of the facts of the days before.
VOLUME_RANGE = (0.6, 1.4)


class ForecastRejected(RuntimeError):
    """The forecast failed its checks and was not published."""


def clamp_as_of(requested: date | None, bounds: DataFrame) -> DataFrame:
    """The requested day, but not later than the last fact (`max_date` of `bounds`)."""
    wanted = F.lit(requested).cast("date")
    return bounds.select(
        wanted.alias("requested"),
        F.least(F.coalesce(wanted, F.col("max_date")), F.col("max_date")).alias("as_of"),
        F.coalesce(wanted > F.col("max_date"), F.lit(False)).alias("was_clamped"),
    )


def inference_grid(series: DataFrame, as_of: date, horizon: int = 28) -> DataFrame:
    """Every series on each of the next `horizon` days, generated inside the series rows."""
    return series.select("id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon")).select(
        "id", F.date_add(F.lit(as_of), F.col("horizon")).alias("date"), "horizon"
    )


def post_process(preds: DataFrame) -> DataFrame:
    """No negative sales, nothing where the item has no price that week; fractions are kept."""
    clipped = F.greatest(F.col("prediction"), F.lit(0.0))
    return preds.withColumn("prediction", F.when(F.col("sell_price").isNull(), F.lit(0.0)).otherwise(clipped))


def stamp(preds: DataFrame, as_of: date, model_version: str, run_id: str) -> DataFrame:
    """Horizon, origin and provenance of each row."""
    return preds.withColumns({
        "horizon": F.datediff("date", F.lit(as_of)),
        "as_of": F.lit(as_of),
        "model_version": F.lit(model_version),
        "run_id": F.lit(run_id),
    })


def sanity_checks(
    preds: DataFrame, recent_sales: DataFrame, horizon: int = 28, volume_range: tuple[float, float] = VOLUME_RANGE
) -> DataFrame:
    """(check_name, passed) of the six checks before publishing.

    `recent_sales` are the facts of the last `horizon` days; without them the volume check fails. Rows are first
    combined by (id, date), which finds duplicates; ids are then counted from one row per id.
    """
    by_key = preds.groupBy("id", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("prediction").isNull()).alias("nulls"),
        F.count_if(F.col("prediction") < 0).alias("negatives"),
        F.sum("prediction").alias("volume"),
        F.collect_set("horizon").alias("horizons"),
    )
    by_id = by_key.groupBy("id").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("negatives").alias("negatives"),
        F.count_if(F.col("n") > 1).alias("duplicates"), F.sum("volume").alias("volume"),
        F.array_distinct(F.flatten(F.collect_list("horizons"))).alias("horizons"),
    )
    inside = F.forall("horizons", lambda h: h.between(1, horizon))
    seen = [F.max(F.array_contains("horizons", k)) for k in range(1, horizon + 1)]
    every: Column = F.min(inside)
    for s in seen:
        every = every & s
    totals = by_id.agg(
        F.count(F.lit(1)).alias("n_series"), F.sum("n").alias("n_rows"), F.sum("nulls").alias("nulls"),
        F.sum("negatives").alias("negatives"), F.sum("duplicates").alias("duplicates"),
        F.sum("volume").alias("volume"), every.alias("all_horizons"),
    ).withColumn("_one", F.lit(1))
    recent = recent_sales.agg(F.sum("sales").cast("double").alias("recent")).withColumn("_one", F.lit(1))
    ratio = F.col("volume") / F.nullif("recent", F.lit(0.0))
    checks = {
        "no_nulls": F.col("nulls") == 0,
        "no_negatives": F.col("negatives") == 0,
        "no_duplicates": F.col("duplicates") == 0,
        "all_horizons": F.col("all_horizons"),
        "rows_match_series": F.col("n_rows") == F.col("n_series") * horizon,
        "volume_in_range": ratio.between(*volume_range),
    }
    # both sides are single rows
    return totals.join(F.broadcast(recent), "_one").select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"))
        for name, passed in checks.items()
    ])))


def forecast_table(spark: SparkSession, path: str) -> PublishedTable:
    return PublishedTable(spark, path, StructType.fromDDL(SCHEMA), KEYS)


def publish(preds: DataFrame, path: str, audit=None, at: Column | None = None) -> int:
    """Replace the forecasts of the origins in `preds`, each as a whole, and keep the others; see `PublishedTable`."""
    table = forecast_table(preds.sparkSession, path)
    rows = stamped(preds.select(*COLUMNS), "created_at", at)
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    return table.publish(typed, audit, whole_partitions=True)


def publish_checked(
    preds: DataFrame, recent_sales: DataFrame, path: str, horizon: int = 28, at: Column | None = None,
    volume_range: tuple[float, float] = VOLUME_RANGE,
) -> int:
    """Publish by origin if all checks pass, otherwise raise and leave the table alone.

    The checks read the rows as they were written: what is published is what was checked.
    """
    def audit(rows: DataFrame) -> None:
        failed = [r.check_name for r in sanity_checks(rows, recent_sales, horizon, volume_range).filter("not passed").collect()]
        if failed:
            raise ForecastRejected(f"forecast failed: {', '.join(sorted(failed))}")

    return publish(preds, path, audit, at)


def submission(preds: DataFrame, horizon: int = 28) -> DataFrame:
    """One row per series, columns F1..F28. The pivot values are given, so no extra job looks for them."""
    wide = preds.groupBy("id").pivot("horizon", list(range(1, horizon + 1))).agg(F.min("prediction"))
    return wide.select("id", *[F.col(str(h)).alias(f"F{h}") for h in range(1, horizon + 1)])


def write_submission(preds: DataFrame, path: str, horizon: int = 28) -> None:
    """The submission as CSV with a header, in as many files as there are tasks; ids are in order inside and across them."""
    submission(preds, horizon).orderBy("id").write.mode("overwrite").option("header", True).csv(path)
