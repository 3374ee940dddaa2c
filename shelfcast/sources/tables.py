"""Reads of the panel and the mart by date window and store, and the mart's stored layout."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def data_bounds(panel: DataFrame) -> DataFrame:
    """First and last day with a known fact. Future panel rows have none and do not count."""
    return panel.filter(F.col("sales").isNotNull()).agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def load_sales(panel: DataFrame, start: date, end: date) -> DataFrame:
    return panel.filter(F.col("date").between(F.lit(start), F.lit(end)) & F.col("sales").isNotNull()).select(
        "id", "date", F.col("sales").cast("double").alias("sales")
    )


def store_mart(mart: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Store the mart as a table: a folder for each store and year, inside it a file for each bucket of items, in order of days.

    A read by store and date window opens the folders of these stores and years, and inside the files the row groups of these
    days. Rows of one series share a bucket, so that grouping or joining by series needs no exchange.
    """
    # with the writer's own bucket number, each file has one writer
    bucket = F.pmod(F.hash("item_id"), F.lit(buckets))
    rows = mart.repartition(F.col("store_id"), F.col("year"), bucket)
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("path", path)
    writer.partitionBy("store_id", "year").bucketBy(buckets, "item_id").sortBy("date").saveAsTable(name)
    return mart.sparkSession.table(name)


def load_mart(mart: DataFrame, start: date, end: date, stores: list[str] | None = None) -> DataFrame:
    """Rows of a date window, optionally of some stores; of a stored mart only their folders are read."""
    window = mart.filter(F.col("date").between(F.lit(start), F.lit(end)))
    if "year" in mart.columns:
        window = window.filter(F.col("year").between(start.year, end.year))
    return window.filter(F.col("store_id").isin(*stores)) if stores else window


def list_stores(mart: DataFrame) -> DataFrame:
    return mart.select("store_id").distinct().orderBy("store_id")
