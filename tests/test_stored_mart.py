"""The stored mart: folders and buckets that reads and groupings make use of."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest
from panel_rows import ORIGIN
from pyspark.sql import functions as F

from shelfcast.functions.columns import SERIES
from shelfcast.sources import tables
from shelfcast.sources.tpch_retail import RetailTables


@pytest.fixture(scope="module")
def stored(spark, panel, tmp_path_factory):
    mart = panel.withColumn("year", F.year("date"))
    table = tables.store_mart(mart, "stored_mart_test", str(tmp_path_factory.mktemp("mart") / "t"), buckets=4)
    yield table.select(*mart.columns)
    spark.sql("DROP TABLE stored_mart_test")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_window_of_a_store_opens_its_folders_only(panel, stored):
    start, end = ORIGIN + timedelta(days=200), ORIGIN + timedelta(days=227)
    window = tables.load_mart(stored, start, end, ["S_1"])
    scans = [line for line in plan(window).split("\n") if "FileScan" in line]
    (scan,) = scans
    folders = re.search(r"PartitionFilters: \[([^\]]*)\]", scan)[1]
    assert "store_id" in folders and "year" in folders and re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(date", scan)
    assert len(window.inputFiles()) < len(stored.inputFiles())
    assert all("store_id=S_1/year=2015" in f for f in window.inputFiles())
    direct = panel.withColumn("year", F.year("date")).filter(
        F.col("date").between(F.lit(start), F.lit(end)) & (F.col("store_id") == "S_1"))
    assert window.exceptAll(direct).count() == direct.exceptAll(window).count() == 0 and window.count() == 56


def test_every_row_is_stored(panel, stored):
    mart = panel.withColumn("year", F.year("date"))
    assert stored.count() == mart.count() and stored.exceptAll(mart).count() == 0


def test_series_are_grouped_and_joined_in_place(spark, stored):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    totals = stored.groupBy(*SERIES).agg(F.sum("sales").alias("total"))
    assert "Exchange" not in plan(totals)
    joined = stored.hint("merge").join(totals, list(SERIES))
    assert "Exchange" not in plan(joined)
    assert joined.count() == stored.count()


def test_tasks_of_the_mart_do_not_make_the_prices(spark):
    """The tasks that sort the panel read finished prices: one sort and its windows, beside those of joins with small tables."""
    mart = RetailTables(spark, "/root/testdata/sf0.001").mart("inference")
    lines = plan(mart).split("\n")
    assert len([line for line in lines if "Window [" in line]) == 3  # lags, running sums, sums at the edges of frames
    assert not [line for line in lines if "Window [" in line and "sell_price" in line]
    assert any("FileScan" in line and "price_momentum_4w" in line for line in lines)
