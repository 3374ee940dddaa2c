from __future__ import annotations

import os
import sys
from datetime import timedelta

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel_rows():
    from panel_rows import ORIGIN, sales_of

    rows = []
    for k in range(4):
        item, store = f"I_{k % 2}", f"S_{k // 2}"
        for day in range(400):
            rows.append((
                f"{item}_{store}", item, f"D_{k % 2}", "C_0", store, "CA", ORIGIN + timedelta(days=day),
                sales_of(k, day), day,
            ))
    return rows


@pytest.fixture(scope="session")
def panel(spark, panel_rows):
    return spark.createDataFrame(
        panel_rows,
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, "
        "sales long, day int",
    )
