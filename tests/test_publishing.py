"""Published tables: keys, whole snapshots, writers that die or collide."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructType

from shelfcast.operators import forecast, monitoring
from shelfcast.sources.published import Conflict, DuplicateKeys, PublishedTable

SCHEMA = StructType().add("k", IntegerType()).add("v", StringType()).add("as_of", DateType())
A, B = date(2020, 1, 1), date(2020, 1, 8)


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "t"), SCHEMA, ("as_of", "k"))


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def content(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


def test_rows_are_replaced_by_key(spark, table):
    assert table.version() == 0 and content(table) == []
    assert table.publish(rows(spark, (1, "a", A), (2, "b", A), (1, "c", B))) == 1
    assert table.publish(rows(spark, (2, "B", A), (3, "d", A))) == 2
    new = [(1, "a", A), (1, "c", B), (2, "B", A), (3, "d", A)]
    assert content(table) == new and table.read().schema == SCHEMA
    table.publish(rows(spark, (2, "B", A), (3, "d", A)))
    assert content(table) == new
    table.publish(rows(spark, (9, "z", A)), whole_partitions=True)
    assert content(table) == [(1, "c", B), (9, "z", A)]
    # earlier snapshots stay readable until they are removed
    assert content(table, 1) == [(1, "a", A), (1, "c", B), (2, "b", A)]
    table.publish(rows(spark))
    assert content(table) == [(1, "c", B), (9, "z", A)]
    assert table.vacuum() > 0 and content(table) == [(1, "c", B), (9, "z", A)] and table.vacuum() == 0
    assert table.read().filter(F.col("as_of") == F.lit(B)).count() == 1


def test_null_keys_and_partitions(spark, table):
    table.publish(rows(spark, (None, "a", A), (1, "b", None)))
    assert {tuple(r) for r in table.read().collect()} == {(None, "a", A), (1, "b", None)}


@pytest.mark.parametrize("step", ["_commit", "_write"])
def test_a_writer_that_dies_leaves_the_old_snapshot(spark, table, monkeypatch, step):
    table.publish(rows(spark, (1, "a", A)))
    whole = getattr(PublishedTable, step)

    def dies(self, *args):
        if step == "_write":
            whole(self, *args)  # the rows are there, the manifest is not
        raise KeyboardInterrupt

    monkeypatch.setattr(PublishedTable, step, dies)
    with pytest.raises(KeyboardInterrupt):
        table.publish(rows(spark, (1, "new", A), (2, "new", B)))
    monkeypatch.undo()
    assert table.version() == 1 and content(table) == [(1, "a", A)]
    table.publish(rows(spark, (1, "new", A)))
    assert content(table) == [(1, "new", A)] and table.vacuum() >= 1


def test_of_two_writers_the_second_fails(spark, table, monkeypatch):
    table.publish(rows(spark, (1, "a", A)))

    def meanwhile(_):
        if table.version() == 1:
            PublishedTable(spark, table.path, SCHEMA, table.keys).publish(rows(spark, (1, "other", A)))

    with pytest.raises(Conflict):
        table.publish(rows(spark, (1, "mine", A)), audit=meanwhile)
    assert table.version() == 2 and content(table) == [(1, "other", A)]


def test_doubled_keys_and_refused_rows_are_not_published(spark, table):
    table.publish(rows(spark, (1, "a", A)))
    with pytest.raises(DuplicateKeys, match="k=2"):
        table.publish(rows(spark, (2, "x", A), (2, "y", A)))

    def refuse(found):
        assert found.count() == 1
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        table.publish(rows(spark, (5, "x", A)), audit=refuse)
    assert content(table) == [(1, "a", A)]


def forecasts(spark, as_of, ids=("s1", "s2"), value=2.0):
    found = [
        (i, i, "S", date.fromordinal(as_of.toordinal() + h), h, value, "v", "run", as_of) for i in ids for h in range(1, 29)
    ]
    return spark.createDataFrame(found, "id string, item_id string, store_id string, date date, horizon int, prediction double, "
                                 "model_version string, run_id string, as_of date")


def test_checked_forecasts_replace_their_origin(spark, tmp_path):
    path, recent = str(tmp_path / "forecast"), spark.createDataFrame([(112.0,)], "sales double")
    at = F.lit("2020-02-01 06:00:00").cast("timestamp_ntz")
    forecast.publish_checked(forecasts(spark, A), recent, path, at=at)
    forecast.publish_checked(forecasts(spark, B), recent, path)
    with pytest.raises(forecast.ForecastRejected, match="volume_in_range"):
        forecast.publish_checked(forecasts(spark, A, value=9.0), recent, path)
    half = spark.createDataFrame([(56.0,)], "sales double")
    forecast.publish_checked(forecasts(spark, A, ids=("s1",)), half, path, at=at)
    found = forecast.forecast_table(spark, path).read()
    assert dict(found.dtypes)["created_at"] == "timestamp_ntz" and found.columns[-1] == "as_of"
    assert {(r["as_of"], r["id"], r["n"]) for r in found.groupBy("as_of", "id").agg(F.count("*").alias("n")).collect()} == {
        (A, "s1", 28), (B, "s1", 28), (B, "s2", 28)}
    assert {r["created_at"] for r in found.filter(F.col("as_of") == F.lit(A)).collect()} == {datetime(2020, 2, 1, 6)}


def test_accuracy_is_replaced_by_day_and_member(spark, tmp_path):
    path = str(tmp_path / "accuracy")
    schema = ("as_of date, date date, horizon int, level string, level_value string, model_version string, mae double, wmape double, "
              "rmse double, bias double")

    def day(h, mae, level="total"):
        return (A, date.fromordinal(A.toordinal() + h), h, level, level, "v", mae, 0.1, 1.0, 0.0)

    monitoring.publish_accuracy(spark.createDataFrame([day(1, 1.0), day(2, 1.0), day(2, 1.0, "x")], schema), path)
    monitoring.publish_accuracy(spark.createDataFrame([day(2, 5.0), day(3, 5.0)], schema), path)
    found = monitoring.accuracy_table(spark, path).read()
    assert {(r["horizon"], r["level"], r["mae"]) for r in found.collect()} == {
        (1, "total", 1.0), (2, "total", 5.0), (2, "x", 1.0), (3, "total", 5.0)}
    assert dict(found.dtypes)["computed_at"] == "timestamp_ntz"


def test_submission_as_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    forecast.write_submission(forecasts(spark, A, ids=("s2", "s1")), path)
    found = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert found.columns == ["id", *(f"F{h}" for h in range(1, 29))] and {r["id"] for r in found.collect()} == {"s1", "s2"}
