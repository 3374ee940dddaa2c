from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from panel_rows import ORIGIN, sales_of
from pyspark.sql import functions as F

from shelfcast.operators import calendar, holidays, lags, mart, prices, sales, weather
from shelfcast.sources import external
from shelfcast.sources.storage import staged_all


def by_key(df):
    return {(r["id"], r["date"]): r for r in df.collect()}


def test_lags_are_exact_and_stay_inside_the_series(panel):
    rows = by_key(lags.add_lags(panel))
    for k in range(4):
        name = f"I_{k % 2}_S_{k // 2}"
        for day in (0, 27, 28, 63, 399):
            row = rows[name, ORIGIN + timedelta(days=day)]
            for n in lags.lag_days():
                assert row[f"sales_lag_{n}"] == (sales_of(k, day - n) if day >= n else None)


def test_rolling_equals_brute_force(panel):
    rows = by_key(lags.add_rolling(panel))
    for k in (0, 3):
        name = f"I_{k % 2}_S_{k // 2}"
        series = [sales_of(k, d) for d in range(400)]
        for day in (0, 28, 40, 90, 250, 399):
            row = rows[name, ORIGIN + timedelta(days=day)]
            for width in (7, 28, 180):
                frame = series[max(0, day - 27 - width):max(0, day - 27)]
                if not frame:
                    assert row[f"roll_mean_{width}"] is None and row["nonzero_days_28"] == 0
                    continue
                assert row[f"roll_mean_{width}"] == pytest.approx(np.mean(frame))
                assert row[f"roll_std_{width}"] == pytest.approx(np.std(frame), abs=1e-9)
                if width != 180:
                    assert row[f"roll_max_{width}"] == max(frame)
                if width != 7:
                    assert row[f"zero_ratio_{width}"] == pytest.approx(np.mean([s == 0 for s in frame]))
            weekday = [series[day - 7 * w] for w in range(4, 12) if day >= 7 * w]
            assert row["dow_mean_8w"] == (pytest.approx(np.mean(weekday)) if weekday else None)


def test_features_do_not_see_later_sales(panel):
    cut = ORIGIN + timedelta(days=300)
    changed = panel.withColumn("sales", F.when(F.col("date") > F.lit(cut), 999).otherwise(F.col("sales")))
    limit = F.col("date") <= F.lit(cut + timedelta(days=28))
    before = lags.add_rolling(lags.add_lags(panel)).filter(limit).drop("sales")
    after = lags.add_rolling(lags.add_lags(changed)).filter(limit).drop("sales")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_category_window_covers_28_days_and_keeps_its_shift(panel):
    """Two departments in one category: a change on day 80 must not be seen before day 108."""
    changed = panel.withColumn("sales", F.when(F.col("day") == 80, 999).otherwise(F.col("sales")))
    before, after = lags.group_rolling(panel), lags.group_rolling(changed)
    moved = after.exceptAll(before).agg(F.min("date")).first()[0]
    assert moved == ORIGIN + timedelta(days=108)


def test_unpivot_drops_empty_cells(spark):
    days = [f"d_{i}" for i in range(1, 31)]
    schema = ", ".join([f"{c} string" for c in sales.SERIES_COLUMNS] + [f"{d} int" for d in days])
    wide = spark.createDataFrame([("a", "i", "d", "c", "s", "CA", *range(29), None)], schema)
    long = sales.unpivot_days(wide)
    assert long.count() == 29 and long.agg(F.sum("sales")).first()[0] == sum(range(29))
    assert long.filter("d = 'd_30'").count() == 0


def test_dense_panel_fills_trims_and_hides(spark):
    series = spark.createDataFrame(
        [("a", "i", "s", date(2020, 1, 3)), ("b", "j", "s", None)],
        "id string, item_id string, store_id string, first_sale_date date",
    )
    facts = spark.createDataFrame(
        [("i", "s", date(2020, 1, 3), 5), ("i", "s", date(2020, 1, 6), 7)], "item_id string, store_id string, date date, sales long"
    )
    rows = by_key(sales.dense_panel(series, facts, date(2020, 1, 1), date(2020, 1, 6), date(2020, 1, 5), 2))
    assert [rows["a", date(2020, 1, d)].sales for d in (3, 4, 5, 6)] == [5, 0, 0, None]
    assert ("a", date(2020, 1, 2)) not in rows and ("b", date(2020, 1, 1)) in rows


def test_event_distances_are_inclusive(spark):
    days = [(date(2020, 1, d), 1 if d in (3, 6) else 0) for d in range(1, 8)]
    rows = calendar.with_event_distances(spark.createDataFrame(days, "date date, has_event int")).orderBy("date").collect()
    assert [r.days_to_next_event for r in rows] == [2, 1, 0, 2, 1, 0, None]
    assert [r.days_since_prev_event for r in rows] == [None, None, 0, 1, 2, 0, 1]


def test_price_lags_count_priced_weeks_and_safe_statistics_ignore_the_future(spark):
    raw = spark.createDataFrame(
        [("s", "i", 1, 10.0), ("s", "i", 4, 8.0), ("s", "i", 5, 10.0)],
        "store_id string, item_id string, wm_yr_wk int, sell_price double",
    )
    full = {r.wm_yr_wk: r for r in prices.stage_prices(raw).collect()}
    safe = {r.wm_yr_wk: r for r in prices.stage_prices(raw, as_of_safe=True).collect()}
    assert full[4].price_change_1w == pytest.approx(-0.2) and full[4].is_price_drop == 1
    assert full[1].price_nunique_item == 2 and safe[1].price_nunique_item == 1 and safe[5].price_nunique_item == 2
    assert full[1].price_rel_own_mean != 1 and safe[1].price_rel_own_mean == 1


def test_relative_prices_use_all_stores(spark):
    raw = spark.createDataFrame(
        [("s1", "i", 1, 10.0), ("s2", "i", 1, 30.0), ("s1", "j", 1, 20.0)],
        "store_id string, item_id string, wm_yr_wk int, sell_price double",
    )
    items = spark.createDataFrame([("i", "d", "c"), ("j", "d", "c")], "item_id string, dept_id string, cat_id string")
    rows = {(r.store_id, r.item_id): r for r in prices.with_relative_prices(raw, items, staged_all).collect()}
    assert rows["s1", "i"].price_rel_item_mean == 0.5 and rows["s1", "i"].price_rel_dept_mean == 0.5


HOLIDAYS = [
    {"date": "2015-01-01", "name": "New Year", "countryCode": "XX", "counties": None, "types": ["Public"]},
    {"date": "2015-01-05", "name": "Local Day", "countryCode": "XX", "counties": ["XX-CA"], "types": ["School"]},
    {"date": "2015-01-05", "name": "Another", "countryCode": "XX", "counties": ["XX-CA"], "types": ["Public"]},
]


@pytest.fixture
def holiday_rows(spark):
    import json

    payload = spark.createDataFrame([(json.dumps(HOLIDAYS),)], "payload string")
    return external.parse_holidays(payload, ["CA", "TX"], "XX")


def test_regional_holidays_stay_in_their_state(holiday_rows):
    found = {(r.state_id, str(r.date), r.holiday_type) for r in holiday_rows.collect()}
    assert found == {
        ("CA", "2015-01-01", "Public"), ("TX", "2015-01-01", "Public"),
        ("CA", "2015-01-05", "School"), ("CA", "2015-01-05", "Public"),
    }


def test_holiday_features_are_one_row_per_state_day(spark, holiday_rows):
    states = spark.createDataFrame([("CA",), ("TX",)], "state_id string")
    features = holidays.holiday_features(holiday_rows, states, date(2015, 1, 1), date(2015, 1, 10))
    rows = {(r.state_id, r.date.day): r for r in features.collect()}
    assert features.count() == len(rows) == 20
    assert rows["CA", 4].is_day_before_holiday == 1 and rows["TX", 4].is_day_before_holiday == 0
    assert [rows["CA", d].days_to_next_holiday for d in range(1, 7)] == [0, 3, 2, 1, 0, None]
    assert rows["CA", 5].holiday_name == "Another" and rows["CA", 5].is_public_holiday
    marked = {(r.state_id, r.date.day) for r in holidays.with_long_weekend(features).filter("is_long_weekend = 1").collect()}
    assert marked == {("CA", 3), ("CA", 4), ("CA", 5)}  # Monday the 5th


def test_weather_payload_without_days_is_an_error(spark):
    good = '{"daily": {"time": ["2015-01-01", "2015-01-02"], "temperature_2m_mean": [13.1, null]}}'
    frame = spark.createDataFrame([("CA", "archive", good)], "state_id string, source string, payload string")
    assert [r.temperature_2m_mean for r in external.parse_weather(frame).orderBy("date").collect()] == [13.1, None]
    bad = spark.createDataFrame([("CA", "archive", "{}")], "state_id string, source string, payload string")
    with pytest.raises(Exception, match="without daily"):
        external.parse_weather(bad).collect()


def _weather(spark, rows):
    return spark.createDataFrame(
        [("CA", d, t, t, t, t, p, 0.0, 1.0, 1.0, s) for d, t, p, s in rows], weather.SCHEMA
    )


def test_degree_days_are_never_both_positive(spark):
    rows = [(date(2015, 1, 1) + timedelta(days=i), float(i), float(i % 5), "archive") for i in range(40)]
    rows.append((date(2015, 3, 1), None, 1.0, "archive"))
    found = weather.weather_features(_weather(spark, rows)).collect()
    assert all(r.hdd == 0 or r.cdd == 0 for r in found)
    assert [(r.hdd, r.cdd) for r in found if r.temperature_2m_mean is None] == [(0.0, 0.0)]


def test_norms_fill_the_days_past_the_forecast_around_new_year(spark):
    rows = [(date(2014, 1, 1) + timedelta(days=i), 10.0, 1.0, "archive") for i in range(365)]
    rows += [(date(2015, 1, 1) + timedelta(days=i), 20.0, 2.0, "forecast") for i in range(16)]
    filled = weather.future_weather(_weather(spark, rows), date(2014, 12, 31)).orderBy("horizon").collect()
    assert [r.source for r in filled] == ["forecast"] * 16 + ["climatology"] * 12
    assert {r.temperature_2m_mean for r in filled[16:]} == {10.0}


def test_mart_columns_do_not_depend_on_sources_and_modes_agree(spark, panel):
    as_of = ORIGIN + timedelta(days=371)
    rows = panel.withColumn("first_sale_date", F.lit(ORIGIN)).withColumn("days_since_first_sale", F.col("day"))
    raw = panel.select("date", "day").distinct().select(
        "date", F.concat(F.lit("d_"), F.col("day") + 1).alias("d"), (F.lit(11101) + F.floor(F.col("day") / 7)).cast("int").alias("wm_yr_wk"),
        (F.dayofweek("date") % 7 + 1).alias("wday"), F.date_format("date", "EEEE").alias("weekday"),
        F.month("date").alias("month"), F.year("date").alias("year"),
        *[F.lit("").alias(f"event_{k}_{n}") for n in (1, 2) for k in ("name", "type")], F.lit(1).alias("snap_CA"),
    )
    days = calendar.with_event_distances(calendar.stage_calendar(raw))
    weekly = panel.groupBy("store_id", "item_id", (F.lit(11101) + F.floor(F.col("day") / 7)).cast("int").alias("wm_yr_wk")).agg(
        F.lit(2.5).alias("sell_price"))
    priced = prices.with_relative_prices(prices.stage_prices(weekly), panel, staged_all)

    def build(mode, weather_table=None):
        return mart.build_mart(
            rows, days, calendar.snap_by_state(days), priced, weather_table, None, as_of, mode, stage_all=staged_all)

    train, inference = build("train"), build("inference")
    assert train.columns == mart.mart_columns() and inference.count() == 4 * 400
    assert inference.filter((F.col("date") > F.lit(as_of)) & F.col("sales").isNotNull()).count() == 0
    shared = inference.filter(F.col("date") <= F.lit(as_of))
    assert shared.exceptAll(train).count() == 0 and train.exceptAll(shared).count() == 0
    with pytest.raises(ValueError):
        mart.last_day(as_of, "score")


def test_weather_as_an_origin_knew_it(spark):
    day = lambda k: ORIGIN + timedelta(days=k)
    issues = spark.createDataFrame(
        [("CA", day(10), day(3), 1.0), ("CA", day(10), day(7), 2.0), ("CA", day(10), day(12), 3.0), ("CA", day(11), day(9), 4.0),
         ("TX", day(10), None, 9.0)],
        "state_id string, date date, issue_date date, t double")
    found = weather.known_at(issues, [day(2), day(7), day(8), day(12)], ["t"])
    assert {(r["as_of"], r["date"]): (r["issue_date"], r["t"]) for r in found.collect()} == {
        (day(7), day(10)): (day(7), 2.0), (day(8), day(10)): (day(7), 2.0), (day(12), day(10)): (day(12), 3.0),
        (day(12), day(11)): (day(9), 4.0)}
