from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from panel_rows import ORIGIN, sales_of
from pyspark.sql import functions as F

from shelfcast.functions import metrics as m
from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.operators import baselines, folds, forecast, model, monitoring, quality, scoring, serving, wrmsse
from shelfcast.sources import storage


@pytest.mark.parametrize(
    ("metric", "actual", "predicted", "expected"),
    [
        (m.mae, [0, 0], [1, 3], 2.0), (m.rmse, [0, 0], [3, 4], 3.5355339), (m.wmape, [4, 6], [2, 8], 0.4),
        (m.wmape, [0, 0, 10], [1, 1, 10], 0.2), (m.wmape, [0, 0], [1, 1], None), (m.bias, [10, 10], [12, 12], 0.2),
        (m.bias, [10, 10], [8, 8], -0.2),
    ],
)
def test_metric_values(spark, metric, actual, predicted, expected):
    df = spark.createDataFrame(list(zip(map(float, actual), map(float, predicted))), "sales double, prediction double")
    assert df.agg(metric()).first()[0] == (None if expected is None else pytest.approx(expected))


def test_rmsse_needs_a_positive_scale(spark):
    row = spark.range(1).select(m.rmsse(F.lit(4.0), F.lit(4.0)), m.rmsse(F.lit(1.0), F.lit(0.0))).first()
    assert row[0] == 1.0 and row[1] is None


def test_folds(spark):
    cut = folds.rolling_origin(spark, date(2013, 1, 1), date(2016, 6, 19), min_train_days=365)
    assert cut[0].val_end == date(2016, 6, 19) and len({f.train_start for f in cut}) == 1
    for newer, older in zip(cut, cut[1:]):
        assert older.val_end < newer.val_start
    assert all(f.gap_days == 28 and f.val_days == 28 and f.origin == f.val_start - timedelta(days=1) for f in cut)
    with pytest.raises(ValueError):
        folds.rolling_origin(spark, date(2015, 1, 1), date(2016, 6, 19), min_train_days=730)
    with pytest.raises(ValueError):
        folds.rolling_origin(spark, date(2010, 1, 1), date(2016, 6, 19), gap_days=7)


def test_baselines_match_their_definitions(spark, panel):
    origin = ORIGIN + timedelta(days=350)
    naive = {(r.id, r.horizon): r.prediction for r in baselines.seasonal_naive(panel, [origin]).collect()}
    flat = {(r.id, r.horizon): r.prediction for r in baselines.moving_average(panel, [origin]).collect()}
    weekday = {(r.id, r.horizon): r.prediction for r in baselines.dow_mean(panel, [origin]).collect()}
    assert len(naive) == len(flat) == len(weekday) == 4 * 28
    for h in (1, 13, 28):
        assert naive["I_1_S_0", h] == sales_of(1, 350 + h - 28)
        assert flat["I_1_S_0", h] == pytest.approx(np.mean([sales_of(1, d) for d in range(323, 351)]))
        same = [d for d in range(295, 351) if (d - (350 + h)) % 7 == 0]
        assert weekday["I_1_S_0", h] == pytest.approx(np.mean([sales_of(1, d) for d in same]))


def test_several_origins_equal_one_by_one(panel):
    origins = [ORIGIN + timedelta(days=d) for d in (350, 322)]
    both = baselines.all_baselines(panel, origins)
    single = baselines.all_baselines(panel, origins[:1]).unionByName(baselines.all_baselines(panel, origins[1:]))
    assert both.exceptAll(single).count() == 0 and single.exceptAll(both).count() == 0


def test_missing_forecasts_count_as_zero_and_duplicates_fail(spark):
    actual = spark.createDataFrame([("a", date(2020, 1, 1), 4.0), ("a", date(2020, 1, 2), 6.0)], "id string, date date, sales double")
    preds = spark.createDataFrame([("a", date(2020, 1, 1), 4.0)], "id string, date date, prediction double")
    row = scoring.score(actual, preds).first()
    assert (row.n_rows, row.n_missing) == (2, 1) and row.wmape == pytest.approx(0.6)
    with pytest.raises(Exception, match="duplicate forecast"):
        scoring.score(actual, preds.union(preds)).collect()


def test_wrmsse_properties(spark, panel):
    as_of = ORIGIN + timedelta(days=371)
    train = panel.filter(F.col("date") <= F.lit(as_of)).withColumn("sell_price", F.lit(2.0) + F.col("day") % 3)
    scale = wrmsse.scales(train, as_of, storage.staged)
    weight = wrmsse.weights(panel.select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id").distinct(), train, as_of, storage.staged)

    def of(form, prediction):
        held = panel.filter(F.col("date") > F.lit(as_of)).withColumn("sales", F.col("sales").cast("double"))
        return form(held.withColumn("prediction", prediction), scale, weight, storage.staged)

    assert [r.s for r in weight.groupBy("level").agg(F.sum("weight").alias("s")).collect()] == [pytest.approx(1.0)] * 12
    assert of(wrmsse.wrmsse, F.col("sales")).first().wrmsse == 0
    levels = of(wrmsse.wrmsse_by_level, F.lit(1.0)).collect()
    total = of(wrmsse.wrmsse, F.lit(1.0)).first().wrmsse
    assert len(levels) == 12 and total == pytest.approx(np.mean([r.wrmsse for r in levels]))
    # the late series starts at its own first sale
    series = [sales_of(1, d) for d in range(372)]
    first = next(i for i, s in enumerate(series) if s > 0)
    steps = np.diff(series[first:])
    found = scale.filter("level = 12 and key = 'I_1|S_0'").first().scale
    assert found == pytest.approx(np.mean(steps.astype(float) ** 2))
    with pytest.raises(Exception, match="no forecast for"):
        of(wrmsse.wrmsse, F.when(F.col("day") != 380, 1.0)).collect()


@pytest.mark.parametrize("cuts", [(), (0,), (5,), (12, 13), (3, 9, 21, 30), (39,)])
def test_scale_states_join_at_any_cut(spark, cuts):
    """Gaps, neighbours, zeros, a single day and quiet ends, cut anywhere, against the dense definition."""
    values = {
        "a": {0: 3, 1: 5, 2: 5, 6: 1, 12: 4, 13: 9, 39: 2}, "b": {5: 7}, "c": {9: 2, 10: 0, 11: 4, 30: 1}, "d": {39: 8}, "e": {20: 0},
    }
    rows = [(i, "D", "C", "S", "X", ORIGIN + timedelta(days=d), v) for i, own in values.items() for d, v in own.items()]
    sold = spark.createDataFrame(rows, "item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, sales long")
    edges = [-1, *cuts, 39]
    found = None
    for first, last in zip(edges, edges[1:]):
        day = F.datediff("date", F.lit(ORIGIN))
        part = wrmsse.scale_states(sold.filter((day > first) & (day <= last)), storage.staged)
        found = part if found is None else wrmsse.join_states(found, part)
    end = ORIGIN + timedelta(days=39)
    scale = {r.key: r.scale for r in wrmsse.scales_of(found, end).filter("level = 12").collect()}
    for item, own in values.items():
        days = np.array([own.get(d, 0) for d in range(40)], float)
        some = np.flatnonzero(days)
        if not len(some):
            assert f"{item}|S" not in scale
            continue
        steps = np.diff(days[some[0]:])
        assert scale[f"{item}|S"] == (pytest.approx(np.mean(steps**2)) if len(steps) else None)


def test_roll_up_equals_direct_grouping(panel):
    rolled = wrmsse.roll_up(panel, ["sales"])
    for level, columns in wrmsse.LEVELS.items():
        direct = panel.groupBy(*columns, "date").agg(F.sum("sales").alias("sales")).select(
            F.concat_ws("|", *columns).alias("key") if columns else F.lit("").alias("key"), "date", "sales")
        part = rolled.filter(F.col("level") == level).select("key", "date", "sales")
        assert part.exceptAll(direct).count() == 0 and direct.exceptAll(part).count() == 0


def test_exact_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([np.zeros(3000), rng.gamma(2, 3, 4000), [1e6]])
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("one", 5.0)], "g string, v double")
    rows = {r.g: r for r in exact_quantiles(df, "g", "v", {"median": 0.5, "p95": 0.95, "top": 1.0, "low": 0.0}).collect()}
    assert rows["g"].median == pytest.approx(np.quantile(values, 0.5))
    assert rows["g"].p95 == pytest.approx(np.quantile(values, 0.95))
    assert (rows["g"].top, rows["g"].low) == (1e6, 0.0) and rows["one"].median == 5.0


def _violations(report):
    return {(r.column, r.rule): r.violations for r in report.collect() if r.violations}


def test_rules_catch_broken_rows(spark):
    rules = quality.rule_sets(["CA"], ["FOODS"])
    row = ("a", "i", "d", "FOODS", "s", "CA", date(2015, 1, 1), 1.0)
    schema = ("id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, "
              "sales double")
    broken = spark.createDataFrame([row, row, (*row[:5], "NY", date(2015, 1, 2), -1.0)], schema)
    assert _violations(quality.validate(broken, rules["sales_long"])) == {
        ("state_id", "in_set"): 1, ("sales", "ge(0)"): 1, ("id,date", "unique"): 1}
    assert _violations(quality.validate(broken.drop("cat_id"), rules["sales_long"]))["cat_id", "column_exists"] == 1
    weather = spark.createDataFrame(
        [("CA", date(2015, 1, 1), 200.0, -1.0, None)],
        "state_id string, date date, temperature_2m_mean double, precipitation_sum double, source string")
    assert _violations(quality.validate(weather, rules["weather"])) == {
        ("temperature_2m_mean", "in_range(-60,60)"): 1, ("precipitation_sum", "ge(0)"): 1, ("source", "not_null"): 1}
    typed = spark.createDataFrame([("s", "i", "x", 0.0)], "store_id string, item_id string, wm_yr_wk string, sell_price double")
    assert _violations(quality.validate(typed, rules["sell_prices"])) == {("wm_yr_wk", "is_int"): 1, ("sell_price", "gt(0)"): 1}


def test_invariants(spark):
    rows = [("a", date(2015, 1, d), s, p) for d, s, p in ((1, 1, 2.0), (2, None, 2.0), (4, -1, 0.0), (5, 3, None), (6, None, 1.0))]
    df = spark.createDataFrame([*rows, rows[0]], "id string, date date, sales long, sell_price double")
    assert {r.check_name: r.violations for r in quality.invariants(df, storage.staged).collect()} == {
        "negative_sales": 1, "missing_facts": 1, "calendar_holes": 1, "sales_without_price": 1,
        "non_positive_price": 1, "duplicate_id_date": 1}


def _forecast(spark, days=28, value=1.0, origin=date(2020, 1, 1)):
    return spark.createDataFrame(
        [("a", "i", "s", origin + timedelta(days=h), h, value, "v1", "r1", origin) for h in range(1, days + 1)],
        "id string, item_id string, store_id string, date date, horizon int, prediction double, model_version string, "
        "run_id string, as_of date")


def test_publish_replaces_its_origin_only_and_rejects_bad_forecasts(spark, tmp_path):
    path = str(tmp_path / "forecast")
    recent = spark.createDataFrame([("a", date(2019, 12, 31), 28.0)], "id string, date date, sales double")
    forecast.publish_checked(_forecast(spark), recent, path)
    forecast.publish_checked(_forecast(spark, origin=date(2020, 1, 29)), recent, path)
    forecast.publish_checked(_forecast(spark, value=1.2), recent, path)
    table = forecast.forecast_table(spark, path).read()
    assert table.count() == 56 and table.filter("prediction = 1.2").count() == 28
    for bad in (_forecast(spark, 27), _forecast(spark, value=-1.0), _forecast(spark, value=9.0),
                _forecast(spark).union(_forecast(spark))):
        with pytest.raises(forecast.ForecastRejected):
            forecast.publish_checked(bad, recent, path)
    assert forecast.forecast_table(spark, path).read().count() == 56


def test_post_process(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (3.5, 2.0), (3.5, None)], "prediction double, sell_price double")
    assert [r.prediction for r in forecast.post_process(df).collect()] == [0.0, 3.5, 0.0]


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([("candidate", "2", 0.4849), ("production", "1", 0.4860)], False),
        ([("candidate", "2", 0.48), ("production", "1", 0.4860)], True),
        ([("candidate", "2", 0.9)], True),
        ([("candidate", "2", 0.9), ("production", "1", None)], True),
        ([("production", "1", 0.5)], False),
        ([("candidate", "2", None), ("production", "1", 0.5)], False),
    ],
)
def test_promotion_gate(spark, rows, expected):
    df = spark.createDataFrame(rows, "role string, model_version string, wmape double")
    assert scoring.promotion_gate(df).first().promote is expected


def test_retrain_rule(spark):
    days = [date(2020, 1, 1) + timedelta(days=28 * k) for k in range(4)]
    def verdict(values):
        return monitoring.should_retrain(spark.createDataFrame(list(zip(days, values)), "as_of date, wmape double")).first()
    assert verdict([0.4, 0.4, 0.4, 0.5]).retrain and not verdict([0.4, 0.4, 0.4, 0.45]).retrain
    assert not verdict([0.4]).retrain


def test_drift_finds_the_moved_column(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), "x" if c else "y") for a, b, c in zip(rng.normal(size=2000), rng.normal(size=2000), rng.random(2000) < 0.5)]
    reference = spark.createDataFrame(rows, "same double, moved double, kind string")
    current = reference.withColumn("moved", F.col("moved") + 1)
    found = {r.feature: r for r in monitoring.data_drift(reference, current, ["same", "moved"], ["kind"]).collect()}
    assert found["moved"].drifted and not found["same"].drifted and not found["kind"].drifted
    assert found["same"].distance == pytest.approx(0) and found["kind"].distance == pytest.approx(0)
    cuts = [np.quantile([r[1] for r in rows], q) for q in np.arange(0.1, 1, 0.1)]
    p = np.histogram([r[1] for r in rows], [-np.inf, *cuts, np.inf])[0] / 2000
    q = np.histogram([r[1] + 1 for r in rows], [-np.inf, *cuts, np.inf])[0] / 2000
    assert found["moved"].distance == pytest.approx(np.sum((q - p) * np.log(np.maximum(q, 1e-4) / p)), rel=0.05)


def test_points_of_a_pair_are_ordered(spark):
    points = serving.as_points(_forecast(spark)).first().points
    assert [p.horizon for p in points] == list(range(1, 29))


def test_csv_types_come_from_all_rows(spark, tmp_path):
    path = str(tmp_path / "wide.csv")
    with open(path, "w") as f:
        f.write("id,d_1\n" + "".join(f"s{i},0\n" for i in range(3000)) + "last,7\n")
    inferred = storage.csv_to_parquet(spark, path, str(tmp_path / "wide"))
    assert dict(inferred.dtypes)["d_1"] == "int" and inferred.agg(F.sum("d_1")).first()[0] == 7
    assert storage.wide_sales_schema(2).endswith("d_1 smallint, d_2 smallint")


def test_fingerprint_ignores_order_but_not_content(spark):
    a = spark.range(100).withColumn("v", F.col("id") % 7)
    first, shuffled, other = (
        storage.fingerprint({"t": d}).first().version
        for d in (a, a.orderBy(F.desc("id")).repartition(3), a.withColumn("v", F.col("v") + (F.col("id") == 5).cast("int"))))
    assert first == shuffled != other


def test_every_store_has_a_model(spark):
    from __spark_entry__ import queries

    data = "/root/testdata/sf0.001"
    stores = spark.read.parquet(f"{data}/supplier.parquet").select("s_nationkey").distinct().count()
    rows = queries()["model_by_store"](spark, data).collect()
    assert len({row.store_id for row in rows}) == len(rows) == stores > 2 and all(row.n_rows for row in rows)


def test_unseen_categories_share_the_last_index(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    fitted = model.category_index(train, ["c"])
    rows = fitted.transform(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")).collect()
    assert [r.c_index for r in rows] == [0.0, 1.0, 2.0, 2.0]


def test_series_without_a_scale_is_not_a_perfect_forecast(spark):
    def days(item, sales, prediction):
        return [(item, "D", "C", "S", "X", ORIGIN + timedelta(days=k), sales[k], prediction[k]) for k in range(4)]

    schema = "item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, sales long, prediction double"
    rows = spark.createDataFrame(days("a", [5] * 4, [500.0] * 4) + days("b", [1, 2, 1, 2], [1.0, 2.0, 1.0, 2.0]), schema)
    train, end = rows.drop("prediction").withColumn("sell_price", F.lit(1.0)), ORIGIN + timedelta(days=3)
    scale = wrmsse.scales(train, end, storage.staged)
    series = train.select("item_id", "dept_id", "cat_id", "store_id", "state_id").distinct()
    weight = wrmsse.weights(series, train, end, storage.staged)
    level = {x["level"]: x for x in wrmsse.wrmsse_by_level(rows, scale, weight, storage.staged).collect()}[12]
    assert (level["n_unscored"], level["wrmsse"]) == (1, 0.0)
    assert level["weight_unscored"] == pytest.approx(20 / 26)
