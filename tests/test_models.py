"""Regressions, target means, backtests and store models on the small panel, against plain versions."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import timedelta

import numpy as np
import pytest
from panel_rows import ORIGIN
from pyspark.sql import functions as F

from shelfcast.functions.columns import series_window
from shelfcast.operators import folds, model, target_stats, tweedie
from shelfcast.sources import storage

ROWS = "group string, day int, y double, x array<double>"


def sample(seed: int, n: int, first_day: int = 0):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.standard_normal(n), r.integers(0, 2, n), r.standard_normal(n) * 50 + 7, np.full(n, 3.0)])
    mu = np.exp(0.4 + 0.7 * x[:, 0] - 0.9 * x[:, 1] + 0.01 * x[:, 2])
    y = r.poisson(mu).astype(float)
    return [(first_day + k % 60, float(y[k]), x[k].tolist()) for k in range(n)]


def plain_fit(rows, inputs, ridge=tweedie.RIDGE):
    """Newton steps on the penalised deviance, one model, all rows in memory."""
    y, x = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])[:, inputs]
    mean, spread = x.mean(axis=0), x.std(axis=0)
    kept = spread > 1e-9
    z = np.column_stack([np.ones(len(y)), (x[:, kept] - mean[kept]) / spread[kept]])
    beta = np.zeros(z.shape[1])
    beta[0] = np.log(y.mean())
    penalty = np.full(len(beta), ridge * len(y) * y.mean() ** (2 - tweedie.POWER))
    penalty[0] = 0
    for _ in range(200):
        mu = np.exp(z @ beta)
        w = mu ** (2 - tweedie.POWER)
        beta = np.linalg.solve(z.T @ (z * w[:, None]) + np.diag(penalty), z.T @ (w * (z @ beta + (y - mu) / mu)))
    return np.exp(z @ beta)


def variant(name, start, end, inputs):
    day = lambda k: tweedie._EPOCH + timedelta(days=k)
    return tweedie.Variant(name, day(start), day(end), tuple(inputs))


def test_all_models_at_once_equal_single_fits(spark, monkeypatch):
    monkeypatch.setattr(tweedie, "HELD_SUMS", 2)
    data = {g: sample(k, 900 + 50 * k) for k, g in enumerate("abcd")}
    data["none"] = [(k, 0.0, [float(k), 1.0, 2.0, 3.0]) for k in range(50)]
    rows = spark.createDataFrame([(g, *r) for g, own in data.items() for r in own], ROWS).repartition(5)
    variants = [variant("all", 0, 59, range(4)), variant("early", 0, 29, range(4)), variant("few", 0, 59, [0, 3])]
    models = tweedie.fit(rows, variants, 4)
    assert len(models) == 15 and all(m.converged for m in models.values())
    for g in "abcd":
        for v in variants:
            own = [r for r in data[g] if v.days[0] <= r[0] <= v.days[1]]
            m = models[g, v.name]
            assert m.n_rows == len(own) and 3 not in m.used  # the constant input is left out
            found = np.exp(m.linear(np.array([r[2] for r in own])))
            assert np.allclose(found, plain_fit(own, list(v.inputs)), rtol=1e-4)
    assert models["none", "all"].beta[0] == -30 and not models["none", "all"].beta[1:].any()
    # in several waves the same models
    monkeypatch.setattr(tweedie, "SENT_BYTES", 800)
    again = tweedie.fit(rows, variants, 4)
    assert all(np.allclose(again[k].beta, m.beta, atol=1e-8) for k, m in models.items())


def test_steps_that_do_not_suffice_are_named(spark):
    rows = spark.createDataFrame([("a", *r) for r in sample(1, 400)], ROWS)
    with pytest.warns(UserWarning, match="1 of 1 regressions have not converged"):
        models = tweedie.fit(rows, [variant("v", 0, 59, range(4))], 4, max_iter=2)
    assert not models["a", "v"].converged and models["a", "v"].steps == 2


def test_rows_without_a_model_have_no_prediction(spark):
    data = sample(2, 300)
    models = tweedie.fit(spark.createDataFrame([("a", *r) for r in data], ROWS), [variant("v", 0, 59, range(4))], 4)
    rows = spark.createDataFrame([("a", 3, 1.0, data[0][2]), ("b", 3, 1.0, data[0][2]), ("a", 99, 1.0, data[0][2])], ROWS)
    day = lambda k: tweedie._EPOCH + timedelta(days=k)
    found = tweedie.predict(rows, models, {"v": (day(0), day(50))}).collect()
    assert {r["group"]: r["prediction"] for r in found}.keys() == {"a", "b"}
    assert [r["prediction"] is None for r in sorted(found, key=lambda r: r["group"])] == [False, True]


def test_target_means_read_the_past_only(spark):
    r = np.random.default_rng(5)
    rows = [
        (f"s{k}", ORIGIN + timedelta(days=int(d)), None if k == 3 and d < 9 else f"c{k % 3}" if k < 5 else None,
         float(r.integers(0, 9)) if d < 50 else None, 1.0 if r.random() < 0.8 else None)
        for k in range(7) for d in range(60)
    ]
    df = spark.createDataFrame(rows, "id string, date date, c string, sales double, sell_price double")
    found = target_stats.with_target_means(df, ["c"], F.col("sell_price").isNotNull(), storage.staged, 10, prior=4)
    assert found.count() == len(rows) and set(found.columns) == {*df.columns, "c_mean"}
    for row in found.collect():
        past = [q for q in rows if q[1] <= row["date"] - timedelta(days=10) and q[3] is not None and q[4] is not None]
        own = [q[3] for q in past if q[2] == row["c"]]
        if not past or not sum(q[3] for q in past):
            assert row["c_mean"] == 0
            continue
        mean = sum(q[3] for q in past) / len(past)
        # a label has sums on the days it occurs; a row always is such a day
        assert row["c_mean"] == pytest.approx(math.log((sum(own) + 4 * mean) / ((len(own) + 4) * mean)))


def mart_rows(panel):
    return panel.filter("sales is not null").withColumns({
        "sell_price": F.lit(2.0) + F.col("day") % 5, "snap": (F.col("day") % 2).cast("int"),
        "event_name_1": F.when(F.col("day") % 50 == 0, "E"), "temp_anomaly": F.sin("day"),
        "is_holiday": (F.col("day") % 30 == 0).cast("int"),
    }).withColumn("sales_lag_28", F.lag("sales", 28).over(series_window()))


@pytest.fixture(scope="module")
def prepared(panel):
    return model.prepare(mart_rows(panel), storage.staged)


def window(first, last):
    return ORIGIN + timedelta(days=first), ORIGIN + timedelta(days=last)


def test_models_per_store(prepared):
    fitted = model.fit_window(prepared, *window(0, 340), window(372, 399), storage.staged, by="store_id")
    assert set(fitted) == {("S_0", "model"), ("S_1", "model")}
    found = model.predict(prepared, fitted, {"model": window(372, 399)}, by="store_id").collect()
    assert len(found) == 4 * 28 and all(r["prediction"] >= 0 for r in found)
    # a store's model equals one fitted on that store alone
    for store in ("S_0", "S_1"):
        alone = model.Prepared(prepared.rows.filter(F.col("store_id") == store), prepared.inputs)
        single = model.fit_window(alone, *window(0, 340), window(372, 399))
        other = {(r["id"], r["date"]): r["prediction"] for r in model.predict(alone, single, {"model": window(372, 399)}).collect()}
        mine = {(r["id"], r["date"]): r["prediction"] for r in found if r["store_id"] == store}
        assert mine == pytest.approx(other, rel=1e-6)
    with pytest.raises(model.EmptyValidationError):
        model.fit_window(prepared, *window(0, 340), window(800, 827))


def test_backtest_of_all_configurations_equals_single_fits(spark, prepared, panel):
    cut = folds.rolling_origin(spark, ORIGIN, ORIGIN + timedelta(days=399), n_folds=3, min_train_days=100)
    configs = {"base": ("weather", "holidays"), "all": ()}
    found = model.backtest(prepared, cut, configs)
    rows = {(r["config"], r["fold"], r["id"], r["date"]): r["prediction"] for r in found.collect()}
    assert len(rows) == 2 * 3 * 4 * 28
    fold = cut[1]
    single = model.fit_window(prepared, fold.train_start, fold.train_end, (fold.val_start, fold.val_end), without=configs["base"])
    assert {prepared.inputs.names[k] for k in single["", "model"].used}.isdisjoint({"temp_anomaly", "is_holiday"})
    for r in model.predict(prepared, single, {"model": (fold.val_start, fold.val_end)}).collect():
        assert rows["base", 1, r["id"], r["date"]] == pytest.approx(r["prediction"], rel=1e-6)
    facts = panel.select("id", "date", "sales")
    scores = model.backtest_scores(found, facts, cut, list(configs)).collect()
    assert {(s["config"], s["fold"]) for s in scores} == {(c, k) for c in configs for k in range(3)}
    for s in scores:
        own = {(i, d): p for (c, k, i, d), p in rows.items() if (c, k) == (s["config"], s["fold"])}
        actual = {(r["id"], r["date"]): r["sales"] for r in facts.collect() if (r["id"], r["date"]) in own}
        assert s["wmape"] == pytest.approx(sum(abs(actual[k] - p) for k, p in own.items()) / sum(actual.values()))
        assert s["n_rows"] == 4 * 28 and s["n_missing"] == 0


def test_any_number_of_labels_is_one_input(spark):
    days = spark.range(60).select(F.date_add(F.lit(ORIGIN), F.col("id").cast("int")).alias("date"), F.col("id").alias("d"))
    items = spark.range(3049).select(F.col("id").alias("k"))
    level = F.lit(1) + F.col("k") % 9
    rows = days.join(items).select(
        F.concat(F.lit("i"), "k").alias("id"), "date", F.concat(F.lit("item"), "k").alias("item_id"), F.lit("S").alias("store_id"),
        F.when(F.col("d") < 46, F.floor(level * (0.5 + F.pmod(F.xxhash64("k", "d"), F.lit(100)) / 100))).alias("sales"),
        F.lit(1.0).alias("sell_price"), (F.col("d") % 7).alias("weekday"), level.alias("level"),
    )
    mart = rows.drop("level")
    ready = model.prepare(mart, storage.staged, horizon=14)
    assert ready.inputs.names == ["weekday", "item_id_mean"]
    fitted = model.fit_window(ready, *window(20, 31), window(32, 45), storage.staged)
    # a coefficient for each item would give its mean over the days of the fit
    first, last = (F.lit(day) for day in window(20, 31))
    one_hot = rows.filter(F.col("date").between(first, last)).groupBy("id").agg(F.avg("sales").alias("own_mean"))
    scored = model.predict(ready, fitted, {"model": window(32, 45)}).join(one_hot, "id")
    ours, theirs = scored.agg(*[F.sum(F.abs(F.col(c) - F.col("sales"))) / F.sum("sales") for c in ("prediction", "own_mean")]).first()
    assert ours < theirs + 0.03 < 0.4


def test_trees_and_importance(prepared):
    trees = model.fit_trees(prepared, *window(0, 340), window(372, 399), max_iter=3)
    rows = prepared.rows.filter(F.col("date") >= F.lit(window(372, 399)[0]))
    assert model.predict_trees(trees, rows).count() == 4 * 28
    fitted = model.fit_window(prepared, *window(0, 340), window(372, 399), storage.staged, by="store_id")
    found = model.feature_importance(fitted, prepared).collect()
    assert sum(r["gain_share"] for r in found) == pytest.approx(1.0) and max(r["n_models"] for r in found) == 2
    weights = defaultdict(float)
    for m in fitted.values():
        for k, b in zip(m.used, m.beta[1:]):
            weights[model._source(prepared.inputs)[k]] += abs(b) / 2
    assert {r["feature"]: r["gain"] for r in found} == pytest.approx(dict(weights))


def test_permutation_importance(spark, prepared, tmp_path):
    cut = folds.rolling_origin(spark, ORIGIN, ORIGIN + timedelta(days=399), n_folds=2, min_train_days=100)
    models, windows = model.fit_folds(prepared, cut, {"all": (), "base": ("weather", "holidays")})
    found = {r["feature"]: r for r in model.permutation_importance(models, prepared, windows).collect()}
    # sources left out of half of the models are scored in the others only
    assert found["snap"]["n_models"] == 4 and found["temp_anomaly"]["n_models"] == 2
    assert max(r["wmape_growth"] for r in found.values()) > 0.01
    rows = prepared.rows.select(F.lit("").alias("group"), "day", F.col("sales").alias("y"), "x")
    plain = {r["variant"]: r for r in tweedie.permuted_errors(rows, models, windows).filter("position = -1").collect()}
    for r in model.predict(prepared, models, windows).groupBy("variant").agg(
            F.sum(F.abs(F.col("prediction") - F.col("sales"))).alias("e"), F.sum("sales").alias("v")).collect():
        assert (plain[r["variant"]]["abs_error"], plain[r["variant"]]["volume"]) == (pytest.approx(r["e"]), r["v"])
    again = {r["feature"]: r for r in model.permutation_importance(models, prepared, windows).collect()}
    assert {k: r["wmape_growth"] for k, r in again.items()} == pytest.approx({k: r["wmape_growth"] for k, r in found.items()})
    model.write_importance(model.feature_importance(models, prepared), str(tmp_path / "csv"))
    rows = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "csv"))
    assert rows.columns == ["feature", "gain", "n_models", "gain_share"] and rows.count() == len(found)


def test_flags_follow_the_pattern_of_missing_values(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("i"), "id").alias("id"), F.lit(ORIGIN).alias("date"), F.lit("S").alias("store_id"), F.lit(1).alias("sales"),
        F.concat(F.lit("item"), "id").alias("item_id"), F.lit("one").alias("dept_id"), F.lit(1.0).alias("sell_price"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("a"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("b"),
        F.when(F.col("id") % 2 == 1, F.lit(1) + F.col("id")).alias("c"), F.lit(5).alias("constant"),
    )
    # a and b are missing on opposite rows, b and c on the same ones
    assert model.inputs_of(rows) == model.Inputs(("a", "b", "c"), ("a", "b"), ("item_id",))
