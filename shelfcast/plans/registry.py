"""Every operator as a named query over one data directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from shelfcast.functions import metrics as m
from shelfcast.functions.columns import SERIES
from shelfcast.operators import baselines, folds, forecast, holidays, lags, mart, model, monitoring
from shelfcast.operators import calendar as cal
from shelfcast.operators import prices as price_ops
from shelfcast.operators import quality, sales, scoring, serving, weather, wrmsse
from shelfcast.sources import external, storage, tables
from shelfcast.sources.storage import staged
from shelfcast.sources.tpch_retail import CATEGORY_OF_DEPARTMENT, COUNTRY, FIRST_WEEK, STATES, RetailTables

Query = Callable[[RetailTables], DataFrame]
QUERIES: dict[str, Query] = {}
N_ORIGINS = 6
#: Days that `history_cut` keeps.
HISTORY_DAYS = 1200


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def six_decimals(c):
    """Half away from zero in plain arithmetic (`round` goes through a decimal per value); never -0.0."""
    size = F.abs(c)
    quick = F.signum(c) * F.floor(F.least(size, F.lit(1e9)) * 1e6 + 0.5) / F.lit(1e6) + F.lit(0.0)
    return F.when(size < 1e9, quick).otherwise(F.round(c, 6))


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to six decimals, whole numbers as long."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            c = six_decimals(c.cast("double"))
        elif isinstance(f.dataType, IntegralType):
            c = c.cast("long")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(fn: Query):
        return lambda spark, sf_dir: tidy(fn(RetailTables(spark, sf_dir)))

    return {name: run(fn) for name, fn in QUERIES.items()}


# ---------------------------------------------------------------- staging


@query
def stg_calendar(r):
    return r.calendar


@query
def stg_snap(r):
    return cal.snap_by_state(r.calendar)


@query
def calendar_event_distance(r):
    return r.days.select("date", "days_to_next_event", "days_since_prev_event")


@query
def day_index_roundtrip(r):
    return r.facts.select(
        "id", "date", cal.date_to_day_index(r.first_day, F.col("date")).alias("day_index")
    ).withColumn("date_again", cal.day_index_to_date(r.first_day, F.col("day_index")))


@query
def history_cut(r):
    """The one query that cuts the history; all others read it whole."""
    start = sales.history_start(r.last_day, r.first_day, HISTORY_DAYS)
    return r.facts.filter(F.col("date") >= F.lit(start)).select("id", "date", "sales")


@query
def stg_hierarchy(r):
    return r.hierarchy()


@query
def first_sale(r):
    return sales.first_sale(r.known_facts)


@query
def unpivot_wide_to_long(r):
    return sales.unpivot_days(r.raw_wide())


@query
def stg_sales_long(r):
    return sales.sales_long(r.raw_wide(), r.calendar)


@query
def series_day_grid(r):
    return sales.series_day_grid(r.series, r.panel_start, r.last_day).select("id", "date")


@query
def sales_enriched(r):
    return r.enriched.drop("last_sale_date", "n_nonzero_days")


@query
def stg_prices(r):
    return price_ops.stage_prices(r.raw_prices)


@query
def stg_prices_as_of_safe(r):
    return price_ops.stage_prices(r.raw_prices, as_of_safe=True)


@query
def prices_relative(r):
    return r.prices.select(*SERIES, "wm_yr_wk", *sales.RELATIVE_PRICE_COLUMNS)


# ---------------------------------------------------------------- features


@query
def ft_lags(r):
    return lags.add_lags(r.panel).select("id", "date", *lags.lag_columns())


@query
def ft_rolling(r):
    return lags.add_rolling(r.panel).select("id", "date", *lags.ROLLING_COLUMNS)


def _direct_features(r, min_lag: int) -> DataFrame:
    """Features for the group of horizons up to `min_lag` days, each with its own nearest lag."""
    features = lags.add_rolling(lags.add_lags(r.panel, min_lag), min_lag)
    return features.select("id", "date", *lags.lag_columns(min_lag), *lags.ROLLING_COLUMNS)


@query
def ft_lags_min_lag_7(r):
    return _direct_features(r, 7)


@query
def ft_lags_min_lag_14(r):
    return _direct_features(r, 14)


@query
def ft_lags_min_lag_21(r):
    return _direct_features(r, 21)


@query
def dept_cat_daily(r):
    departments = lags.daily_totals(r.panel, ["store_id", "cat_id", "dept_id"])
    categories = lags.daily_totals(r.panel, ["store_id", "cat_id"]).withColumnRenamed("sales", "cat_sales")
    return departments.withColumnRenamed("sales", "dept_sales").join(categories, ["store_id", "cat_id", "date"])


@query
def rolling_agg(r):
    return lags.group_rolling(r.panel)


@query
def climate_norms(r):
    return weather.climate_norms(r.weather)


@query
def precip_p90(r):
    return weather.precip_p90(r.weather)


@query
def ft_weather(r):
    return weather.weather_features(r.weather)


@query
def weather_future_fill(r):
    return weather.future_weather(r.weather, r.as_of, r.horizon)


@query
def weather_known_at(r):
    """The weeks around three origins, as each of them saw them."""
    values = ("temperature_2m_mean", "precipitation_sum", "source")
    known = weather.known_at(r.weather_issues(), r.origins(3), values)
    return known.filter(F.datediff("date", "as_of").between(-6, r.horizon))


@query
def ft_holidays(r):
    return r.holiday_features()


@query
def ft_long_weekend(r):
    return holidays.with_long_weekend(r.holiday_features()).select("date", "state_id", "is_long_weekend")


@query
def compare_events(r):
    return holidays.compare_events(r.holidays, r.calendar)


@query
def parse_weather_json(r):
    return external.parse_weather(r.weather_payloads())


@query
def parse_holidays_json(r):
    return external.parse_holidays(r.holiday_payloads(), STATES, COUNTRY)


# ---------------------------------------------------------------- mart


@query
def mart_train(r):
    return r.mart("train")


@query
def mart_inference(r):
    return r.mart("inference")


@query
def mart_without_external(r):
    return r.mart("train", external=False)


@query
def mart_store_filter(r):
    return r.mart("train", stores=_first_stores(r, 2))


@query
def mart_price_extras(r):
    panel = r.panel.join(r.days.select("date", "wm_yr_wk"), "date")
    return mart.with_assortment_features(panel, r.prices, r.days).select(
        "id", "date", "price_rel_store_mean", "days_since_first_price"
    )


@query
def load_mart_window(r):
    start = r.as_of - timedelta(days=27)
    return tables.load_mart(r.stored_mart(), start, r.as_of, _first_stores(r, 1))


@query
def load_sales_window(r):
    return tables.load_sales(r.panel, r.as_of - timedelta(days=89), r.as_of)


@query
def data_bounds(r):
    return tables.data_bounds(r.panel)


@query
def list_stores(r):
    return tables.list_stores(r.panel.filter(F.col("days_since_first_sale") >= 0))


@query
def feature_matrix(r):
    """Model input: features in the mart's order, categories as indexes frozen before `as_of`."""
    rows = r.stored_mart()
    categorical = [c for c in mart.feature_columns(rows) if c in mart.CATEGORICAL]
    known = rows.filter(F.col("sales").isNotNull())
    # a column without any value has nothing to index
    found = known.agg(*[F.count(c).alias(c) for c in categorical]).first()
    categorical = [c for c in categorical if found[c]]
    indexed = model.category_index(known, categorical).transform(rows)
    texts = {name for name, kind in rows.dtypes if kind == "string"}
    numeric = [c for c in mart.feature_columns(rows) if c not in mart.CATEGORICAL and c not in texts]
    return indexed.select("id", "date", *numeric, *[f"{c}_index" for c in categorical])


# ---------------------------------------------------------------- audits


@query
def lag_audit(r):
    return quality.lag_audit(lags.add_rolling(lags.add_lags(r.panel)), r.panel)


@query
def leakage_guard(r):
    """The inference mart of an origin in the past, whose later facts the panel knows, and the panel itself."""
    revealed = staged(r.full_panel(), "revealed")
    cases = {"inference_mart": r.mart("inference", panel=revealed), "revealed_panel": revealed}
    parts = [quality.leakage_guard(rows, r.as_of).withColumn("case", F.lit(name)) for name, rows in cases.items()]
    return parts[0].unionByName(parts[1])


@query
def leakage_stability(r):
    """Later sales are changed; no feature of the mart may move up to a horizon after `as_of`, on days it knows."""
    before = r.full_panel()
    after = before.withColumn(
        "sales", F.when(F.col("date") > F.lit(r.as_of), F.col("sales") + 1000).otherwise(F.col("sales"))
    )
    marts = [staged(r.mart(panel=panel, as_of=r.last_day), "mart") for panel in (before, after)]
    return quality.leakage_stability(*marts, mart.feature_columns(marts[0]), r.as_of)


def _folds(r) -> list:
    return folds.rolling_origin(r.spark, r.panel_start, r.as_of, r.horizon)


def _known(r) -> DataFrame:
    return r.panel.filter(F.col("sales").isNotNull())


@query
def fold_table(r):
    return folds.fold_table(r.spark, _folds(r))


@query
def fold_assignment(r):
    return folds.assign_folds(_known(r), _folds(r)).groupBy("fold", "period", "id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("sales").alias("sales"),
    )


@query
def fold_period_counts(r):
    return folds.assign_folds(_known(r), _folds(r)).groupBy("fold", "period").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def stage_row_counts(r):
    return r.panel.agg(
        F.count_if(F.col("sales").isNotNull()).alias("known_rows"),
        F.count_if(F.col("sales").isNull()).alias("future_rows"),
        F.count_if(F.col("days_since_first_sale") >= 0).alias("mart_rows"),
        F.count(F.lit(1)).alias("panel_rows"),
    )


# ---------------------------------------------------------------- baselines and scores


def _baseline(name: str):
    def run(r):
        return baselines.BASELINES[name](r.history([r.as_of]), [r.as_of], r.horizon)

    return run


QUERIES["baseline_seasonal_naive"] = _baseline("seasonal_naive")
QUERIES["baseline_moving_average"] = _baseline("moving_average")
QUERIES["baseline_dow_mean"] = _baseline("dow_mean")


def _baseline_scores(r) -> DataFrame:
    cut = _folds(r)
    origins = [f.origin for f in cut]
    recent = staged(r.history([*origins, r.as_of]).select("id", "date", "sales"), "history")
    preds = baselines.all_baselines(recent, origins, r.horizon)
    facts = folds.assign_folds(recent, cut, ("validation",))
    return scoring.score_baselines(facts, preds, list(baselines.BASELINES))


@query
def baselines_all_folds(r):
    return _baseline_scores(r)


@query
def backtest_baselines(r):
    return _baseline_scores(r).filter(F.col("baseline") == "dow_mean").select("fold", *scoring.METRICS, "n_rows")


@query
def backtest_summary(r):
    return scoring.fold_summary(_baseline_scores(r), ["baseline"])


@query
def beats_baseline(r):
    scores = staged(_baseline_scores(r), "scores")
    return scoring.beats_baseline(
        scores.filter(F.col("baseline") == "dow_mean"), scores.filter(F.col("baseline") == "seasonal_naive"),
        min_improvement=0.01,
    )


@query
def compare_models(r):
    return scoring.compare_models(_baseline_scores(r).withColumnRenamed("baseline", "config"), "seasonal_naive")


def _preds(r, name: str = "dow_mean") -> DataFrame:
    return r.forecasts([r.as_of], name)


@query
def score_forecast(r):
    """Against all facts, with the forecasts of the second half missing."""
    partial = _preds(r).filter(F.col("horizon") <= r.horizon // 2)
    return scoring.score(r.actuals(), partial)


@query
def metrics_simple(r):
    return scoring.score(r.actuals(), _preds(r), by=["store_id"])


@query
def horizon_breakdown(r):
    return scoring.horizon_breakdown(r.actuals().select("id", "date", "sales"), _preds(r))


@query
def error_analysis(r):
    return scoring.error_analysis(r.actuals().select("id", "date", "sales"), _preds(r), staged)


@query
def worst_series(r):
    return scoring.error_by_series(r.actuals().select("id", "date", "sales"), _preds(r)).orderBy(
        F.desc("abs_error"), "id"
    ).limit(50)


def _matched(r) -> DataFrame:
    """Facts after `as_of` with their forecast, stored: every level and bucket reads them."""
    preds = _preds(r).select("id", "date", "horizon", "prediction")
    return staged(r.actuals().join(preds, ["id", "date"], "left"), "actuals_with_forecast")


def _scales(r) -> DataFrame:
    return wrmsse.scales(r.known_facts, r.as_of, staged)


def _weights(r) -> DataFrame:
    week = cal.week_of(r.first_day, F.col("date"), FIRST_WEEK).alias("wm_yr_wk")
    recent = r.known_facts.filter(F.col("date") > F.date_sub(F.lit(r.as_of), 28)).select(*SERIES, "date", "sales", week)
    priced = recent.join(r.raw_prices.select(*SERIES, "wm_yr_wk", "sell_price"), [*SERIES, "wm_yr_wk"], "left")
    return wrmsse.weights(r.series, priced, r.as_of, staged)


@query
def rmsse_by_series(r):
    return wrmsse.wrmsse_by_series(_matched(r), _scales(r), _weights(r), staged).select("level", "key", "mse", "scale", "rmsse")


@query
def wrmsse_scale(r):
    """The states of all days but the last four weeks, joined with those of these weeks."""
    eve = F.date_sub(F.lit(r.as_of), 28)
    parts = [wrmsse.scale_states(r.known_facts.filter(side), staged) for side in (F.col("date") <= eve, F.col("date") > eve)]
    return wrmsse.scales_of(wrmsse.join_states(*parts), r.as_of)


@query
def wrmsse_weights(r):
    return _weights(r)


@query
def wrmsse_by_level(r):
    return wrmsse.wrmsse_by_level(_matched(r), _scales(r), _weights(r), staged)


@query
def wrmsse_total(r):
    return wrmsse.wrmsse(_matched(r), _scales(r), _weights(r), staged)


@query
def metrics_report(r):
    matched = _matched(r)
    return scoring.metrics_report(matched, wrmsse.wrmsse(matched, _scales(r), _weights(r), staged))


@query
def promotion_gate(r):
    parts = []
    for role, name in (("production", "seasonal_naive"), ("candidate", "dow_mean")):
        parts.append(scoring.score(r.actuals(), _preds(r, name)).select(
            F.lit(role).alias("role"), F.lit(f"{name}-1").alias("model_version"), "wmape"
        ))
    return scoring.promotion_gate(parts[0].unionByName(parts[1]))


# ---------------------------------------------------------------- forecasts


@query
def clamp_as_of(r):
    return forecast.clamp_as_of(r.last_day, tables.data_bounds(r.panel))


@query
def inference_grid(r):
    return forecast.inference_grid(r.series, r.as_of, r.horizon)


def _with_price(r, preds: DataFrame) -> DataFrame:
    keyed = preds.join(r.days.select("date", "wm_yr_wk"), "date")
    prices = r.raw_prices.select(*SERIES, "wm_yr_wk", "sell_price")
    return keyed.join(prices, [*SERIES, "wm_yr_wk"], "left").drop("wm_yr_wk")


@query
def post_process(r):
    """A trend forecast that goes below zero for falling series."""
    shifted = _preds(r).withColumn("prediction", F.col("prediction") - 2)
    return forecast.post_process(_with_price(r, shifted)).select("id", "date", "sell_price", "prediction")


@query
def forecast_rows(r):
    raw = _preds(r).select("id", "item_id", "store_id", "date", "prediction")
    return forecast.stamp(raw, r.as_of, "dow_mean-1", "run-dow_mean").select(*forecast.COLUMNS)


@query
def forecast_sanity(r):
    recent = tables.load_sales(r.panel, r.as_of - timedelta(days=r.horizon - 1), r.as_of)
    return forecast.sanity_checks(_preds(r), recent, r.horizon)


def _publish_folder(r, name: str) -> str:
    import uuid

    return f"{storage.shared_dir(r.spark)}/shelfcast/{uuid.uuid4().hex}/{name}"


def _hours_after(day: str, hours: int):
    """A wall-clock time, in place of the present one, so that a run can be repeated."""
    return F.col(day).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def _as_text(time: str):
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias(time)


@query
def publish_forecast_idempotent(r):
    """Two origins are published, the newer one twice; its rows must not double nor the older ones vanish."""
    path = _publish_folder(r, "forecast")
    newest, older = r.origins(2)
    both = staged(r.forecasts([newest, older]), "forecasts")
    forecast.publish(both, path, at=_hours_after("as_of", 30))
    forecast.publish(both.filter(F.col("as_of") == F.lit(newest)), path, at=_hours_after("as_of", 42))
    return forecast.forecast_table(r.spark, path).read().select(*forecast.COLUMNS, _as_text("created_at"))


@query
def publish_accuracy_idempotent(r):
    """The accuracy of each origin's first fifteen days, then of those from the eighth on: shared days are replaced."""
    path = _publish_folder(r, "accuracy")
    accuracy = staged(_accuracy(r), "accuracy")
    monitoring.publish_accuracy(accuracy.filter("horizon <= 15"), path, _hours_after("as_of", 400))
    monitoring.publish_accuracy(accuracy.filter("horizon >= 8"), path, _hours_after("as_of", 700))
    return monitoring.accuracy_table(r.spark, path).read().select(*accuracy.columns, _as_text("computed_at"))


@query
def submission_pivot(r):
    return forecast.submission(_preds(r), r.horizon)


# ---------------------------------------------------------------- monitoring


def _history_of_forecasts(r) -> DataFrame:
    return r.forecasts(r.origins(N_ORIGINS))


def _facts_of_forecasts(r) -> DataFrame:
    return r.facts_after(min(r.origins(N_ORIGINS))).select("id", "date", "sales")


def _accuracy(r) -> DataFrame:
    return monitoring.actual_accuracy(_history_of_forecasts(r), _facts_of_forecasts(r), r.series, staged)


@query
def actual_accuracy(r):
    return _accuracy(r)


@query
def accuracy_trend(r):
    return monitoring.accuracy_trend(monitoring.period_scores(_history_of_forecasts(r), _facts_of_forecasts(r)), 4)


@query
def should_retrain(r):
    return monitoring.should_retrain(
        monitoring.period_scores(_history_of_forecasts(r), _facts_of_forecasts(r))
    )


@query
def prediction_drift(r):
    return monitoring.prediction_drift(staged(_history_of_forecasts(r), "forecasts"))


@query
def weather_source_mix(r):
    return monitoring.weather_source_mix(
        r.weather, r.as_of - timedelta(days=27), r.as_of + timedelta(days=r.horizon), ["state_id"]
    )


@query
def external_freshness(r):
    return monitoring.external_freshness(r.weather, r.holidays, r.as_of)


def _drift(r) -> DataFrame:
    rows = r.stored_mart().filter(F.col("date") <= F.lit(r.as_of))
    numeric, categorical = model.split_columns(rows)
    recent = F.col("date") > F.date_sub(F.lit(r.as_of), r.horizon)
    return monitoring.data_drift(rows.filter(~recent), rows.filter(recent), numeric, categorical)


@query
def reference_sample(r):
    """A bounded sample of the known rows of each store, from samples of both halves of the history."""
    known = r.panel.filter(F.col("sales").isNotNull()).select("store_id", "id", "date", "sales")
    halves = [known.filter(F.year("date") % 2 == parity) for parity in (0, 1)]
    parts = [monitoring.reference_sample(half, 100) for half in halves]
    return monitoring.reference_sample(parts[0].unionByName(parts[1]), 100)


@query
def data_drift(r):
    return _drift(r)


@query
def drift_decision(r):
    predictions = monitoring.prediction_drift(staged(_history_of_forecasts(r), "forecasts"))
    return monitoring.drift_decision(
        _drift(r), monitoring.external_freshness(r.weather, r.holidays, r.as_of), predictions
    )


# ---------------------------------------------------------------- quality


def _rules() -> dict[str, quality.RuleSet]:
    """Member sets and ranges narrower than the data, so that the rules have something to find."""
    return quality.rule_sets(STATES[:4], list(CATEGORY_OF_DEPARTMENT.values())[:1], (11101, 11400), (1996, 2000), 21)


@query
def validate_calendar(r):
    return quality.validate(r.raw_calendar, _rules()["calendar"])


@query
def validate_prices(r):
    doubled = r.raw_prices.unionByName(r.raw_prices.filter(F.col("sell_price") < 1000))
    return quality.validate(doubled, _rules()["sell_prices"])


@query
def validate_sales_long(r):
    broken = r.panel.withColumn("sales", F.when(F.col("sales") == 13, F.lit(-13)).otherwise(F.col("sales")))
    return quality.validate(broken, _rules()["sales_long"])


@query
def validate_features(r):
    return quality.validate(sales.with_price_columns(r.panel, r.days, r.prices), _rules()["features"])


@query
def validate_predictions(r):
    return quality.validate(
        _preds(r).withColumn("prediction", F.nullif(F.col("prediction") - 1, F.lit(0.0))), _rules()["predictions"]
    )


@query
def validate_weather(r):
    return quality.validate(r.weather, _rules()["weather"])


@query
def validate_holidays(r):
    return quality.validate(r.holidays, _rules()["holidays"])


@query
def dq_invariants(r):
    """On the panel with some sales made negative and one weekday removed."""
    broken = sales.with_price_columns(r.panel, r.days, r.prices).filter(F.col("date") != F.lit(r.as_of))
    return quality.invariants(
        broken.withColumn("sales", F.when(F.col("sales") == 13, F.lit(-13)).otherwise(F.col("sales"))), staged, (*SERIES, "date")
    )


@query
def calendar_gaps_by_series(r):
    """On the sparse facts, where every quiet day is a gap."""
    return quality.calendar_gaps_by_series(r.facts)


# ---------------------------------------------------------------- read side


def _stores(r) -> list[str]:
    return [row.store_id for row in r.series.select("store_id").distinct().orderBy("store_id").collect()]


def _first_stores(r, n: int) -> list[str]:
    return _stores(r)[:n]


def _first_store(r) -> str:
    return _first_stores(r, 1)[0]


def _first_series(r) -> str:
    return r.series.agg(F.min("id")).first()[0]


@query
def forecast_for_pair(r):
    return serving.forecast_for_pair(r.forecasts(r.origins(2)), "ECONOMY", _first_store(r))


@query
def forecast_for_store(r):
    start = r.as_of + timedelta(days=8)
    return serving.forecast_for_store(
        r.forecasts(r.origins(2)), _first_store(r), r.as_of, start, start + timedelta(days=6)
    )


@query
def forecast_health(r):
    return serving.forecast_health(r.forecasts(r.origins(2)), r.last_day)


@query
def overview_tiles(r):
    return serving.overview_tiles(_history_of_forecasts(r), _facts_of_forecasts(r))


@query
def forecast_explorer(r):
    return serving.forecast_explorer(r.panel, r.forecasts(r.origins(2)), _first_series(r), r.as_of)


@query
def forecast_coverage(r):
    return serving.forecast_coverage(_history_of_forecasts(r))


@query
def store_day_forecast(r):
    return serving.store_day_forecast(_preds(r))


@query
def top_series(r):
    return serving.top_series(_preds(r))


@query
def recent_history(r):
    return serving.recent_history(r.panel, _first_series(r))


@query
def store_forecast_head(r):
    return serving.store_head(_preds(r), _first_store(r))


# ---------------------------------------------------------------- files


@query
def table_stats(r):
    return storage.table_stats({
        "facts": r.facts, "calendar": r.raw_calendar, "prices": r.raw_prices,
        "hierarchy": r.hierarchy(), "weather": r.weather,
    })


@query
def csv_roundtrip_typed(r):
    """Prices to CSV, back with explicit types, to Parquet."""
    csv, parquet = _publish_folder(r, "prices_csv"), _publish_folder(r, "prices_parquet")
    r.raw_prices.select("store_id", "item_id", "wm_yr_wk", "sell_price").write.option("header", True).csv(csv)
    return storage.csv_to_parquet(r.spark, csv, parquet, storage.PRICES_SCHEMA)


@query
def export_partitioned(r):
    """The enriched panel by store, read back with partition values as columns."""
    path = _publish_folder(r, "enriched")
    storage.write_layer(r.enriched.select("id", "date", "sales", "sell_price", "store_id"), path, ["store_id"])
    return r.spark.read.parquet(path).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales")
    )


@query
def dataset_fingerprint(r):
    names = ["lineitem", "orders", "part", "supplier", "nation", "region", "customer", "events"]
    return storage.fingerprint({n: r.table(n) for n in names})


# ---------------------------------------------------------------- models


def _model_mart(r) -> DataFrame:
    return r.stored_mart()


def _fit_newest(r, prepared: model.Prepared, by: str | None = None):
    """Models fitted before the newest fold's gap, and the fold."""
    fold = _folds(r)[0]
    return model.fit_window(
        prepared, fold.train_start, fold.train_end, (fold.val_start, fold.val_end), staged, by=by
    ), fold


def _scored_by_store(r, by: str | None) -> DataFrame:
    prepared = model.prepare(_model_mart(r), staged)
    fitted, fold = _fit_newest(r, prepared, by)
    scored = model.predict(prepared, fitted, {"model": (fold.val_start, fold.val_end)}, by)
    return scored.filter(F.col("sales").isNotNull()).groupBy("store_id").agg(*m.simple_metrics(), F.count(F.lit(1)).alias("n_rows"))


@query
def model_fit_score(r):
    """Fit before the newest fold's gap, score on its validation window."""
    return _scored_by_store(r, None)


@query
def model_by_store(r):
    """One model a store for all stores, each store's rows predicted by its own."""
    return _scored_by_store(r, "store_id")


@query
def forecast_publish(r):
    """Fit, predict the horizon, check, publish, read back."""
    rows = _model_mart(r)
    prepared = model.prepare(rows, staged)
    fitted, _ = _fit_newest(r, prepared)
    first, last = r.as_of + timedelta(days=1), r.as_of + timedelta(days=r.horizon)
    raw = model.predict(prepared, fitted, {"model": (first, last)}).join(r.series.select("id", "item_id"), "id")
    preds = staged(forecast.stamp(raw, r.as_of, "tweedie-1", "run-tweedie").select(*forecast.COLUMNS), "predictions")
    path = _publish_folder(r, "forecast")
    recent = tables.load_sales(rows, r.as_of - timedelta(days=r.horizon - 1), r.as_of)
    # demand of a few series moves by more than the usual range in four weeks
    forecast.publish_checked(preds, recent, path, r.horizon, volume_range=(0.4, 2.5))
    return forecast.forecast_table(r.spark, path).read().select(*forecast.COLUMNS)


#: The external sources that each configuration of the comparison goes without.
CONFIGS = {"base": ("weather", "holidays"), "with_weather": ("holidays",), "with_holidays": ("weather",), "all": ()}


def _backtest(r, configs: dict) -> tuple[DataFrame, DataFrame, list]:
    """Scores by configuration and fold, the facts and the folds."""
    rows, cut = _model_mart(r), _folds(r)
    known = rows.filter(F.col("sales").isNotNull()).select("id", "date", "sales")
    predictions = model.backtest(model.prepare(rows, staged), cut, configs)
    return model.backtest_scores(predictions, known, cut, list(configs)), known, cut


def _report(r) -> DataFrame:
    scores, known, cut = _backtest(r, {"all": ()})
    baseline = _baseline_scores(r).filter(F.col("baseline") == "dow_mean")
    return scoring.backtest_report(scores.drop("config"), baseline, folds.rows_by_period(known, cut))


@query
def backtest_by_fold(r):
    """The model beside the weekday mean on the same folds, with the rows it was fitted and judged on."""
    return _report(r)


@query
def model_beats_baseline(r):
    """The verdict on the fitted model: its mean over the folds against the baseline's."""
    report = staged(_report(r), "report")
    return scoring.beats_baseline(report, report.select("fold", F.col("baseline_wmape").alias("wmape")))


@query
def feature_importance(r):
    prepared = model.prepare(_model_mart(r), staged)
    return model.feature_importance(_fit_newest(r, prepared)[0], prepared).limit(30)


@query
def permutation_importance(r):
    """Over the models of all folds, on their validation windows."""
    prepared = model.prepare(_model_mart(r), staged)
    models, windows = model.fit_folds(prepared, _folds(r), {"all": ()})
    return model.permutation_importance(models, prepared, windows)


@query
def ablation(r):
    """The same folds without external sources, with each, with both."""
    return scoring.compare_models(_backtest(r, CONFIGS)[0], "base")
