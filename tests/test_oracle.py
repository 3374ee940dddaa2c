"""Registered queries against their SQL on the smallest data set. SHELFCAST_ALL=1 checks every one."""

from __future__ import annotations

import os

import pytest
from compare import difference

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
CHOSEN = (
    "stg_calendar stg_snap calendar_event_distance first_sale stg_sales_long sales_enriched stg_prices prices_relative "
    "ft_lags ft_rolling ft_lags_min_lag_7 rolling_agg ft_weather weather_future_fill ft_holidays ft_long_weekend "
    "parse_weather_json parse_holidays_json mart_inference lag_audit leakage_stability fold_assignment "
    "baselines_all_folds score_forecast error_analysis wrmsse_total metrics_report publish_forecast_idempotent "
    "actual_accuracy prediction_drift dq_invariants validate_sales_long forecast_explorer overview_tiles"
).split()


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test data not present")
@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("SHELFCAST_ALL") else CHOSEN)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, DATA), SQL[name], DATA) is None
