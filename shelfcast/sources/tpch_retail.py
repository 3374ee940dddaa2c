"""The retail shapes derived from the order tables this repository is tested with.

Items are part types, stores are supplier nations, states their regions; a sale is the shipped
quantity of a day. Facts after `as_of` (28 days before the last one) are hidden from the panel
and kept as actuals for scoring.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import SERIES, by_series, lookup, panel_partitions
from shelfcast.operators import baselines as base_ops
from shelfcast.operators import calendar as cal
from shelfcast.operators import holidays as holiday_ops
from shelfcast.operators import mart as mart_ops
from shelfcast.operators import prices as price_ops
from shelfcast.operators import sales as sales_ops
from shelfcast.operators import weather as weather_ops
from shelfcast.sources.external import WEATHER_MEASURES, parse_holidays
from shelfcast.sources.storage import exists, shared_dir, staged, staged_all
from shelfcast.sources.tables import store_mart

# Fixed values of the test mapping.
DEPARTMENT_OF_ITEM = {
    "SMALL": "D_A", "MEDIUM": "D_A",
    "LARGE": "D_B", "STANDARD": "D_B",
    "ECONOMY": "D_C", "PROMO": "D_C",
}
CATEGORY_OF_DEPARTMENT = {"D_A": "C_1", "D_B": "C_1", "D_C": "C_2"}
# Trade events of the mapping, two of a kind, one on a day that is also a holiday.
EVENTS = {
    "02-19": ("StockTaking", "Trade"), "03-31": ("FoundersFair", "Market"), "05-08": ("GardenWeek", "Season"),
    "08-23": ("SchoolStart", "Trade"), "10-14": ("HarvestFair", "Market"), "12-06": ("GiftWeek", "Season"),
}
EVENT_NAMES = {day: name for day, (name, _) in EVENTS.items()}
EVENT_TYPES = {day: kind for day, (_, kind) in EVENTS.items()}
FIRST_WEEK = 11101
STATES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
COUNTRY = "XX"
#: Buckets of items in each folder of the stored mart; the mapping has six items.
MART_BUCKETS = 2
#: Stored marts of this process by session and data.
_STORED: dict[tuple, tuple[str, str, list[str]]] = {}


def benefit_day(state: str, day_of_month: Column) -> Column:
    """Every fifth day of the month pays out, shifted by one from state to state."""
    return (day_of_month + STATES.index(state)) % 5 == 0


class RetailTables:
    """Lazy retail tables over one data directory. Tables with several readers are staged once."""

    def __init__(self, spark: SparkSession, data_dir: str, horizon: int = 28, history_days: int | None = None):
        # Rows per series are bounded by the calendar, so co-locating a join by series alone is safe.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self.spark, self.data_dir = spark, data_dir.rstrip("/")
        self.horizon, self.history_days = horizon, history_days

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    # -- facts

    def _stores(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.col("n_name").alias("store_id"), F.col("r_name").alias("state_id"))
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Quantity and revenue in cents per series and selling day (sparse), the only pass over the line items.

        No broadcast is forced: part and supplier grow with the data, so Spark decides by size and
        splits hot keys of a sort-merge join at run time. Sums are combined map-side before the shuffle.
        """
        lines = self.table("lineitem").select(
            "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity",
            F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"),
        )
        items = self.table("part").select("p_partkey", F.col("p_type").alias("item_id"))
        daily = (
            lines.join(items, F.col("l_partkey") == F.col("p_partkey"))
            .join(self._stores(), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("item_id", "store_id", "state_id", "date")
            .agg(F.sum("l_quantity").cast("long").alias("sales"), F.sum("cents").alias("cents"))
        )
        return staged(with_hierarchy(daily), "facts")

    @cached_property
    def bounds(self) -> tuple[date, date]:
        """First and last day of the line items, from a scan of one column."""
        day = F.to_date("l_shipdate")
        row = self.table("lineitem").agg(F.min(day), F.max(day)).first()
        return row[0], row[1]

    @property
    def first_day(self) -> date:
        return self.bounds[0]

    @property
    def last_day(self) -> date:
        return self.bounds[1]

    @property
    def as_of(self) -> date:
        return self.last_day - timedelta(days=self.horizon)

    @property
    def panel_start(self) -> date:
        return sales_ops.history_start(self.last_day, self.first_day, self.history_days)

    def origins(self, n: int) -> list[date]:
        """The last `n` forecast origins, a horizon apart, the newest first."""
        return [self.as_of - timedelta(days=self.horizon * k) for k in range(n)]

    @cached_property
    def known_facts(self) -> DataFrame:
        return self.facts.filter(F.col("date") <= F.lit(self.as_of))

    def actuals(self) -> DataFrame:
        """The hidden days, dense, for scoring forecasts made at `as_of`."""
        return self.facts_after(self.as_of)

    # -- calendar

    @cached_property
    def raw_calendar(self) -> DataFrame:
        """One row per day of the facts' span. Spark knows the size of the range and broadcasts it by that."""
        n_days = (self.last_day - self.first_day).days + 1
        day = F.col("date")
        month_day = F.date_format(day, "MM-dd")
        index = F.col("id").cast("int") + 1
        return (
            self.spark.range(n_days)
            .withColumn("date", F.date_add(F.lit(self.first_day), F.col("id").cast("int")))
            .select(
                "date",
                F.concat(F.lit("d_"), index).alias("d"),
                (F.lit(FIRST_WEEK) + F.floor((index - 1) / 7).cast("int")).alias("wm_yr_wk"),
                F.date_format(day, "EEEE").alias("weekday"),
                (F.dayofweek(day) % 7 + 1).alias("wday"),
                F.month(day).alias("month"),
                F.year(day).alias("year"),
                lookup(month_day, EVENT_NAMES, "").alias("event_name_1"),
                lookup(month_day, EVENT_TYPES, "").alias("event_type_1"),
                F.lit("").alias("event_name_2"),
                F.lit("").alias("event_type_2"),
                *[
                    benefit_day(s, F.dayofmonth(day)).cast("int").alias(f"{cal.SNAP_PREFIX}{s}")
                    for s in STATES
                ],
            )
        )

    @cached_property
    def calendar(self) -> DataFrame:
        return cal.stage_calendar(self.raw_calendar)

    @cached_property
    def days(self) -> DataFrame:
        """The calendar with event distances, computed once."""
        return staged(cal.with_event_distances(self.calendar), "days")

    # -- series, panel, prices

    def hierarchy(self) -> DataFrame:
        return sales_ops.hierarchy(self.facts)

    @cached_property
    def series(self) -> DataFrame:
        """Series attributes with the selling span known at `as_of`."""
        known = F.when(F.col("date") <= F.lit(self.as_of), F.col("sales"))
        return staged(
            self.facts.withColumn("sales", known)
            .groupBy(*sales_ops.SERIES_COLUMNS)
            .agg(*sales_ops.sale_span()),
            "series",
        )

    @cached_property
    def partitions(self) -> int:
        n_days = (self.last_day - self.panel_start).days + 1
        return panel_partitions(self.series.count(), n_days, self.spark.sparkContext.defaultParallelism)

    @cached_property
    def panel(self) -> DataFrame:
        return self.panel_between(self.panel_start, self.last_day, self.as_of)

    def full_panel(self) -> DataFrame:
        """The panel with the hidden days revealed."""
        return self.panel_between(self.panel_start, self.last_day, self.last_day)

    def panel_between(self, start: date, end: date, known_until: date) -> DataFrame:
        return sales_ops.dense_panel(self.series, self.facts, start, end, known_until, self.partitions)

    @cached_property
    def raw_prices(self) -> DataFrame:
        """Average selling price by week, rounded half up in whole cents; no row where nothing was sold."""
        week = cal.week_of(self.first_day, F.col("date"), FIRST_WEEK)
        return (
            by_series(self.facts.select(*SERIES, week.alias("wm_yr_wk"), "sales", "cents"), self.partitions)
            .groupBy(*SERIES, "wm_yr_wk")
            .agg(F.sum("cents").alias("cents"), F.sum("sales").alias("units"))
            .filter(F.col("units") > 0)
            .select(
                *SERIES, "wm_yr_wk",
                (F.expr("(2 * cents + units) div (2 * units)") / F.lit(100.0)).alias("sell_price"),
            )
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Weekly price features, own history and peers."""
        return price_ops.with_relative_prices(
            price_ops.stage_prices(self.raw_prices), self.series, staged_all
        )

    @cached_property
    def stored_prices(self) -> DataFrame:
        """The weekly prices for a join with the panel, hashed as it is. Stored first: otherwise each task of the panel
        holds the buffers of all sorts and sums that make the prices beside its own."""
        return by_series(staged(self.prices, "prices"), self.partitions)

    @cached_property
    def enriched(self) -> DataFrame:
        return sales_ops.sales_enriched(
            self.panel, self.days, cal.snap_by_state(self.days), self.stored_prices
        )

    def raw_wide(self) -> DataFrame:
        """One row per series, one column per calendar day (d_1..d_N); empty where nothing was sold."""
        n_days = (self.last_day - self.first_day).days + 1
        index = F.concat(F.lit("d_"), cal.date_to_day_index(self.first_day, F.col("date")))
        return (
            self.facts.withColumn("d", index)
            .groupBy(*sales_ops.SERIES_COLUMNS)
            .pivot("d", [f"d_{i}" for i in range(1, n_days + 1)])
            .agg(F.max("sales"))
        )

    # -- forecasts of two versions

    def history(self, origins: list[date]) -> DataFrame:
        """Known days that any origin looks back to."""
        start = max(self.first_day, min(origins) - timedelta(days=base_ops.LOOKBACK_DAYS))
        return self.panel_between(start, max(origins), max(origins))

    def forecasts(self, origins: list[date], baseline: str = "dow_mean") -> DataFrame:
        """Forecasts made at each origin, in the shape of the published table."""
        preds = base_ops.BASELINES[baseline](self.history(origins), origins, self.horizon)
        return preds.join(self.series.select("id", "item_id", "store_id"), "id").select(
            "id", "item_id", "store_id", "date", "horizon", "prediction",
            F.lit(f"{baseline}-1").alias("model_version"), F.lit(f"run-{baseline}").alias("run_id"), "as_of",
        )

    def facts_after(self, origin: date) -> DataFrame:
        """Dense facts of all days after an origin, also the hidden ones."""
        return self.panel_between(origin + timedelta(days=1), self.last_day, self.last_day)

    # -- external sources

    def _order_days(self) -> DataFrame:
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("r_name").alias("state_id"), F.to_date("o_orderdate").alias("date"),
                "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
            )
        )

    @cached_property
    def weather(self) -> DataFrame:
        """Daily weather by state, read off the orders of the day, moved so that the last order falls on the
        last panel day: archive up to `as_of`, 16 days of forecast, climatology after them."""
        last_order = self.table("orders").agg(F.to_date(F.max("o_orderdate"))).first()[0]
        shift = (self.last_day - last_order).days

        def scaled(total: Column, unit: float) -> Column:
            return total.cast("double") / F.lit(unit)

        measures = {
            "temperature_2m_max": scaled(F.max("total"), 9973.0) - 5,
            "temperature_2m_min": scaled(F.min("total"), 9973.0) - 5,
            "temperature_2m_mean": scaled(F.sum("total"), 9973.0) / F.count("total") - 5,
            "apparent_temperature_max": scaled(F.max("total"), 9973.0) - 7,
            "precipitation_sum": scaled(F.min("total"), 997.0),
            "snowfall_sum": F.when(F.min("total") < 10000, F.lit(1.0)).otherwise(F.lit(0.0)),
            "windspeed_10m_max": F.count("total").cast("double"),
            "shortwave_radiation_sum": scaled(F.sum("total"), 99991.0),
        }
        ahead = F.datediff("date", F.lit(self.as_of))
        source = (
            F.when(ahead <= 0, "archive").when(ahead <= 16, "forecast").otherwise("climatology")
        )
        return (
            self._order_days()
            .withColumn("date", F.date_add("date", shift))
            .groupBy("state_id", "date")
            .agg(*[expr.alias(name) for name, expr in measures.items()])
            .withColumn("source", source)
        )

    def weather_issues(self) -> DataFrame:
        """Each day's weather as it was issued: forecasts 1, 5, 9 and 13 days ahead, the further the warmer and the wetter, and
        the observation two days later."""
        lead = F.explode(F.array(*[F.lit(k) for k in (13, 9, 5, 1, -2)])).alias("lead")
        rows = self.weather.select("state_id", "date", "temperature_2m_mean", "precipitation_sum", lead)
        ahead = F.greatest("lead", F.lit(0))
        return rows.select(
            "state_id", "date", F.date_sub("date", F.col("lead")).alias("issue_date"),
            (F.col("temperature_2m_mean") + ahead * F.lit(0.25)).alias("temperature_2m_mean"),
            (F.col("precipitation_sum") + ahead * F.lit(0.5)).alias("precipitation_sum"),
            F.when(F.col("lead") > 0, "forecast").otherwise("archive").alias("source"),
        )

    def event_weather(self) -> DataFrame:
        """Daily weather by event type: archive for days 1-20, forecast 21-26, climatology after."""
        day = F.dayofmonth("date")
        value = F.col("value").cast("decimal(18,2)")
        return (
            self.table("events")
            .select(F.col("event_type").alias("state_id"), F.to_date("ts").alias("date"), value.alias("v"))
            .groupBy("state_id", "date")
            .agg(
                (F.max("v").cast("double") / F.lit(9.973)).alias("temperature_2m_max"),
                (F.min("v").cast("double") / F.lit(9.973)).alias("temperature_2m_min"),
                (F.sum("v").cast("double") / F.lit(9.973) / F.count("v")).alias("temperature_2m_mean"),
                F.min("v").cast("double").alias("precipitation_sum"),
                F.lit(0.0).alias("snowfall_sum"),
                F.count("v").cast("double").alias("windspeed_10m_max"),
            )
            .withColumn(
                "source", F.when(day <= 20, "archive").when(day <= 26, "forecast").otherwise("climatology")
            )
        )

    def weather_payloads(self) -> DataFrame:
        """One JSON document per state and source, its arrays bounded by the days of the source."""
        days = F.sort_array(
            F.collect_list(F.struct(F.col("date").cast("string").alias("time"), *WEATHER_MEASURES))
        )
        daily = F.struct(*[F.col("days")[m].alias(m) for m in ("time", *WEATHER_MEASURES)])
        doc = F.struct(
            F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), F.lit("UTC").alias("timezone"),
            daily.alias("daily"),
        )
        return (
            self.event_weather()
            .groupBy("state_id", "source")
            .agg(days.alias("days"))
            .select("state_id", "source", F.to_json(doc).alias("payload"))
        )

    def holiday_payloads(self) -> DataFrame:
        """One JSON array per year. Nationwide days are those of the list below with any order;
        regional ones list the states with an order of the given priority on that day."""
        month_day = F.date_format("date", "MM-dd")
        named = {
            "01-01": [("New Year's Day", "Public", None)],
            "12-25": [("Christmas Day", "Public", None)],
            "03-31": [("Founders Day", "School", "1-URGENT")],
            "07-04": [("National Day", "Public", None), ("Summer Bank Day", "Bank", "5-LOW")],
        }
        rules = F.lit(None)
        for day, entries in named.items():
            rules = F.when(
                month_day == day,
                F.array(*[
                    F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(p).cast("string").alias("priority"))
                    for n, t, p in entries
                ]),
            ).otherwise(rules)
        counties = F.sort_array(F.collect_set(F.concat(F.lit(f"{COUNTRY}-"), "state_id")))
        entry = F.struct(
            F.col("date").cast("string").alias("date"), F.col("name").alias("localName"), "name",
            F.lit(COUNTRY).alias("countryCode"), F.lit(False).alias("fixed"),
            F.col("priority").isNull().alias("global"),
            F.when(F.col("priority").isNotNull(), F.col("counties")).alias("counties"),
            F.lit(None).cast("int").alias("launchYear"), F.array("type").alias("types"),
        )
        return (
            self._order_days()
            .filter(month_day.isin(*named) & (F.col("date") <= F.lit(self.last_day)))
            .select("date", "state_id", "o_orderpriority", F.inline(rules))
            .filter(F.col("priority").isNull() | (F.col("priority") == F.col("o_orderpriority")))
            .groupBy("date", "name", "type", "priority")
            .agg(counties.alias("counties"))
            .groupBy(F.year("date").alias("year"))
            .agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("payload"))
        )

    @cached_property
    def holidays(self) -> DataFrame:
        return parse_holidays(self.holiday_payloads(), STATES, COUNTRY)

    def weather_features(self) -> DataFrame:
        return weather_ops.weather_features(self.weather)

    def holiday_features(self) -> DataFrame:
        return holiday_ops.holiday_features(self.holidays, self.series, self.first_day, self.last_day)

    # -- mart

    def mart(
        self, mode: str = "train", external: bool = True, panel: DataFrame | None = None, as_of: date | None = None, **options
    ) -> DataFrame:
        """The mart at `as_of`; another panel may be given, for instance with the hidden days revealed."""
        # the calendar and the prices do not depend on each other: stage them at the same time
        self.partitions  # needs series and bounds, which both threads read
        with ThreadPoolExecutor(max_workers=2) as pool:
            in_thread = inheritable_thread_target(self.spark)
            days, prices = pool.submit(in_thread(lambda: self.days)), pool.submit(in_thread(lambda: self.stored_prices))
            days, prices = days.result(), prices.result()
        return mart_ops.build_mart(
            self.panel if panel is None else panel, days, cal.snap_by_state(days), prices,
            self.weather_features() if external else None,
            self.holiday_features() if external else None,
            as_of or self.as_of, mode, self.horizon, stage_all=staged_all, **options,
        )


    def stored_mart(self) -> DataFrame:
        """The mart of training and inference as a stored table, built once in a session: later reads open what they need."""
        key = (self.spark.sparkContext.applicationId, self.data_dir, self.horizon)
        if key not in _STORED or not exists(self.spark, _STORED[key][1]):
            name = f"mart_{uuid.uuid4().hex}"
            mart, path = self.mart("inference"), f"{shared_dir(self.spark)}/shelfcast/{name}"
            store_mart(mart, name, path, MART_BUCKETS)
            _STORED[key] = name, path, mart.columns
        name, _, columns = _STORED[key]
        # partition columns come last in what Spark reads
        return self.spark.table(name).select(*columns)


def with_hierarchy(df: DataFrame) -> DataFrame:
    """Series label, department and category from item and store."""
    return df.withColumn("dept_id", lookup(F.col("item_id"), DEPARTMENT_OF_ITEM)).select(
        F.concat_ws("_", "item_id", "store_id").alias("id"),
        "item_id",
        "dept_id",
        lookup(F.col("dept_id"), CATEGORY_OF_DEPARTMENT).alias("cat_id"),
        *[c for c in df.columns if c not in ("item_id", "dept_id")],
    )
