"""Weather features and the filling of days beyond the forecast range."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import flag

FEATURES = (
    "temperature_2m_mean", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "snowfall_sum",
    "windspeed_10m_max", "temp_anomaly", "precip_anomaly", "hdd", "cdd", "is_heavy_rain", "is_snow_day",
    "is_hot_day", "is_freezing_day", "temp_change_1d", "temp_mean_7d", "weather_source",
)
SCHEMA = (
    "state_id string, date date, temperature_2m_max double, temperature_2m_min double, "
    "temperature_2m_mean double, apparent_temperature_max double, precipitation_sum double, "
    "snowfall_sum double, windspeed_10m_max double, shortwave_radiation_sum double, source string"
)


def climate_norms(weather: DataFrame) -> DataFrame:
    """Mean temperature and precipitation by state and day of year, archive days only."""
    return (
        weather.filter(F.col("source") == "archive")
        .groupBy("state_id", F.dayofyear("date").alias("dayofyear"))
        .agg(F.avg("temperature_2m_mean").alias("temp_norm"), F.avg("precipitation_sum").alias("precip_norm"))
    )


def precip_p90(weather: DataFrame) -> DataFrame:
    """Exact interpolated 90th percentile of daily precipitation by state, archive days only."""
    return (
        weather.filter(F.col("source") == "archive")
        .groupBy("state_id")
        .agg(F.percentile("precipitation_sum", 0.9).alias("precip_p90"))
    )


def weather_features(weather: DataFrame, base_temperature: float = 18.0) -> DataFrame:
    """Anomalies, degree days, flags and short trends per (state, date).

    All windows share one shuffle by state. The table holds one row per state and day, so a window
    is as long as the calendar. Norms and the percentile use the whole archive, also later days.
    """
    archive = F.col("source") == "archive"
    temperature, rain = F.col("temperature_2m_mean"), F.col("precipitation_sum")
    state = Window.partitionBy("state_id")
    day_of_year = Window.partitionBy("state_id", "_doy")
    ordered = Window.partitionBy("state_id").orderBy("date")
    return (
        weather.withColumn("_doy", F.dayofyear("date"))
        .withColumn("_p90", F.percentile(F.when(archive, rain), 0.9).over(state))
        .withColumn("_temp_norm", F.avg(F.when(archive, temperature)).over(day_of_year))
        .withColumn("_rain_norm", F.avg(F.when(archive, rain)).over(day_of_year))
        .withColumns({
            "weather_source": F.col("source"),
            "temp_anomaly": temperature - F.col("_temp_norm"),
            "precip_anomaly": rain - F.col("_rain_norm"),
            # greatest skips NULL, so an unknown temperature gives 0
            "hdd": F.greatest(F.lit(base_temperature) - temperature, F.lit(0.0)),
            "cdd": F.greatest(temperature - F.lit(base_temperature), F.lit(0.0)),
            "is_heavy_rain": flag(rain > F.col("_p90")),
            "is_snow_day": flag(F.col("snowfall_sum") > 0),
            "is_hot_day": flag(F.col("temperature_2m_max") > 30),
            "is_freezing_day": flag(F.col("temperature_2m_min") < 0),
            "temp_change_1d": temperature - F.lag(temperature).over(ordered),
            "temp_mean_7d": F.avg(temperature).over(ordered.rowsBetween(-6, 0)),
        })
        .drop("_doy", "_p90", "_temp_norm", "_rain_norm", "source")
    )


def smoothed_norms(weather: DataFrame, half_width: int = 7) -> DataFrame:
    """Climate norms averaged over `half_width` days of the year on either side, around the year's end.

    Each norm is handed to the days it contributes to, so the circular window is a plain aggregation.
    """
    days_in_year = 366
    target = F.explode(F.sequence(F.lit(-half_width), F.lit(half_width)))
    return (
        climate_norms(weather)
        .select("state_id", "dayofyear", "temp_norm", "precip_norm", target.alias("offset"))
        .groupBy(
            "state_id",
            (F.pmod(F.col("dayofyear") - 1 + F.col("offset"), F.lit(days_in_year)) + 1).alias("dayofyear"),
        )
        .agg(F.avg("temp_norm").alias("temp_norm"), F.avg("precip_norm").alias("precip_norm"))
    )


def future_weather(weather: DataFrame, as_of: date, horizon: int = 28, forecast_days: int = 16) -> DataFrame:
    """Weather of the forecast days: the forecast while it reaches, the smoothed norm beyond; `source` says which."""
    offset = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    days = (
        weather.select("state_id").distinct().select("state_id", offset.alias("horizon"))
        .withColumn("date", F.date_add(F.lit(as_of), F.col("horizon")))
        .withColumn("dayofyear", F.dayofyear("date"))
    )
    forecast = weather.filter(
        # observations of those days are not known when the forecast is made
        (F.col("source") == "forecast") & F.col("date").between(
            F.date_add(F.lit(as_of), 1), F.date_add(F.lit(as_of), min(forecast_days, horizon))
        )
    ).select(
        "state_id", "date", F.col("temperature_2m_mean").alias("t"), F.col("precipitation_sum").alias("p")
    )
    known = F.col("t").isNotNull()
    return (
        days.join(forecast, ["state_id", "date"], "left")
        .join(smoothed_norms(weather.filter(F.col("date") <= F.lit(as_of))), ["state_id", "dayofyear"], "left")
        .select(
            "state_id", "date", "horizon",
            F.coalesce("t", "temp_norm").alias("temperature_2m_mean"),
            F.coalesce("p", "precip_norm").alias("precipitation_sum"),
            F.when(known, "forecast").otherwise("climatology").alias("source"),
        )
    )


def known_at(issues: DataFrame, origins: Sequence[date], values: Sequence[str], keys=("state_id", "date")) -> DataFrame:
    """What was known of each day at each origin: the values of the latest issue up to the origin, by (as_of, *keys).

    `issues` hold one row for each key and `issue_date`: forecasts made before the day, observations made after it. Every issue is
    handed to the origins it was known at and the latest is kept map-side, so no issue is compared with another.
    """
    known = F.filter(F.array(*[F.lit(o) for o in origins]), lambda o: o >= F.col("issue_date"))
    latest = F.max_by(F.struct("issue_date", *values), "issue_date").alias("latest")
    return (
        issues.withColumn("as_of", F.explode(known)).groupBy("as_of", *keys).agg(latest).select("as_of", *keys, "latest.*")
    )
