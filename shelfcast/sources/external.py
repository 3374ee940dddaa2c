"""Weather and holiday payloads (JSON text, one document per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEATHER_MEASURES = (
    "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
    "precipitation_sum", "snowfall_sum", "windspeed_10m_max",
)
WEATHER_SCHEMA = (
    "struct<latitude: double, longitude: double, timezone: string, daily: struct<time: array<string>, "
    + ", ".join(f"{m}: array<double>" for m in WEATHER_MEASURES)
    + ">>"
)
HOLIDAY_SCHEMA = (
    "array<struct<date: string, localName: string, name: string, countryCode: string, fixed: boolean, "
    "global: boolean, counties: array<string>, launchYear: int, types: array<string>>>"
)


def parse_weather(payloads: DataFrame) -> DataFrame:
    """(state_id, source, payload) to one row per day.

    The payload holds parallel arrays. A document without `daily` is an error, not an empty result.
    """
    daily = F.col("doc.daily")
    # a measure left out of the payload is an empty array, padded with NULL; a NULL array would drop every day
    absent = F.array().cast("array<double>")
    zipped = F.arrays_zip(
        daily["time"].alias("time"), *[F.coalesce(daily[m], absent).alias(m) for m in WEATHER_MEASURES]
    )
    checked = F.when(daily["time"].isNotNull(), zipped).otherwise(
        F.raise_error(F.concat(F.lit("weather payload without daily values: "), F.col("state_id")))
    )
    return (
        payloads.select("state_id", "source", F.from_json("payload", WEATHER_SCHEMA).alias("doc"))
        .select("state_id", "source", F.inline(checked))
        .select("state_id", F.to_date("time").alias("date"), "source", *WEATHER_MEASURES)
    )


def parse_holidays(payloads: DataFrame, states: list[str], country: str) -> DataFrame:
    """(payload) to one row per holiday and state.

    `counties = null` means every state of `states`; otherwise only those listed, as `<country>-<state>`.
    """
    everywhere = F.array(*[F.lit(f"{country}-{s}") for s in states])
    entries = payloads.select(F.inline(F.from_json("payload", HOLIDAY_SCHEMA)))
    return entries.select(
        F.to_date("date").alias("date"),
        F.col("countryCode").alias("country_code"),
        F.explode(F.coalesce("counties", everywhere)).alias("subdivision"),
        F.col("name").alias("holiday_name"),
        F.element_at("types", 1).alias("holiday_type"),
        F.array_contains("types", "Public").alias("is_public_holiday"),
    ).withColumn("state_id", F.regexp_replace("subdivision", f"^{country}-", ""))
