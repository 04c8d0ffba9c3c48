"""Ordered read views over the mart, the overview row and ISO serialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from strata.functions.scalars import iso_utc_offset, iso_utc_z
from strata.operators.quality import fold


def view_current(mart: DataFrame) -> DataFrame:
    return mart.select("city", "current_time_utc", "temperature_c", "relative_humidity_pct", "wind_speed_kmh", "source_ingested_at_utc").orderBy("city")


def view_daily(mart: DataFrame) -> DataFrame:
    return mart.select(
        "city", "forecast_date", "temperature_max_c", "temperature_min_c", "temperature_avg_c",
        "diurnal_temp_range_c", "precipitation_mm", "is_wet_day", "source_ingested_at_utc",
    ).orderBy("forecast_date", "city")


def view_rankings(mart: DataFrame) -> DataFrame:
    return mart.select(
        "forecast_date", "city", "temperature_max_c", "temperature_avg_c", "precipitation_mm", "max_temperature_rank"
    ).orderBy("forecast_date", "max_temperature_rank", "city")


def view_rolling(mart: DataFrame) -> DataFrame:
    return mart.select(
        "city", "forecast_date", "temperature_avg_c", "rolling_3day_avg_temp_c", "precipitation_mm", "rolling_3day_precip_mm"
    ).orderBy("city", "forecast_date")


def overview(marts: dict[str, DataFrame]) -> DataFrame:
    """Exactly one row: four mart row counts and the newest snapshot time (NULL when empty).

    One aggregate per table, folded into one row; no table is joined to another.
    """
    rows = lambda name: F.count(F.lit(1)).cast("bigint").alias(name)
    return fold([
        marts["city_current_weather"].agg(rows("current_city_count")),
        marts["daily_city_weather_summary"].agg(rows("summary_row_count"), F.max("source_ingested_at_utc").alias("latest_snapshot_at")),
        marts["daily_temperature_rankings"].agg(rows("ranking_row_count")),
        marts["city_rolling_3day_metrics"].agg(rows("rolling_row_count")),
    ]).select("current_city_count", "summary_row_count", "ranking_row_count", "rolling_row_count", "latest_snapshot_at")


def readiness(marts: dict[str, DataFrame]) -> DataFrame:
    """One row ``ready``: current, rankings and rolling marts all hold rows (the summary is not consulted)."""
    names = ("city_current_weather", "daily_temperature_rankings", "city_rolling_3day_metrics")
    one = fold([marts[n].limit(1).agg(F.count(F.lit(1)).alias(n)) for n in names])
    return one.select(F.least(*names).cast("boolean").alias("ready"))


def is_ready(marts: dict[str, DataFrame]) -> bool:
    return readiness(marts).first()["ready"]


def iso_strings(df: DataFrame) -> DataFrame:
    """Dates as ``YYYY-MM-DD`` and instants as ISO-8601 with ``+00:00``; other columns unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, TimestampType):
            cols.append(iso_utc_offset(f.name).alias(f.name))
        elif isinstance(f.dataType, TimestampNTZType):
            cols.append(F.regexp_replace(iso_utc_z(f.name), "Z$", "").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def iso_json(df: DataFrame) -> DataFrame:
    """One JSON object per row (``value``) with ISO-serialised dates and times."""
    s = iso_strings(df)
    return s.select(F.to_json(F.struct(*s.columns)).alias("value"))
