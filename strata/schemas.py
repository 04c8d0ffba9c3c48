"""Declared schemas of the seven layered tables, and create-if-absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

from strata.sources.storage import exists


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


D62, D82 = DecimalType(6, 2), DecimalType(8, 2)
TS = TimestampType()

# Table layouts (name, type, nullable).
RAW_WEATHER = _s(
    ("raw_record_id", LongType(), False), ("source", StringType(), False), ("city", StringType(), False),
    ("ingested_at_utc", TS, False), ("payload", VariantType(), False), ("raw_file_path", StringType(), False),
    ("loaded_at_utc", TS, False),
)
STAGING_CURRENT = _s(
    ("raw_record_id", LongType(), False), ("city", StringType(), False), ("current_time_utc", TS, False),
    ("temperature_c", D62, True), ("relative_humidity_pct", D62, True), ("wind_speed_kmh", D62, True),
    ("source_ingested_at_utc", TS, False), ("raw_file_path", StringType(), False), ("raw_loaded_at_utc", TS, False),
    ("loaded_at_utc", TS, False),
)
STAGING_DAILY = _s(
    ("raw_record_id", LongType(), False), ("city", StringType(), False), ("forecast_date", DateType(), False),
    ("temperature_max_c", D62, True), ("temperature_min_c", D62, True), ("precipitation_mm", D82, True),
    ("source_ingested_at_utc", TS, False), ("raw_file_path", StringType(), False), ("raw_loaded_at_utc", TS, False),
    ("loaded_at_utc", TS, False),
)
MART_CURRENT = _s(
    ("city", StringType(), False), ("current_time_utc", TS, False), ("temperature_c", D62, True),
    ("relative_humidity_pct", D62, True), ("wind_speed_kmh", D62, True), ("source_ingested_at_utc", TS, False),
    ("refreshed_at_utc", TS, False),
)
MART_DAILY_SUMMARY = _s(
    ("city", StringType(), False), ("forecast_date", DateType(), False), ("temperature_max_c", D62, True),
    ("temperature_min_c", D62, True), ("temperature_avg_c", D62, True), ("diurnal_temp_range_c", D62, True),
    ("precipitation_mm", D82, True), ("is_wet_day", BooleanType(), False), ("source_ingested_at_utc", TS, False),
    ("refreshed_at_utc", TS, False),
)
MART_RANKINGS = _s(
    ("forecast_date", DateType(), False), ("city", StringType(), False), ("temperature_max_c", D62, True),
    ("temperature_avg_c", D62, True), ("precipitation_mm", D82, True), ("max_temperature_rank", LongType(), False),
    ("refreshed_at_utc", TS, False),
)
MART_ROLLING = _s(
    ("city", StringType(), False), ("forecast_date", DateType(), False), ("temperature_avg_c", D62, True),
    ("rolling_3day_avg_temp_c", D62, True), ("precipitation_mm", D82, True), ("rolling_3day_precip_mm", D82, True),
    ("refreshed_at_utc", TS, False),
)

TABLES = {
    "raw/weather_api_responses": RAW_WEATHER,
    "staging/weather_current_conditions": STAGING_CURRENT,
    "staging/weather_daily_forecast": STAGING_DAILY,
    "mart/city_current_weather": MART_CURRENT,
    "mart/daily_city_weather_summary": MART_DAILY_SUMMARY,
    "mart/daily_temperature_rankings": MART_RANKINGS,
    "mart/city_rolling_3day_metrics": MART_ROLLING,
}
PRIMARY_KEYS = {
    "raw/weather_api_responses": ["raw_file_path"],
    "staging/weather_current_conditions": ["raw_file_path"],
    "staging/weather_daily_forecast": ["raw_file_path", "forecast_date"],
    "mart/city_current_weather": ["city"],
    "mart/daily_city_weather_summary": ["city", "forecast_date"],
    "mart/daily_temperature_rankings": ["forecast_date", "city"],
    "mart/city_rolling_3day_metrics": ["city", "forecast_date"],
}


def not_null_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def catalogue(spark: SparkSession) -> DataFrame:
    """The declared tables, a row for each column: ``table, position, column, type, nullable, key_position``."""
    rows = [
        (rel, k, f.name, f.dataType.simpleString(), f.nullable, PRIMARY_KEYS[rel].index(f.name) + 1 if f.name in PRIMARY_KEYS[rel] else None)
        for rel, schema in TABLES.items() for k, f in enumerate(schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean, key_position int")


def create_if_absent(spark: SparkSession, warehouse: str) -> list[str]:
    """Create every missing table folder as an empty parquet table; return those created."""
    made = []
    for rel, schema in TABLES.items():
        path = f"{warehouse.rstrip('/')}/{rel}"
        if not exists(spark, path):
            spark.createDataFrame([], schema).write.parquet(path)
            made.append(rel)
    return made


def stored_catalogue(spark: SparkSession, warehouse: str) -> DataFrame:
    """What the warehouse holds of the declared tables: ``table, column, type, n_rows`` read back from their files."""
    parts = []
    for rel in TABLES:
        df = spark.read.parquet(f"{warehouse.rstrip('/')}/{rel}")
        columns = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields])
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(rel).alias("table"), "n_rows", F.inline(columns)).select("table", "column", "type", "n_rows"))
    return reduce(DataFrame.unionByName, parts)
