"""Dimension lookup on a normalised name, and the forecast request plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import lookup_key

# The supported cities and their coordinates, and the request
# parameters sent for every city.
CITY_COORDINATES = [
    ("prague", 50.0755, 14.4378),
    ("vienna", 48.2082, 16.3738),
    ("berlin", 52.52, 13.405),
    ("warsaw", 52.2297, 21.0122),
    ("budapest", 47.4979, 19.0402),
]
CURRENT_FIELDS = "temperature_2m,relative_humidity_2m,wind_speed_10m"
DAILY_FIELDS = "temperature_2m_max,temperature_2m_min,precipitation_sum"
REQUEST_TIMEZONE = "UTC"
FORECAST_DAYS = 7


def city_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_COORDINATES, "city_key string, latitude double, longitude double")


def lookup_dimension(df: DataFrame, name_col: str, dim: DataFrame, dim_key: str) -> tuple[DataFrame, DataFrame]:
    """Join rows to ``dim`` on ``lower(trim(name))``; return ``(matched, rejects)``.

    ``rejects`` holds the rows whose name has no dimension entry (the caller
    decides whether that is an error). Two entries whose names differ only in
    case or outer blanks would multiply rows, so they fail the job. The planner
    chooses the join: a broadcast where statistics show a small dimension, a
    shuffle otherwise.
    """
    keyed = df.withColumn("__key", lookup_key(name_col))
    entries = dim.withColumn("__key", lookup_key(dim_key))
    rest = [c for c in dim.columns if c != dim_key]
    one = entries.where("__key IS NOT NULL").groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(0), *rest)).alias("__row"))
    ambiguous = F.raise_error(F.concat(F.lit("several dimension entries are named "), F.col("__key")))
    one = one.withColumn("__key", F.when(F.col("__n") > 1, ambiguous).otherwise(F.col("__key")))
    matched = keyed.join(one.select("__key", *[F.col(f"__row.{c}").alias(c) for c in rest]), on="__key", how="inner").drop("__key")
    rejects = keyed.join(one.select("__key"), on="__key", how="left_anti").drop("__key")
    return matched, rejects


def request_plan(cities: DataFrame, name_col: str, dim: DataFrame, dim_key: str = "city_key") -> tuple[DataFrame, DataFrame]:
    """Coordinates plus the fixed forecast parameters for every requested city."""
    matched, rejects = lookup_dimension(cities, name_col, dim, dim_key)
    plan = matched.select(
        "*",
        F.lit(CURRENT_FIELDS).alias("current"),
        F.lit(DAILY_FIELDS).alias("daily"),
        F.lit(REQUEST_TIMEZONE).alias("timezone"),
        F.lit(FORECAST_DAYS).alias("forecast_days"),
    )
    return plan, rejects


def raise_on_rejects(rejects: DataFrame, name_col: str) -> None:
    """Fail with the number of unsupported names and the first of them by name."""
    bad = rejects.agg(F.count_distinct(name_col).alias("n"), F.min(name_col).alias("first")).first()
    if bad["n"]:
        raise ValueError(f"{bad['n']} requested names have no coordinates, the first is {bad['first']!r}")
