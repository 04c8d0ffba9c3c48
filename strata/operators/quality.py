"""Data quality checks: one row ``(check_order, name, description, issue_count, passed)`` each.

All checks of one table share one aggregate: a conditional count per rule, the
row count, and duplicate keys, which are counted on the keys' own groups in the
same pass. The counters of all tables are folded into one row and turned into
check rows in place, so a check never moves rows, only counters. Nothing runs
before the result is asked for; expected counts may themselves be one-row
DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLS = ["check_order", "name", "description", "issue_count", "passed"]
SUMMARY_COLS = ["passed", "failed", "total", "status"]


@dataclass(frozen=True)
class Check:
    """A check over counters: ``issues`` is an expression over the counters of all tables."""

    name: str
    description: str
    issues: Column


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def not_between(col: str, low, high) -> Column:
    c = F.col(col)
    return (c < F.lit(low)) | (c > F.lit(high))


def table_counters(df: DataFrame, prefix: str, violations: dict[str, Column] | None = None, unique: list[str] | None = None) -> DataFrame:
    """One row of counters over one scan: ``<prefix>_rows``, one per violation, and with
    ``unique`` also ``<prefix>_duplicates``, the number of key groups with several rows."""
    violations = violations or {}
    flags = {n: F.count_if(F.coalesce(v, F.lit(False))) for n, v in violations.items()}
    if not unique:
        return df.agg(F.count(F.lit(1)).alias(f"{prefix}_rows"), *[f.alias(n) for n, f in flags.items()])
    groups = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("__n"), *[f.alias(n) for n, f in flags.items()])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return groups.agg(
        total("__n").alias(f"{prefix}_rows"), F.count_if(F.col("__n") > 1).alias(f"{prefix}_duplicates"), *[total(n).alias(n) for n in violations]
    )


def fold(counters: list[DataFrame]) -> DataFrame:
    """The columns of several one-row DataFrames side by side, without joining them."""
    columns = [(f.name, f.dataType) for df in counters for f in df.schema.fields]
    stacked = [df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in columns]) for df in counters]
    return reduce(DataFrame.unionByName, stacked).agg(*[F.max(n).alias(n) for n, _ in columns])


def check_rows(counters: list[DataFrame], checks: list[Check]) -> DataFrame:
    """The checks as rows, numbered from 1, over the counters of all tables."""
    one = F.array(*[
        F.struct(
            F.lit(k).alias("check_order"), F.lit(c.name).alias("name"), F.lit(c.description).alias("description"),
            c.issues.cast("bigint").alias("issue_count"), (c.issues == 0).alias("passed"),
        )
        for k, c in enumerate(checks, 1)
    ])
    return fold(counters).select(F.inline(one)).select(*RESULT_COLS)


def is_not(count: str, expected: Column) -> Column:
    """0 when the counter has the expected value, else 1."""
    return F.when(F.col(count) == expected, 0).otherwise(1)


def expected_count(value: int) -> int:
    if value < 0:
        raise ValueError(f"a table cannot be expected to hold {value} rows")
    return value


# Check names and descriptions of the mart quality suite.
MART_CHECKS = [
    ("mart_current_weather_nulls", "Current weather mart table should not have null critical fields."),
    ("mart_daily_summary_nulls", "Daily summary mart table should not have null critical fields."),
    ("mart_daily_summary_duplicates", "Daily summary mart table should not contain duplicate city/date rows."),
    ("mart_daily_temperature_ranges", "Temperatures should be within a realistic range and max >= min."),
    ("mart_daily_precipitation_ranges", "Precipitation should not be negative."),
    ("mart_current_weather_row_count", "Current weather mart table should contain one row per configured city."),
    ("mart_daily_summary_row_count", "Daily summary mart table should contain one row per city and forecast day."),
    ("mart_temperature_rankings_row_count", "Temperature rankings mart table should contain one row per city and forecast day."),
    ("mart_rolling_metrics_row_count", "Rolling metrics mart table should contain one row per city and forecast day."),
]
TEMPERATURE_LIMITS = (-80, 80)


def mart_rules() -> dict[str, tuple[str, dict[str, Column]]]:
    """The row rules of each mart and the prefix of its other counters."""
    lo, hi = TEMPERATURE_LIMITS
    daily = ["city", "forecast_date", "temperature_max_c", "temperature_min_c", "precipitation_mm", "source_ingested_at_utc"]
    return {
        "city_current_weather": ("current", {"current_nulls": any_null(["city", "current_time_utc", "source_ingested_at_utc"])}),
        "daily_city_weather_summary": ("daily", {
            "daily_nulls": any_null(daily),
            "daily_ranges": (F.col("temperature_max_c") < F.col("temperature_min_c"))
            | not_between("temperature_max_c", lo, hi)
            | not_between("temperature_min_c", lo, hi),
            "daily_negative": F.col("precipitation_mm") < 0,
        }),
        "daily_temperature_rankings": ("rankings", {}),
        "city_rolling_3day_metrics": ("rolling", {}),
    }


def mart_check_rows(counters: list[DataFrame], city_count: int | DataFrame, forecast_days: int = 7) -> DataFrame:
    """The nine mart checks over counters, wherever those were taken."""
    d = dict(MART_CHECKS)
    names = [n for n, _ in MART_CHECKS]
    if isinstance(city_count, DataFrame):
        counters = [*counters, city_count.select(F.col(city_count.columns[0]).cast("bigint").alias("cities"))]
        cities = F.col("cities")
    else:
        cities = F.lit(expected_count(city_count)).cast("bigint")
    per_day = cities * expected_count(forecast_days)
    issues = [
        F.col("current_nulls"), F.col("daily_nulls"), F.col("daily_duplicates"), F.col("daily_ranges"), F.col("daily_negative"),
        is_not("current_rows", cities), is_not("daily_rows", per_day), is_not("rankings_rows", per_day), is_not("rolling_rows", per_day),
    ]
    return check_rows(counters, [Check(n, d[n], i) for n, i in zip(names, issues)])


def collect_checks(marts: dict[str, DataFrame], city_count: int | DataFrame, forecast_days: int = 7) -> DataFrame:
    """The nine mart checks as one DataFrame: one scan of each mart.

    ``city_count`` is a number, or a one-row DataFrame whose only column is it.
    """
    counters = [
        table_counters(marts[name], prefix, rules, unique=["city", "forecast_date"] if prefix == "daily" else None)
        for name, (prefix, rules) in mart_rules().items()
    ]
    return mart_check_rows(counters, city_count, forecast_days)


def counted_checks(spark: SparkSession, counters: dict[str, dict[str, int]], city_count: int | DataFrame, forecast_days: int = 7) -> DataFrame:
    """The nine mart checks from counters taken while the marts were written; no mart is scanned.

    ``counters`` holds, for each mart, its ``rows`` and rules, and ``duplicates`` for the daily summary.
    """
    one = {}
    for name, (prefix, rules) in mart_rules().items():
        of = counters.get(name, {})
        one |= {f"{prefix}_rows": of.get("rows", 0), **{r: of.get(r, 0) for r in rules}}
        if prefix == "daily":
            one["daily_duplicates"] = of.get("duplicates", 0)
    row = spark.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in one.items()])
    return mart_check_rows([row], city_count, forecast_days)


def summarize_checks(results: DataFrame) -> DataFrame:
    """One row: ``passed, failed, total, status`` (``pass`` only when nothing failed)."""
    return results.agg(
        F.count_if(F.col("passed")).cast("bigint").alias("passed"),
        F.count_if(~F.col("passed")).cast("bigint").alias("failed"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
    ).withColumn("status", F.when(F.col("failed") == 0, "pass").otherwise("fail"))


def assert_checks(results: DataFrame) -> None:
    """Raise naming every failed check (the results are a handful of rows)."""
    failed = [f"{r['name']} ({r['issue_count']})" for r in results.where(~F.col("passed")).orderBy("check_order").collect()]
    if failed:
        raise RuntimeError(f"{len(failed)} of the quality checks found issues: {', '.join(failed)}")


def quality_document(marts: dict[str, DataFrame], city_count: int | DataFrame, forecast_days: int = 7) -> DataFrame:
    """The quality payload as one row: ``status``, ``summary`` and ``items`` (in check order).

    ``not_ready``, without items, when the current mart is empty; else pass or fail.
    """
    rows = collect_checks(marts, city_count, forecast_days)
    ready = fold([
        marts["city_current_weather"].limit(1).agg(F.count(F.lit(1)).alias("current")),
        rows.agg(F.sort_array(F.collect_list(F.struct("check_order", "name", "description", "issue_count", "passed"))).alias("items")),
    ])
    items = F.transform("items", lambda i: F.struct(i["name"].alias("name"), i["description"].alias("description"), i["issue_count"].alias("issue_count"), i["passed"].alias("passed")))
    shown = ready.select("current", F.when(F.col("current") > 0, items).otherwise(F.slice(items, 1, 0)).alias("items"))
    count = lambda keep: F.size(F.filter("items", keep)).cast("bigint")
    failed = count(lambda i: ~i["passed"])
    return shown.select(
        F.when(F.col("current") == 0, "not_ready").when(failed == 0, "pass").otherwise("fail").alias("status"),
        F.struct(count(lambda i: i["passed"]).alias("passed"), failed.alias("failed"), F.size("items").cast("bigint").alias("total")).alias("summary"),
        "items",
    )


def quality_payload(marts: dict[str, DataFrame], city_count: int, forecast_days: int = 7) -> dict:
    """``quality_document`` as a plain dict."""
    return quality_document(marts, city_count, forecast_days).first().asDict(recursive=True)
