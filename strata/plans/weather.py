"""The layered forecast pipeline: raw -> staging -> mart.

Staging flattens each raw document (one per entity per run) into typed
current conditions and daily forecast rows; the mart keeps the latest
snapshot per entity and derives summaries, per-day rankings and rolling
three-row metrics. All decimals are exact NUMERIC casts (half-up rounding,
overflow raises).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import json_array, json_text, to_decimal
from strata.operators.arrays import explode_aligned
from strata.operators.windows import latest_per_key, latest_snapshot, rank_within, rolling_rows, sort_spec

# JSON paths inside the payload and the declared column types.
CURRENT_PATH = ["api_response", "current"]
DAILY_PATH = ["api_response", "daily"]
CURRENT_FIELDS = {
    "temperature_c": ("temperature_2m", 6, 2),
    "relative_humidity_pct": ("relative_humidity_2m", 6, 2),
    "wind_speed_kmh": ("wind_speed_10m", 6, 2),
}
DAILY_FIELDS = {
    "temperature_max_c": ("temperature_2m_max", 6, 2),
    "temperature_min_c": ("temperature_2m_min", 6, 2),
    "precipitation_mm": ("precipitation_sum", 8, 2),
}


def _stamp(at: Column | None) -> Column:
    return at if at is not None else F.current_timestamp()


def raw_record_id(path: str | Column = "raw_file_path") -> Column:
    """Deterministic record id: 64-bit hash of the document's relative path."""
    return F.xxhash64(F.col(path) if isinstance(path, str) else path)


def build_raw(parsed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Raw-layer rows from parsed envelopes (``parse_envelope`` output)."""
    return parsed.select(
        raw_record_id().alias("raw_record_id"),
        "source",
        "city",
        "ingested_at_utc",
        "payload",
        "raw_file_path",
        _stamp(loaded_at).alias("loaded_at_utc"),
    )


# Newest first: snapshot time, then load time, then path (the record's load
# order in the source system).
def latest_order(ts: str = "source_ingested_at_utc") -> list[Column]:
    return [
        sort_spec(ts, descending=True),
        sort_spec("raw_loaded_at_utc", descending=True),
        sort_spec("raw_file_path", descending=True),
    ]


ENVELOPE_COLS = ["raw_record_id", "city", "ingested_at_utc", "raw_file_path", "loaded_at_utc"]


def flatten_documents(raw: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One wide row per document: all that either staging table takes from its payload.

    ``current_time`` and the current fields as text, the daily arrays as they
    stand, and ``bad_arrays``, what is wrong with them (see ``daily_array_rejects``).
    ``carry`` names more columns of ``raw`` to keep. Written once, it saves a
    second parse; unwritten, the planner takes the columns that it needs.
    """
    sources = {"daily_time": "time", **{f"daily_{name}": src for name, (src, _, _) in DAILY_FIELDS.items()}}
    checks = []
    for field in sources.values():
        v = F.try_variant_get("payload", "$." + ".".join([*DAILY_PATH, field]), "variant")
        reason = (
            F.when(v.isNull(), F.lit(None))
            .when(F.is_variant_null(v), F.lit("JSON null instead of an array"))
            .when(F.try_variant_get("payload", "$." + ".".join([*DAILY_PATH, field]), "array<variant>").isNull(), F.lit("not an array"))
        )
        checks.append(F.when(reason.isNotNull(), F.struct(F.lit(field).alias("field"), reason.alias("reason"))))
    return raw.select(
        *ENVELOPE_COLS, *(carry or []),
        json_text("payload", [*CURRENT_PATH, "time"]).alias("current_time"),
        *[json_text("payload", [*CURRENT_PATH, src]).alias(f"current_{name}") for name, (src, _, _) in CURRENT_FIELDS.items()],
        *[json_array("payload", [*DAILY_PATH, src]).alias(name) for name, src in sources.items()],
        F.filter(F.array(*checks), lambda x: x.isNotNull()).alias("bad_arrays"),
    )


def current_rows(flat: DataFrame, loaded_at: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """The staging rows of current conditions in flattened documents."""
    return flat.where(F.col("current_time").isNotNull()).select(
        "raw_record_id",
        "city",
        F.col("current_time").cast("timestamp").alias("current_time_utc"),
        *[to_decimal(f"current_{name}", p, s).alias(name) for name, (_, p, s) in CURRENT_FIELDS.items()],
        F.col("ingested_at_utc").alias("source_ingested_at_utc"),
        "raw_file_path",
        F.col("loaded_at_utc").alias("raw_loaded_at_utc"),
        _stamp(loaded_at).alias("loaded_at_utc"),
        *(carry or []),
    )


def daily_rows(flat: DataFrame, loaded_at: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """The staging rows of daily forecasts in flattened documents."""
    arrays = {"forecast_date_txt": F.col("daily_time"), **{f"{name}_txt": F.col(f"daily_{name}") for name in DAILY_FIELDS}}
    exploded = explode_aligned(
        flat,
        arrays,
        keep=[*ENVELOPE_COLS, *(carry or [])],
        first_of=F.transform("daily_time", lambda t: t.cast("date")),
    )
    return exploded.select(
        "raw_record_id",
        "city",
        F.col("forecast_date_txt").cast("date").alias("forecast_date"),
        *[to_decimal(f"{name}_txt", p, s).alias(name) for name, (_, p, s) in DAILY_FIELDS.items()],
        F.col("ingested_at_utc").alias("source_ingested_at_utc"),
        "raw_file_path",
        F.col("loaded_at_utc").alias("raw_loaded_at_utc"),
        _stamp(loaded_at).alias("loaded_at_utc"),
        *(carry or []),
    )


def array_rejects(flat: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The unusable daily arrays of flattened documents, a row for each."""
    bad = flat.where(F.size("bad_arrays") > 0).select("raw_record_id", "raw_file_path", *(carry or []), F.explode("bad_arrays").alias("__b"))
    return bad.select("raw_record_id", "raw_file_path", *(carry or []), F.col("__b.field").alias("field"), F.col("__b.reason").alias("reason"))


def build_staging_current(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One typed row per document that has a ``current.time``."""
    return current_rows(flatten_documents(raw), loaded_at)


def build_staging_daily(raw: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One typed row per (document, forecast date) from the parallel daily arrays.

    Arrays are aligned by position and cut at the shortest; a document without
    daily arrays gives no rows; a date repeated inside one document keeps its
    first position.
    """
    return daily_rows(flatten_documents(raw), loaded_at)


def daily_array_rejects(raw: DataFrame) -> DataFrame:
    """Documents whose daily arrays are present but unusable: ``raw_record_id, raw_file_path, field, reason``.

    A missing array is not an error (the document just has no daily rows), but
    a JSON ``null`` or a non-array value where an array belongs is: the source
    system failed the whole load on it. ``build_staging_daily`` yields no rows
    for such documents; this report names them so a strict load can refuse.
    """
    return array_rejects(flatten_documents(raw))


MART_CURRENT_COLS = ["city", "current_time_utc", "temperature_c", "relative_humidity_pct", "wind_speed_kmh", "source_ingested_at_utc"]
DAILY_SUMMARY_COLS = [
    "city", "forecast_date", "temperature_max_c", "temperature_min_c", "temperature_avg_c",
    "diurnal_temp_range_c", "precipitation_mm", "is_wet_day", "source_ingested_at_utc",
]
RANKING_COLS = ["forecast_date", "city", "temperature_max_c", "temperature_avg_c", "precipitation_mm", "max_temperature_rank"]
ROLLING_COLS = ["city", "forecast_date", "temperature_avg_c", "rolling_3day_avg_temp_c", "precipitation_mm", "rolling_3day_precip_mm"]


def build_mart_current(staging_current: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """Latest current-conditions row per entity."""
    latest = latest_per_key(staging_current, ["city"], latest_order())
    return latest.select(*MART_CURRENT_COLS, _stamp(refreshed_at).alias("refreshed_at_utc"))


def summarize_daily(rows: DataFrame) -> DataFrame:
    """Derived daily metrics: avg = ROUND((max+min)/2, 2), range = ROUND(max-min, 2), wet = precip > 0."""
    mx, mn = F.col("temperature_max_c"), F.col("temperature_min_c")
    return rows.select(
        "city",
        "forecast_date",
        mx.alias("temperature_max_c"),
        mn.alias("temperature_min_c"),
        to_decimal(F.round((mx + mn) / F.lit(2).cast("decimal(1,0)"), 2), 6, 2).alias("temperature_avg_c"),
        to_decimal(F.round(mx - mn, 2), 6, 2).alias("diurnal_temp_range_c"),
        "precipitation_mm",
        (F.col("precipitation_mm") > 0).alias("is_wet_day"),
        "source_ingested_at_utc",
    )


def build_daily_summary(staging_daily: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """Rows of each entity's newest snapshot, one per (entity, date), with derived metrics."""
    rows = latest_snapshot(
        staging_daily,
        keys=["city"],
        snapshot="source_ingested_at_utc",
        dedupe_by=["forecast_date"],
        order=latest_order(),
    )
    return summarize_daily(rows).withColumn("refreshed_at_utc", _stamp(refreshed_at))


def build_rankings(daily: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """Per-date rank by max temperature (descending, NULL first), ties broken by name."""
    ranked = rank_within(
        daily.select("forecast_date", "city", "temperature_max_c", "temperature_avg_c", "precipitation_mm"),
        by=["forecast_date"],
        value="temperature_max_c",
        tiebreak=["city"],
        out="max_temperature_rank",
    )
    return ranked.select(*RANKING_COLS, _stamp(refreshed_at).alias("refreshed_at_utc"))


def rolling_metrics(daily: DataFrame, by: str = "city") -> DataFrame:
    """Three-row rolling average temperature and precipitation sum, rounded to 2 places."""
    rolled = rolling_rows(
        daily,
        by=[by],
        order=[sort_spec("forecast_date")],
        aggs={"__avg": F.avg("temperature_avg_c"), "__sum": F.sum("precipitation_mm")},
        preceding=2,
    )
    return rolled.select(
        by,
        "forecast_date",
        "temperature_avg_c",
        to_decimal(F.round("__avg", 2), 6, 2).alias("rolling_3day_avg_temp_c"),
        "precipitation_mm",
        to_decimal(F.round("__sum", 2), 8, 2).alias("rolling_3day_precip_mm"),
    )


def build_rolling(daily: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    return rolling_metrics(daily).withColumn("refreshed_at_utc", _stamp(refreshed_at))
