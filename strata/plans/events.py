"""Forecast documents derived from the ``events`` table, and the pipeline over them.

Mapping (one document per user per ISO week, the week start as snapshot time):

* entity (``city``)  = ``'user_' || user_id``
* snapshot time      = ``date_trunc('week', ts)``
* daily arrays       = per calendar day of the week: ``max(value)``,
  ``min(value)``, ``min(k)`` (``k`` from the JSON ``props``), in date order
* current block      = the week's last event (by ts, event_id): minute of ts,
  value, k; wind = the week's first event's value

Events are first combined per (user, day) with partial aggregates, so a user
holding a large share of all events is reduced map-side before any shuffle,
and a document never holds more than seven days whatever the event volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import order_key
from strata.sources.envelope import build_envelope, parse_envelope
from strata.sources.raw_documents import with_partition_columns
from strata.plans import weather as W

EVENTS_SOURCE = "events"


def k_of(props: str | Column = "props") -> Column:
    """The ``k`` member of the JSON ``props`` text, as DECIMAL(8,2)."""
    c = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(c, "$.k").cast("decimal(8,2)")


def forecast_documents(events: DataFrame, repeat_first_day: bool = False) -> DataFrame:
    """``value`` (JSON envelope) plus landing partition columns and ``raw_file_path``.

    ``repeat_first_day`` lists each document's first day again at its end, warmer
    by one degree, as a source that repeats a date would.
    """
    ev = events.select(
        "user_id",
        "event_id",
        "ts",
        "value",
        k_of("props").alias("k"),
    )
    ev = ev.withColumn("okey", order_key("ts", "event_id"))
    daily = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("value").alias("tmax"),
        F.min("value").alias("tmin"),
        F.min("k").alias("kmin"),
        F.max("okey").alias("last_key"),
        F.max("ts").alias("last_ts"),
        F.max_by("value", "okey").alias("last_value"),
        F.max_by("k", "okey").alias("last_k"),
        F.min("okey").alias("first_key"),
        F.min_by("value", "okey").alias("first_value"),
    )
    weekly = daily.groupBy("user_id", F.date_trunc("week", F.col("day").cast("timestamp")).alias("week")).agg(
        F.sort_array(F.collect_list(F.struct("day", "tmax", "tmin", "kmin"))).alias("days"),
        F.struct(
            F.max("last_ts").alias("ts"),
            F.max_by("last_value", "last_key").alias("value"),
            F.max_by("last_k", "last_key").alias("k"),
        ).alias("last"),
        F.struct(F.min_by("first_value", "first_key").alias("value")).alias("first"),
    )
    if repeat_first_day:
        again = F.transform(F.slice("days", 1, 1), lambda d: F.struct(d["day"].alias("day"), (d["tmax"] + 1).alias("tmax"), d["tmin"].alias("tmin"), d["kmin"].alias("kmin")))
        weekly = weekly.withColumn("days", F.concat("days", again))
    city = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    payload = F.struct(
        city.alias("city"),
        F.struct(
            F.struct(
                F.date_format("last.ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
                F.col("last.value").alias("temperature_2m"),
                F.col("last.k").alias("relative_humidity_2m"),
                F.col("first.value").alias("wind_speed_10m"),
            ).alias("current"),
            F.struct(
                F.transform("days", lambda d: F.date_format(d["day"], "yyyy-MM-dd")).alias("time"),
                F.col("days.tmax").alias("temperature_2m_max"),
                F.col("days.tmin").alias("temperature_2m_min"),
                F.col("days.kmin").alias("precipitation_sum"),
            ).alias("daily"),
        ).alias("api_response"),
    )
    staged = weekly.select("user_id", "week", city.alias("city"), payload.alias("payload"))
    staged = with_partition_columns(staged, "city", "week", source_dir=EVENTS_SOURCE)
    keep = ["user_id", "week", "year", "month", "day", "run_id", "city_slug", "raw_file_path"]
    return build_envelope(staged, "city", F.col("payload"), "week", source=EVENTS_SOURCE, keep=keep)


def raw_layer(events: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    docs = forecast_documents(events)
    good, _ = parse_envelope(docs.select("value", "raw_file_path"), on_error="raise")
    return W.build_raw(good, loaded_at=loaded_at if loaded_at is not None else F.lit("2024-02-01 00:00:00").cast("timestamp"))
