"""Queries over the driver tables, one per operator family.

Every query reads whole tables from ``sf_dir`` and returns a DataFrame whose
column names match the SQL oracle of the same key. Building one runs no job,
except that a layer which is not yet written for this input is written first,
and the file queries (``full_refresh``, ``concurrent_refresh``, ``refresh_checks``,
``incremental_ingest``, ``table_catalogue``) run their flow.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from strata.functions.scalars import json_array, json_text
from strata.operators import contracts as K
from strata.operators import quality as Q
from strata.operators import views as V
from strata.operators.arrays import explode_aligned
from strata.operators.ranges import ranged_rolling
from strata.operators.windows import latest_per_key, latest_snapshot, rank_within, row_positions, sort_spec
from strata.plans import events as E
from strata.plans import weather as W
from strata.plans.layers import materialize
from strata.plans.refresh import RAW_TABLE, published_marts, read_table, refresh_all
from strata.schemas import TABLES, catalogue, create_if_absent, stored_catalogue
from strata.session import shared_dir
from strata.streaming.ingest import ingest_available
from strata.sources.append import append_counts, append_if_absent
from strata.sources.envelope import build_envelope, parse_envelope
from strata.sources.lookup import city_dimension, lookup_dimension, request_plan
from strata.sources.raw_documents import with_partition_columns, write_raw_documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


LOAD_TIME = "2024-02-01 00:00:00"


def _at():
    return F.lit(LOAD_TIME).cast("timestamp")


# The written layers, each built from the written layer beneath it, exactly
# once per version of the events table and of this code.
LAYERS = {
    "raw": lambda spark, sf: E.raw_layer(table(spark, sf, "events")),
    "staging_current": lambda spark, sf: W.build_staging_current(layer(spark, sf, "raw"), _at()),
    "staging_daily": lambda spark, sf: W.build_staging_daily(layer(spark, sf, "raw"), _at()),
    "mart_current": lambda spark, sf: W.build_mart_current(layer(spark, sf, "staging_current"), _at()),
    "daily_summary": lambda spark, sf: W.build_daily_summary(layer(spark, sf, "staging_daily"), _at()),
    "rankings": lambda spark, sf: W.build_rankings(layer(spark, sf, "daily_summary"), _at()),
    "rolling": lambda spark, sf: W.build_rolling(layer(spark, sf, "daily_summary"), _at()),
}


def layer(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A written layer; only it and those that it is built from are made when absent."""
    return materialize(spark, f"events_{name}", [table_path(sf, "events")], lambda: LAYERS[name](spark, sf))


def mart_set(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four written marts."""
    return {
        "city_current_weather": layer(spark, sf, "mart_current"),
        "daily_city_weather_summary": layer(spark, sf, "daily_summary"),
        "daily_temperature_rankings": layer(spark, sf, "rankings"),
        "city_rolling_3day_metrics": layer(spark, sf, "rolling"),
    }


# ---------------------------------------------------------------- scalars

def q_json_extract(spark, sf):
    ev = table(spark, sf, "events")
    doc = F.parse_json("props")
    return ev.select(
        "event_id",
        json_text(doc, "k").alias("k_text"),
        json_text(doc, "k").cast("decimal(8,2)").alias("k_decimal"),
        json_text(doc, "missing").alias("missing_text"),
    )


def q_partition_columns(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    out = with_partition_columns(ev, "event_type", "ts")
    return out.select("event_id", "year", "month", "day", "run_id", "city_slug", "raw_file_path")


# ---------------------------------------------------------------- sources

def q_raw_envelope(spark, sf):
    raw = E.raw_layer(table(spark, sf, "events"))
    return raw.select("raw_file_path", "source", "city", "ingested_at_utc")


def q_envelope_rejects(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), on="doc_id", how="left")
    payload = F.when(
        F.col("quality").isNotNull(),
        F.struct("doc_id", "text", "quality", "toxic"),
    )
    env = build_envelope(
        docs, city="lang", payload=payload, ingested_at=F.lit("2024-01-01 00:00:00").cast("timestamp"),
        source=F.col("source"), keep=["doc_id"],
    )
    _, rejects = parse_envelope(env, on_error="reject")
    return rejects.select("doc_id", "reject_reason")


def q_envelope_contract(spark, sf):
    """Envelopes whose required fields are JSON null or no text, whose time is no instant (also times
    without a date, and years), or that are no JSON. A key given twice has its last value."""
    doc_id = F.col("doc_id")
    drop = lambda by, c: F.when(doc_id % by == 0, F.lit(None)).otherwise(c)
    times = F.element_at(F.array(*map(F.lit, ["yesterday", "12:30", "2031", "2024-01-01T25:00:00Z"])), (doc_id % 4 + 1).cast("int"))
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.struct(
            drop(7, F.col("source")).alias("source"), drop(5, F.col("lang")).alias("city"),
            drop(11, F.when(doc_id % 17 == 0, times).when(doc_id % 3 == 0, "2024-01-01 00:00:00.25+0200").otherwise("2024-01-01T00:00:00Z")).alias("ingested_at_utc"),
            F.struct(F.length("text").alias("n")).alias("payload"),
        ).alias("doc"),
    )
    text = F.to_json("doc", {"ignoreNullFields": "false"})
    text = F.when(doc_id % 23 == 0, F.replace(text, F.lit('"payload"'), F.lit('"source":{"name":"x"},"payload"'))).otherwise(text)
    text = F.when(doc_id % 19 == 0, F.concat(F.lit('{"city":7,'), F.substr(text, F.lit(2)))).otherwise(text)
    env = docs.select("doc_id", F.when(doc_id % 13 == 0, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))
    _, rejects = parse_envelope(env, on_error="reject")
    return rejects.select("doc_id", "reject_reason")


def q_load_defaults(spark, sf):
    """Raw rows built without a load time get one, the same for the whole load."""
    good, _ = parse_envelope(E.forecast_documents(table(spark, sf, "events")).select("value", "raw_file_path"))
    return W.build_raw(good).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("loaded_at_utc").alias("n_stamped"),
        (F.min("loaded_at_utc") == F.max("loaded_at_utc")).alias("one_stamp"),
    )


def _earlier_load_cutoff():
    return F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")


def q_idempotent_append(spark, sf):
    ev = table(spark, sf, "events")
    existing = E.forecast_documents(ev.where(F.col("ts") < _earlier_load_cutoff()))
    incoming = E.forecast_documents(ev)
    inserted = append_if_absent(
        incoming.select("raw_file_path", "year", "month", "day", "city_slug", "week"),
        existing.select("raw_file_path", "year", "month", "day"),
        keys=["raw_file_path"],
        order=[sort_spec("raw_file_path")],
        prune_on=["year", "month", "day"],
    )
    return inserted.select("raw_file_path", F.col("city_slug").alias("city"), F.col("week").alias("ingested_at_utc"))


def q_append_counts(spark, sf):
    ev = table(spark, sf, "events")
    existing = E.forecast_documents(ev.where(F.col("ts") < _earlier_load_cutoff())).select("raw_file_path")
    incoming = E.forecast_documents(ev).select("raw_file_path")
    # the replayed load also carries the earlier documents a second time
    replay = incoming.unionByName(existing)
    return append_counts(replay, existing, ["raw_file_path"])


def q_dimension_lookup(spark, sf):
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  Nation_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("requested")
    )
    nation = table(spark, sf, "nation").select("n_name", "n_nationkey", "n_regionkey")
    matched, _ = lookup_dimension(cust, "requested", nation, "n_name")
    return matched.select("c_custkey", "requested", "n_nationkey", "n_regionkey")


def q_dimension_rejects(spark, sf):
    """Unmatched side of the lookup: suppliers request the nation named by twice
    their nation key, so keys above 12 name no nation and are rejected."""
    sup = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("Nation_"), (F.col("s_nationkey") * 2).cast("string")).alias("requested")
    )
    nation = table(spark, sf, "nation").select("n_name", "n_nationkey")
    _, rejects = lookup_dimension(sup, "requested", nation, "n_name")
    return rejects.select("s_suppkey", "requested")


def q_request_plan(spark, sf):
    """The request of every customer whose nation stands for a supported city."""
    names = ["Prague", " vienna ", "BERLIN", "Warsaw", "budapest\u0020", "Atlantis"]
    name = F.element_at(F.array(*map(F.lit, names)), (F.col("c_nationkey") % len(names) + 1).cast("int"))
    plan, _ = request_plan(table(spark, sf, "customer").select("c_custkey", name.alias("requested")), "requested", city_dimension(spark))
    return plan.select("c_custkey", "requested", "latitude", "longitude", "current", "daily", "timezone", "forecast_days")


# ---------------------------------------------------------------- arrays

def line_documents_of(lineitem: DataFrame, lines_per_document: int = 100) -> DataFrame:
    """Per-order VARIANT documents with parallel line arrays, ``lines_per_document`` lines each at most.

    An order longer than that has several documents, so no document grows with
    an order; ``is_last`` marks an order's last one. The size shows in no
    answer: lines carry their position in the order. A document also ends where a range of
    ``row_positions`` does, so documents are put together from the rows as they were dealt
    for the positions: the lines are shuffled once. Lines without an order are in no document.
    """
    columns = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    lines = row_positions(
        lineitem.where(F.col("l_orderkey").isNotNull()).select("l_orderkey", *columns),
        ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "pos", size="n_lines", piece="piece",
    )
    part = F.floor((F.col("pos") - 1) / lines_per_document).cast("int")
    of_part = Window.partitionBy("l_orderkey", "piece", "part").orderBy("pos")
    # The list is taken once for a part; of its rows, which all carry it, the last stays.
    docs = lines.withColumn("part", part).select(
        "l_orderkey", "pos", "n_lines",
        F.lead("pos").over(of_part).isNull().alias("ends"),
        F.collect_list(F.struct("pos", *columns)).over(of_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("ls"),
    ).where("ends")
    body = F.struct(
        F.col("l_orderkey").alias("order"),
        F.struct(
            F.col("ls.pos").alias("pos"),
            F.col("ls.l_linenumber").alias("linenumber"),
            F.col("ls.l_partkey").alias("partkey"),
            F.col("ls.l_suppkey").alias("suppkey"),
            F.col("ls.l_quantity").alias("quantity"),
            F.col("ls.l_extendedprice").alias("price"),
            F.transform("ls.l_shipdate", lambda d: F.date_format(d, "yyyy-MM-dd")).alias("shipdate"),
        ).alias("lines"),
    )
    return docs.select("l_orderkey", (F.col("pos") == F.col("n_lines")).alias("is_last"), F.to_variant_object(body).alias("doc"))


def explode_lines(docs: DataFrame, ragged: bool) -> DataFrame:
    """One row per line; with ``ragged`` the ship dates of every order lack its last element."""
    ship = json_array("doc", "lines.shipdate")
    if ragged:
        ship = F.when(F.col("is_last"), F.slice(ship, 1, F.size(ship) - 1)).otherwise(ship)
    rows = explode_aligned(
        docs,
        {
            "pos": json_array("doc", "lines.pos", "bigint"),
            "l_linenumber": json_array("doc", "lines.linenumber", "int"),
            "l_partkey": json_array("doc", "lines.partkey", "bigint"),
            "l_suppkey": json_array("doc", "lines.suppkey", "bigint"),
            "l_quantity": json_array("doc", "lines.quantity", "double"),
            "l_extendedprice": json_array("doc", "lines.price", "double"),
            "ship_txt": ship,
        },
        keep=["l_orderkey"],
    )
    return rows.select(
        "l_orderkey", "pos", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("ship_txt").cast("date").alias("l_shipdate"),
    )


def line_documents(spark, sf) -> DataFrame:
    """The per-order line documents, written once per version of ``lineitem``."""
    return materialize(spark, "lineitem_documents", [table_path(sf, "lineitem")], lambda: line_documents_of(table(spark, sf, "lineitem")))


def q_parallel_arrays(spark, sf):
    return explode_lines(line_documents(spark, sf), ragged=False)


def q_ragged_arrays(spark, sf):
    return explode_lines(line_documents(spark, sf), ragged=True)


# ---------------------------------------------------------------- staging / mart (events mapping)

STAGING_CURRENT_COLS = ["raw_file_path", "city", "current_time_utc", "temperature_c", "relative_humidity_pct", "wind_speed_kmh", "source_ingested_at_utc"]
STAGING_DAILY_COLS = ["raw_file_path", "city", "forecast_date", "temperature_max_c", "temperature_min_c", "precipitation_mm", "source_ingested_at_utc"]


def q_staging_current(spark, sf):
    return W.build_staging_current(layer(spark, sf, "raw")).select(*STAGING_CURRENT_COLS)


def q_staging_daily(spark, sf):
    return W.build_staging_daily(layer(spark, sf, "raw")).select(*STAGING_DAILY_COLS)


def q_latest_per_key(spark, sf):
    ev = table(spark, sf, "events")
    latest = latest_per_key(ev, ["user_id"], [sort_spec("ts", True), sort_spec("event_id", True)])
    return latest.select("user_id", "event_id", "ts", "event_type", "value")


def q_mart_current(spark, sf):
    return W.build_mart_current(layer(spark, sf, "staging_current")).select(*W.MART_CURRENT_COLS)


def q_latest_snapshot(spark, sf):
    daily = layer(spark, sf, "staging_daily")
    rows = latest_snapshot(daily, ["city"], "source_ingested_at_utc", ["forecast_date"], W.latest_order())
    return rows.select("city", "forecast_date", "temperature_max_c", "temperature_min_c", "precipitation_mm", "source_ingested_at_utc")


def q_daily_summary(spark, sf):
    return W.build_daily_summary(layer(spark, sf, "staging_daily")).select(*W.DAILY_SUMMARY_COLS)


def q_rank_per_day(spark, sf):
    return W.build_rankings(layer(spark, sf, "daily_summary")).select(*W.RANKING_COLS)


def q_staging_repeated_dates(spark, sf):
    """Documents that list a date twice: the first position counts."""
    good, _ = parse_envelope(E.forecast_documents(table(spark, sf, "events"), repeat_first_day=True).select("value", "raw_file_path"))
    return W.build_staging_daily(W.build_raw(good, _at())).select(*STAGING_DAILY_COLS)


def q_latest_tied(spark, sf):
    """Two documents of one ingestion time for every even user: the later path counts."""
    daily = layer(spark, sf, "staging_daily")
    even = F.regexp_extract("city", "([0-9]+)", 1).cast("bigint") % 2 == 0
    second = daily.where(even).withColumns({
        "raw_file_path": F.regexp_replace("raw_file_path", "[.]json$", "_2.json"),
        "temperature_max_c": (F.col("temperature_max_c") + 1).cast("decimal(6,2)"),
    })
    rows = latest_snapshot(daily.unionByName(second), ["city"], "source_ingested_at_utc", ["forecast_date"], W.latest_order())
    return rows.select("city", "forecast_date", "temperature_max_c", "temperature_min_c", "source_ingested_at_utc")


def q_rank_per_day_nulls(spark, sf):
    """Ranks where every ninth user has no maximum: NULL ranks first, ties by name."""
    ninth = F.regexp_extract("city", "([0-9]+)", 1).cast("bigint") % 9 == 0
    daily = layer(spark, sf, "daily_summary")
    return W.build_rankings(daily.withColumn("temperature_max_c", F.when(~ninth, F.col("temperature_max_c")))).select(*W.RANKING_COLS)


def q_rolling_metrics(spark, sf):
    return W.build_rolling(layer(spark, sf, "daily_summary")).select(*W.ROLLING_COLS)


def q_rolling_history(spark, sf):
    """Rolling metrics over every staged day (all snapshots), so date gaps occur."""
    daily = layer(spark, sf, "staging_daily")
    per_day = latest_per_key(daily, ["city", "forecast_date"], W.latest_order())
    return W.rolling_metrics(W.summarize_daily(per_day))


# Five event types hold all events, so each group below is hot at any size.

def q_rank_values(spark, sf):
    """Rank of every event's value within its type (doubles, largest first), ties by user."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value", "user_id")
    return rank_within(events, ["event_type"], "value", ["user_id"], "value_rank")


def q_event_positions(spark, sf):
    return row_positions(table(spark, sf, "events").select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], "position")


def q_rolling_events(spark, sf):
    """The last five events of the type, at each event."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    aggs = {"n_events": F.count(F.lit(1)), "least": F.min("value"), "most": F.max("value"), "first_id": F.first("event_id")}
    return ranged_rolling(events, ["event_type"], ["ts", "event_id"], aggs, preceding=4)


# ---------------------------------------------------------------- quality

def _city_count(events: DataFrame) -> DataFrame:
    """The number of expected entities, as one row."""
    return events.agg(F.countDistinct("user_id").alias("cities"))


def q_dq_checks(spark, sf):
    return Q.collect_checks(mart_set(spark, sf), _city_count(table(spark, sf, "events")), forecast_days=7)


def spoiled_marts(spark, sf) -> dict[str, DataFrame]:
    """The marts with faults that every check must count, chosen by entity number."""
    marts = mart_set(spark, sf)
    n = F.regexp_extract("city", "([0-9]+)", 1).cast("bigint")
    daily = marts["daily_city_weather_summary"]
    spoiled = daily.withColumns({
        "precipitation_mm": F.when(n % 7 == 0, F.lit(None)).when(n % 11 == 0, F.col("precipitation_mm") - 1000).otherwise(F.col("precipitation_mm")),
        "temperature_max_c": F.when(n % 5 == 0, F.lit(95).cast("decimal(6,2)")).when(n % 13 == 0, F.col("temperature_min_c") - 1).otherwise(F.col("temperature_max_c")),
    })
    return {
        **marts,
        "city_current_weather": marts["city_current_weather"].withColumn("current_time_utc", F.when(n % 3 == 0, F.lit(None)).otherwise(F.col("current_time_utc"))),
        "daily_city_weather_summary": spoiled.unionByName(daily.where(n % 17 == 0)),
        "daily_temperature_rankings": marts["daily_temperature_rankings"].where("max_temperature_rank > 1"),
    }


def q_dq_spoiled(spark, sf):
    return Q.collect_checks(spoiled_marts(spark, sf), _city_count(table(spark, sf, "events")), forecast_days=7)


def q_quality_document(spark, sf):
    """The quality payload over the spoiled marts, one row per item next to its status and summary."""
    doc = Q.quality_document(spoiled_marts(spark, sf), _city_count(table(spark, sf, "events")))
    return doc.select("status", "summary.*", F.posexplode("items").alias("item", "i")).select("status", "passed", "failed", "total", "item", F.col("i.name").alias("name"), F.col("i.issue_count").alias("issue_count"))


def q_readiness(spark, sf):
    """Readiness of the marts, and of the marts without their rankings."""
    marts = mart_set(spark, sf)
    bare = {**marts, "daily_temperature_rankings": marts["daily_temperature_rankings"].where("max_temperature_rank < 0")}
    return V.readiness(marts).select(F.lit("marts").alias("of"), "ready").unionByName(V.readiness(bare).select(F.lit("without rankings").alias("of"), "ready"))


def q_dq_summary(spark, sf):
    return Q.summarize_checks(q_dq_checks(spark, sf))


def q_dq_driver_tables(spark, sf):
    """The generic check builders applied to supplier, customer and nation: one scan each."""
    counters = [
        Q.table_counters(table(spark, sf, "supplier"), "supplier", {
            "supplier_nulls": Q.any_null(["s_suppkey", "s_name", "s_nationkey"]),
            "supplier_negative": F.col("s_acctbal") < 0,
            "supplier_nation": Q.not_between("s_nationkey", 0, 24),
        }),
        Q.table_counters(table(spark, sf, "customer"), "customer", {
            "customer_negative": F.col("c_acctbal") < 0,
            "customer_range": Q.not_between("c_acctbal", -1000, 9000),
        }, unique=["c_name"]),
        Q.table_counters(table(spark, sf, "nation"), "nation"),
    ]
    return Q.check_rows(counters, [
        Q.Check("supplier_nulls", "Supplier key, name and nation should not be null.", F.col("supplier_nulls")),
        Q.Check("supplier_negative_balance", "Supplier account balance should not be negative.", F.col("supplier_negative")),
        Q.Check("supplier_nation_range", "Supplier nation key should lie in 0..24.", F.col("supplier_nation")),
        Q.Check("customer_negative_balance", "Customer account balance should not be negative.", F.col("customer_negative")),
        Q.Check("customer_balance_range", "Customer balance should lie in -1000..9000.", F.col("customer_range")),
        Q.Check("customer_duplicate_names", "Customer names should be unique.", F.col("customer_duplicates")),
        Q.Check("nation_row_count", "Nation table should hold 25 rows.", Q.is_not("nation_rows", F.lit(25))),
    ])


# ---------------------------------------------------------------- contracts

def q_contract_not_null(spark, sf):
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), on="doc_id", how="left")
    return K.not_null_violations(labelled, ["doc_id", "text", "quality", "toxic"], keys=["doc_id"])


def q_contract_unique(spark, sf):
    return K.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_contract_fk(spark, sf):
    """Foreign keys as they should hold, and against parents that lack rows, so orphans are counted too."""
    lineitem, orders, part, supplier, customer, nation, documents, labels = (
        table(spark, sf, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "nation", "documents", "labels")
    )
    raw, current, daily = (layer(spark, sf, n) for n in ("raw", "staging_current", "staging_daily"))
    early = F.col("ingested_at_utc") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    return K.fk_violation_counts([
        K.ForeignKey("lineitem_orders", lineitem, "l_orderkey", orders, "o_orderkey"),
        K.ForeignKey("lineitem_open_orders", lineitem, "l_orderkey", orders, "o_orderkey", F.col("o_orderstatus") != "F"),
        K.ForeignKey("lineitem_part", lineitem, "l_partkey", part, "p_partkey"),
        K.ForeignKey("lineitem_odd_part", lineitem, "l_partkey", part, "p_partkey", F.col("p_partkey") % 2 == 1),
        K.ForeignKey("lineitem_supplier", lineitem, "l_suppkey", supplier, "s_suppkey"),
        K.ForeignKey("orders_customer", orders, "o_custkey", customer, "c_custkey"),
        K.ForeignKey("orders_solvent_customer", orders, "o_custkey", customer, "c_custkey", F.col("c_acctbal") >= 0),
        K.ForeignKey("customer_nation", customer, "c_nationkey", nation, "n_nationkey"),
        K.ForeignKey("documents_labels", documents, "doc_id", labels),
        K.ForeignKey("labels_documents", labels, "doc_id", documents),
        K.ForeignKey("staging_current_raw", current, "raw_file_path", raw),
        K.ForeignKey("staging_daily_raw", daily, "raw_file_path", raw),
        K.ForeignKey("staging_daily_early_raw", daily, "raw_file_path", raw, where=early),
    ])


LINEITEM_DECLARED = StructType([
    StructField("l_quantity", DecimalType(6, 2)),
    StructField("l_extendedprice", DecimalType(7, 2)),
    StructField("l_discount", DecimalType(6, 2)),
    StructField("l_tax", DecimalType(6, 2)),
])


def q_contract_cast(spark, sf):
    li = table(spark, sf, "lineitem")
    _, rejects = K.apply_schema(li, LINEITEM_DECLARED, keys=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], on_error="reject")
    return rejects


# ---------------------------------------------------------------- views

def q_overview(spark, sf):
    return V.overview(mart_set(spark, sf))


def q_view_current(spark, sf):
    return V.view_current(layer(spark, sf, "mart_current"))


def q_view_daily(spark, sf):
    return V.view_daily(layer(spark, sf, "daily_summary"))


def q_view_rankings(spark, sf):
    return V.view_rankings(layer(spark, sf, "rankings"))


def q_view_rolling(spark, sf):
    return V.view_rolling(layer(spark, sf, "rolling"))


def q_view_json(spark, sf):
    return V.iso_strings(V.view_current(layer(spark, sf, "mart_current")))


# ---------------------------------------------------------------- files end to end

def _scratch(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")


def _land(events: DataFrame, landing: str, before: str | None = None) -> None:
    if before is not None:
        events = events.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    write_raw_documents(E.forecast_documents(events), landing, source_dir=E.EVENTS_SOURCE)


def _without_k(events: DataFrame, week: str) -> DataFrame:
    """The events, those of one week without ``k`` for every tenth user who has later ones:
    the documents of that week break NOT NULL while they are a user's newest."""
    later = events.where(F.col("ts") >= F.lit(week).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS")).select("user_id").distinct().withColumn("later", F.lit(True))
    bad = F.col("later") & (F.date_trunc("week", "ts") == F.lit(week).cast("timestamp")) & (F.col("user_id") % 10 == 0)
    return events.join(later, "user_id", "left").withColumn("props", F.when(bad, "{}").otherwise(F.col("props"))).drop("later")


def q_full_refresh(spark, sf):
    """Three refreshes over landed documents: a good one, one that a NULL fails at publish, and
    one with newer documents that mend it. Reads the published summary."""
    root = _scratch(spark, "full_refresh")
    landing, warehouse = f"{root}/landing", f"{root}/warehouse"
    ev = table(spark, sf, "events")

    def refresh(day: int) -> dict:
        return refresh_all(spark, landing, warehouse, city_count=0, run_at=dt.datetime(2024, 2, day), source_dir=E.EVENTS_SOURCE)

    _land(ev, landing, before="2024-01-08 00:00:00")
    refresh(1)
    _land(_without_k(ev, "2024-01-08 00:00:00"), landing, before="2024-01-15 00:00:00")
    try:
        refresh(2)
    except PySparkException as exc:
        if "NOT NULL violated" not in str(exc):
            raise
    _land(ev, landing)
    return refresh(3)["marts"]["daily_city_weather_summary"].select(*W.DAILY_SUMMARY_COLS)


def q_concurrent_refresh(spark, sf):
    """Two refreshes that meet: while the first is about to publish, newer documents land and the second
    loads, stages and publishes them. The first is overtaken and derives its marts anew. Reads the rankings."""
    root = _scratch(spark, "concurrent_refresh")
    landing, warehouse = f"{root}/landing", f"{root}/warehouse"
    ev = table(spark, sf, "events")
    meetings = []

    def refresh(day: int, meet=None) -> dict:
        return refresh_all(spark, landing, warehouse, city_count=0, run_at=dt.datetime(2024, 2, day), source_dir=E.EVENTS_SOURCE, before_commit=meet)

    def overtake() -> None:
        meetings.append(len(meetings))
        if len(meetings) == 1:  # the first is called again for its second attempt
            _land(ev, landing)
            refresh(3)

    _land(ev, landing, before="2024-01-08 00:00:00")
    refresh(1)
    _land(ev, landing, before="2024-01-15 00:00:00")
    refresh(2, overtake)
    return published_marts(spark, warehouse)["daily_temperature_rankings"].select(*W.RANKING_COLS)


def q_refresh_checks(spark, sf):
    """The checks of a refresh that wrote some buckets, from the counters taken while writing."""
    root = _scratch(spark, "refresh_checks")
    landing, warehouse = f"{root}/landing", f"{root}/warehouse"
    ev = table(spark, sf, "events")
    cities = _city_count(ev)
    for day, before in ((1, "2024-01-15 00:00:00"), (2, None)):
        _land(ev, landing, before)
        done = refresh_all(spark, landing, warehouse, city_count=cities, run_at=dt.datetime(2024, 2, day), source_dir=E.EVENTS_SOURCE)
    return done["checks"]


def q_table_catalogue(spark, sf):
    """The seven tables created where absent, filled from the layers of ``events``, and read back:
    what is declared of each column next to what the files hold."""
    warehouse = _scratch(spark, "table_catalogue")
    made = create_if_absent(spark, warehouse)
    layers = dict(zip(TABLES, ("raw", "staging_current", "staging_daily", "mart_current", "daily_summary", "rankings", "rolling")))
    for rel, name in layers.items():
        layer(spark, sf, name).select(*TABLES[rel].fieldNames()).write.mode("append").parquet(f"{warehouse}/{rel}")
    again = create_if_absent(spark, warehouse)  # tables that are there stay as they are
    declared = catalogue(spark).withColumn("created", F.col("table").isin(made) & ~F.col("table").isin(again))
    stored = stored_catalogue(spark, warehouse).withColumnsRenamed({"type": "stored_type"})
    return declared.join(stored, ["table", "column"]).select("table", "position", "column", "type", "nullable", "key_position", "created", (F.col("type") == F.col("stored_type")).alias("as_stored"), "n_rows")


def q_incremental_ingest(spark, sf):
    """Documents landed, landed again in a longer version before they are loaded, and replayed
    in full afterwards: raw holds, of each path, what had landed last at its first load."""
    root = _scratch(spark, "incremental")
    landing, wh, ck = f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint"
    ev = table(spark, sf, "events")
    _land(ev, landing, before="2024-01-10 00:00:00")
    _land(ev, landing, before="2024-01-17 00:00:00")
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2024, 1, 17), source_dir=E.EVENTS_SOURCE, packed=True)
    _land(ev, landing)
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2024, 2, 1), source_dir=E.EVENTS_SOURCE, packed=True)
    raw = read_table(spark, wh, RAW_TABLE)
    return raw.select(
        "raw_file_path", "source", "city", "ingested_at_utc",
        json_text("payload", [*W.CURRENT_PATH, "temperature_2m"]).cast("decimal(6,2)").alias("temperature"),
        F.size(json_array("payload", [*W.DAILY_PATH, "time"])).alias("n_days"),
    )


QUERIES = {
    "json_extract": q_json_extract,
    "partition_columns": q_partition_columns,
    "raw_envelope": q_raw_envelope,
    "envelope_rejects": q_envelope_rejects,
    "idempotent_append": q_idempotent_append,
    "append_counts": q_append_counts,
    "dimension_lookup": q_dimension_lookup,
    "dimension_rejects": q_dimension_rejects,
    "parallel_arrays": q_parallel_arrays,
    "ragged_arrays": q_ragged_arrays,
    "staging_current": q_staging_current,
    "staging_daily": q_staging_daily,
    "latest_per_key": q_latest_per_key,
    "mart_current": q_mart_current,
    "latest_snapshot": q_latest_snapshot,
    "daily_summary": q_daily_summary,
    "rank_per_day": q_rank_per_day,
    "rolling_metrics": q_rolling_metrics,
    "rolling_history": q_rolling_history,
    "rank_values": q_rank_values,
    "event_positions": q_event_positions,
    "rolling_events": q_rolling_events,
    "dq_checks": q_dq_checks,
    "dq_summary": q_dq_summary,
    "dq_driver_tables": q_dq_driver_tables,
    "contract_not_null": q_contract_not_null,
    "contract_unique": q_contract_unique,
    "contract_fk": q_contract_fk,
    "contract_cast": q_contract_cast,
    "overview": q_overview,
    "view_current": q_view_current,
    "view_daily": q_view_daily,
    "view_rankings": q_view_rankings,
    "view_rolling": q_view_rolling,
    "view_json": q_view_json,
    "envelope_contract": q_envelope_contract,
    "load_defaults": q_load_defaults,
    "request_plan": q_request_plan,
    "staging_repeated_dates": q_staging_repeated_dates,
    "latest_tied": q_latest_tied,
    "rank_per_day_nulls": q_rank_per_day_nulls,
    "dq_spoiled": q_dq_spoiled,
    "quality_document": q_quality_document,
    "readiness": q_readiness,
    "full_refresh": q_full_refresh,
    "incremental_ingest": q_incremental_ingest,
    "concurrent_refresh": q_concurrent_refresh,
    "refresh_checks": q_refresh_checks,
    "table_catalogue": q_table_catalogue,
}
