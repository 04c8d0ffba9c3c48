"""End-to-end refresh over files: landing -> raw -> staging -> published marts -> checks.

Tables live under a warehouse folder:

* ``raw/weather_api_responses``    append-only, partitioned by load and the
  landing path's year/month/day, keyed by ``raw_file_path``
* ``staging/weather_current_conditions`` and ``staging/weather_daily_forecast``
  append-only, partitioned by the staging run and the raw load, keyed by
  ``raw_file_path`` (+ ``forecast_date``)
* ``_log/raw`` and ``_log/staged`` numbered logs (``sources.commits``): an entry
  of raw names one load, an entry of staged one staging run and its loads.
  Rows that no entry names do not count, whoever wrote them.
* ``_rejects``                     what staging could not take, by document
* ``mart/``                        versions of the four marts plus the
  latest-snapshot state they are derived from (``sources.snapshot``); a
  version's entry also names the loads that it covers

Every load passes three stages: raw, staged, published. A step takes whatever
has finished the step before and not its own, so a run continues where an
earlier one failed. Runs may meet: each step prepares its rows from the log as it
is, asks for the next entry, and starts over from the new log when another
run was faster. So no document is loaded or staged twice, and no version drops
what another published. A publish that fails (a NULL in a NOT NULL column, a
crash) leaves its loads to the next run, which raises the same error until
newer data mends it.

Work per run follows the new documents:

* The landing area is listed, not read. Raw's log keeps a digest of each day's
  files; only days whose digest differs are read, and their keys are compared
  with the raw rows of those days in the loads that hold some.
* A pending load's documents are parsed once, to one wide table that both
  staging tables and the rejects are taken from.
* Staging is append-only, so ``latest(state + new) = latest(all staging)``.
  State and city marts are kept in buckets of cities, rankings in
  buckets of dates; a version writes the buckets that new rows touch and refers to
  the files of earlier versions for the rest. ``refreshed_at_utc`` is thus the time at which a row's
  bucket was last written. ``rebuild=True`` computes all from all of staging.
* The checks of a version come from counters taken while its buckets were written.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.contracts import enforce_not_null, not_null_violations
from strata.operators.quality import counted_checks, mart_rules
from strata.operators.windows import latest_per_key, latest_snapshot
from strata.plans import weather as W
from strata.schemas import PRIMARY_KEYS, RAW_WEATHER, STAGING_CURRENT, STAGING_DAILY, TABLES, not_null_columns
from strata.sources.append import dedupe_first
from strata.sources.commits import ATTEMPTS, Conflict, commit, read_log
from strata.sources.envelope import parse_envelope
from strata.sources.raw_documents import DAY_COLS, SOURCE_DIR, in_days, landed_last, landing_days, packed_documents, read_raw_documents
from strata.sources.snapshot import Part, Version, covered, head, publish, read_snapshot, read_version
from strata.sources.storage import delete, exists

RAW_TABLE = "raw/weather_api_responses"
STG_CURRENT = "staging/weather_current_conditions"
STG_DAILY = "staging/weather_daily_forecast"
RAW_LOG = "_log/raw"
STAGED_LOG = "_log/staged"
REJECTS = "_rejects"
MART_DIR = "mart"
MART_NAMES = ["city_current_weather", "daily_city_weather_summary", "daily_temperature_rankings", "city_rolling_3day_metrics"]
LOAD = "load_id"
RAW_LOAD = "raw_load_id"
STAGE = "stage_id"
#: Buckets of a mart table unless a warehouse has been built with another number.
MART_BUCKETS = 16


def _with_strings(schema: StructType, names: list[str]) -> StructType:
    return StructType([*schema.fields, *[StructField(n, StringType()) for n in names]])


# Declared read schemas: partition values stay text (no type inference), and
# a table folder holding no data files still reads as an empty table.
TABLE_SCHEMAS = {
    RAW_TABLE: _with_strings(RAW_WEATHER, [LOAD, *DAY_COLS]),
    STG_CURRENT: _with_strings(STAGING_CURRENT, [STAGE, RAW_LOAD]),
    STG_DAILY: _with_strings(STAGING_DAILY, [STAGE, RAW_LOAD]),
}
STATE_CURRENT = "_state_current"
STATE_DAILY = "_state_daily"


def mart_not_null(name: str) -> list[str]:
    """Declared NOT NULL columns of a mart; a NULL fails the refresh before publish."""
    return not_null_columns(TABLES[f"mart/{name}"])


def _path(base: str, rel: str) -> str:
    return f"{base.rstrip('/')}/{rel}"


def _files(spark: SparkSession, base: str, rel: str) -> DataFrame:
    """All files of a table with its declared schema, whether or not their writer finished."""
    path, schema = _path(base, rel), TABLE_SCHEMAS[rel]
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def raw_rows(spark: SparkSession, base: str, loads: list[str]) -> DataFrame:
    """Raw rows of these loads (partition pruning)."""
    return _files(spark, base, RAW_TABLE).where(F.col(LOAD).isin(loads))


def staged_rows(spark: SparkSession, base: str, rel: str, entries: list[dict], loads: list[str] | None = None) -> DataFrame:
    """Rows of a staging table that ``entries`` of the staged log name, of ``loads`` or of all."""
    wanted = [e for e in entries if loads is None or set(e["loads"]) & set(loads)]
    rows = _files(spark, base, rel).where(F.col(STAGE).isin([e[STAGE] for e in wanted]))
    return rows if loads is None else rows.where(F.col(RAW_LOAD).isin(loads))


def read_table(spark: SparkSession, base: str, rel: str) -> DataFrame:
    """The committed rows of a warehouse table."""
    if rel == RAW_TABLE:
        return raw_rows(spark, base, [e[LOAD] for e in read_log(spark, _path(base, RAW_LOG)) if e[LOAD]])
    return staged_rows(spark, base, rel, read_log(spark, _path(base, STAGED_LOG)))


def with_path_days(raw: DataFrame) -> DataFrame:
    """Add the landing path's date as partition columns."""
    return raw.select("*", *[F.regexp_extract("raw_file_path", rf"{c}=([^/]+)/", 1).alias(c) for c in DAY_COLS])


def _stamp(at: _dt.datetime) -> str:
    return f"{at:%Y-%m-%d %H:%M:%S.%f}"


# ---------------------------------------------------------------- the logs

def new_load_id(run_at: _dt.datetime) -> str:
    """An id that no other load has; ids of later runs sort later."""
    return f"{run_at:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}"


def _pending(raw: list[dict], staged: list[dict]) -> list[str]:
    done = {load for e in staged for load in e["loads"]}
    return sorted(e[LOAD] for e in raw if e[LOAD] and e[LOAD] not in done)


def pending_loads(spark: SparkSession, warehouse: str) -> list[str]:
    """Loads in raw that are not yet staged."""
    return _pending(read_log(spark, _path(warehouse, RAW_LOG)), read_log(spark, _path(warehouse, STAGED_LOG)))


def unpublished_loads(spark: SparkSession, warehouse: str) -> list[str]:
    """Loads that are staged but that no published version covers."""
    done = set(covered(spark, _path(warehouse, MART_DIR)))
    return sorted(load for e in read_log(spark, _path(warehouse, STAGED_LOG)) for load in e["loads"] if load not in done)


# ---------------------------------------------------------------- raw

def known_paths(spark: SparkSession, warehouse: str, entries: list[dict], days: list[tuple[str, str, str]]) -> DataFrame:
    """The keys that raw holds of ``days``: only loads with documents of these days are read, and of those only these days."""
    wanted = {"-".join(d) for d in days}
    loads = [e[LOAD] for e in entries if e[LOAD] and wanted & set(e["days"])]
    return raw_rows(spark, warehouse, loads).where(in_days(days)).select("raw_file_path")


def _append(
    spark: SparkSession, docs: DataFrame, warehouse: str, entries: list[dict], run_at: _dt.datetime, days: list[tuple[str, str, str]]
) -> tuple[str, int]:
    """Write the documents of ``days`` whose path no load of ``entries`` holds, as a load of its own; its id and rows."""
    load_id = new_load_id(run_at)
    known = known_paths(spark, warehouse, entries, days)
    new = dedupe_first(docs, ["raw_file_path"], landed_last()).join(known, "raw_file_path", "left_anti")
    good, _ = parse_envelope(new, on_error="raise")
    rows = W.build_raw(good, loaded_at=F.lit(_stamp(run_at)).cast("timestamp"))
    rows = enforce_not_null(rows, [c for c in not_null_columns(RAW_WEATHER) if c != "payload"], RAW_TABLE)
    written = Observation()
    rows = with_path_days(rows).withColumn(LOAD, F.lit(load_id)).observe(written, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").partitionBy(LOAD, *DAY_COLS).parquet(_path(warehouse, RAW_TABLE))
    return load_id, written.get["n"]


def append_raw(spark: SparkSession, docs: DataFrame, warehouse: str, run_at: _dt.datetime, batch_id: str | None = None) -> int:
    """Append documents (``value``, ``raw_file_path``, ``landed_at``) whose path raw does not hold; how many were new.

    Of several rows of one path the one landed last counts. Only raw's
    partitions of the documents' days are compared. A batch whose ``batch_id`` raw's
    log already has is not appended again.
    """
    days = sorted(tuple(r) for r in with_path_days(docs.select("raw_file_path")).select(*DAY_COLS).distinct().collect())
    new = 0

    def prepare(entries: list[dict]):
        nonlocal new
        new = 0
        if not days or (batch_id and any(e["batch"] == batch_id for e in entries)):
            return None
        load_id, new = _append(spark, docs, warehouse, entries, run_at, days)
        entry = {LOAD: load_id if new else None, "batch": batch_id, "days": ["-".join(d) for d in days] if new else [], "listed": {}}
        return entry, lambda: delete(spark, f"{_path(warehouse, RAW_TABLE)}/{LOAD}={load_id}")

    commit(spark, _path(warehouse, RAW_LOG), prepare)
    return new


def load_raw(spark: SparkSession, landing: str, warehouse: str, run_at: _dt.datetime, source_dir: str = SOURCE_DIR) -> dict:
    """Append the landed documents that raw does not hold; counts of documents in the landing area.

    Days whose files are those that the log saw last are not read (the days are
    bounded by the calendar). The entry of a load also keeps the new digests and the
    number of documents of the days read, so the counts need no second look.
    """
    counts = {"inserted": 0, "skipped": 0, "total": 0}

    def prepare(entries: list[dict]):
        seen = {d: v for e in entries for d, v in e["listed"].get(f"{landing}|{source_dir}", {}).items()}
        listed = {tuple(r[c] for c in DAY_COLS): r for r in landing_days(spark, landing, source_dir).collect()}
        changed = sorted(d for d, r in listed.items() if seen.get("-".join(d), [None])[0] != r["digest"])
        packed = packed_documents(spark, landing, source_dir, [d for d in changed if listed[d]["n_packed"]])
        rows = {tuple(r[c] for c in DAY_COLS): r["n"] for r in packed.collect()} if changed else {}
        fresh = {"-".join(d): [listed[d]["digest"], listed[d]["n_single"] + rows.get(d, 0)] for d in changed}
        counts["total"] = sum((seen | fresh)[d][1] for d in map("-".join, listed))
        load_id, counts["inserted"] = None, 0
        if changed:
            load_id, counts["inserted"] = _append(spark, read_raw_documents(spark, landing, source_dir, changed), warehouse, entries, run_at, changed)
        counts["skipped"] = counts["total"] - counts["inserted"]
        if not changed:
            return None
        new = bool(counts["inserted"])
        entry = {LOAD: load_id if new else None, "batch": None, "days": ["-".join(d) for d in changed] if new else [], "listed": {f"{landing}|{source_dir}": fresh}}
        return entry, lambda: delete(spark, f"{_path(warehouse, RAW_TABLE)}/{LOAD}={load_id}")

    commit(spark, _path(warehouse, RAW_LOG), prepare)
    return counts


# ---------------------------------------------------------------- staging

def _keep_rejects(spark: SparkSession, rejects: DataFrame, warehouse: str, loads: list[str]) -> int:
    """Add to the rejects table those (load_id, raw_file_path, field, reason) that it does not hold; how many there are."""
    path, key = _path(warehouse, REJECTS), [LOAD, "raw_file_path", "field", "reason"]
    seen = Observation()
    rejects = rejects.select(*key).distinct()
    if exists(spark, path):
        held = spark.read.schema("raw_file_path string, field string, reason string, load_id string").parquet(path).where(F.col(LOAD).isin(loads))
        rejects = rejects.join(held.withColumn("held", F.lit(True)), key, "left").withColumn("held", F.coalesce("held", F.lit(False)))
    else:
        rejects = rejects.withColumn("held", F.lit(False))
    rejects = rejects.observe(seen, F.count(F.lit(1)).alias("n")).where("NOT held").drop("held")
    rejects.write.mode("append").partitionBy(LOAD).parquet(path)
    return seen.get["n"]


def load_staging(spark: SparkSession, warehouse: str, staged_at: str, strict: bool = True) -> list[str]:
    """Stage the raw rows of all pending loads; returns the loads.

    Documents whose daily arrays are JSON null or no arrays are written to the
    rejects table. In strict mode they fail the load (its loads stay pending),
    and so does a NULL in a declared NOT NULL column; otherwise such documents
    contribute no daily rows, and rows with such a NULL go to the rejects.
    Raw holds a path once and a load is staged once, so no key can be there already.
    """

    def prepare(entries: list[dict]):
        loads = _pending(read_log(spark, _path(warehouse, RAW_LOG)), entries)
        if not loads:
            return None
        stage, at = uuid.uuid4().hex, F.lit(staged_at).cast("timestamp")
        wide = _path(warehouse, f"_flat/{stage}")

        def undo() -> None:
            for rel in (STG_CURRENT, STG_DAILY):
                delete(spark, f"{_path(warehouse, rel)}/{STAGE}={stage}")

        try:
            flat = W.flatten_documents(raw_rows(spark, warehouse, loads), [LOAD])
            flat.write.parquet(wide)
            flat = spark.read.schema(flat.schema).parquet(wide)
            n = _keep_rejects(spark, W.array_rejects(flat, [LOAD]), warehouse, loads)
            if n and strict:
                raise ValueError(f"Malformed daily arrays: {n} fields, listed in {_path(warehouse, REJECTS)}")
            for rel, build, schema in ((STG_CURRENT, W.current_rows, STAGING_CURRENT), (STG_DAILY, W.daily_rows, STAGING_DAILY)):
                rows, needed = build(flat, at, [LOAD]), not_null_columns(schema)
                if strict:
                    rows = enforce_not_null(rows, needed, rel)
                else:
                    nulls = not_null_violations(rows, needed, ["raw_file_path", LOAD]).withColumnRenamed("column", "field")
                    _keep_rejects(spark, nulls.withColumn("reason", F.lit(f"NULL in {rel}")), warehouse, loads)
                    rows = rows.dropna(subset=needed)
                rows = rows.withColumnRenamed(LOAD, RAW_LOAD).withColumn(STAGE, F.lit(stage)).select(*schema.fieldNames(), STAGE, RAW_LOAD)
                rows.write.mode("append").partitionBy(STAGE, RAW_LOAD).parquet(_path(warehouse, rel))
        except BaseException:
            undo()
            raise
        finally:
            delete(spark, wide)
        return {STAGE: stage, "loads": loads}, undo

    entry = commit(spark, _path(warehouse, STAGED_LOG), prepare)
    return entry["loads"] if entry else []


# ---------------------------------------------------------------- marts

def city_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("city"), F.lit(buckets))


def date_bucket(buckets: int) -> Column:
    """Neighbouring dates lie in different buckets, so a week of new rows touches at most seven and their rows are spread."""
    return F.pmod(F.datediff("forecast_date", F.lit("1970-01-01").cast("date")), F.lit(buckets))


def check_primary_keys(written: dict[str, DataFrame]) -> None:
    """Raise when what was written of a mart holds a key twice; one job for all of them."""
    counts = []
    for name, df in written.items():
        keys = PRIMARY_KEYS.get(f"mart/{name}")
        if keys:
            twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            counts.append(twice.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(", ".join(keys)).alias("keys"), "n"))
    if not counts:
        return
    found = counts[0]
    for c in counts[1:]:
        found = found.unionByName(c)
    for r in found.where("n > 0").collect():
        raise ValueError(f"PRIMARY KEY violated: {r['n']} values of {r['keys']} occur more than once in {r['name']}")


def _touched(rows: DataFrame, bucket: Column) -> list[int]:
    """The buckets of the rows; there are no more than the table has."""
    return sorted(r[0] for r in rows.select(bucket.cast("int").alias("b")).where("b IS NOT NULL").distinct().collect())


def mart_parts(
    spark: SparkSession, warehouse: str, now: Version | None, entries: list[dict], loads: list[str], stamp: str, strict: bool, buckets: int
) -> dict[str, Part]:
    """What the version after ``now`` writes for ``loads``; without ``now`` everything, from all of staging."""
    mart, at = _path(warehouse, MART_DIR), F.lit(stamp).cast("timestamp")
    by_city, by_date = city_bucket(buckets), date_bucket(buckets)
    new_current = staged_rows(spark, warehouse, STG_CURRENT, entries, loads if now else None).drop(STAGE, RAW_LOAD)
    new_daily = staged_rows(spark, warehouse, STG_DAILY, entries, loads if now else None).drop(STAGE, RAW_LOAD)
    cities = dates = None
    current, daily = new_current, new_daily
    if now:
        cities = _touched(new_current.select("city").unionByName(new_daily.select("city")), by_city)
        old_daily = read_version(spark, mart, now, STATE_DAILY, cities)
        # Dates whose ranks may change: those that a city with new rows had or gets.
        had = old_daily.join(new_daily.select("city").distinct(), "city", "left_semi")
        dates = _touched(had.select("forecast_date").unionByName(new_daily.select("forecast_date")), by_date) if cities else []
        current = read_version(spark, mart, now, STATE_CURRENT, cities).unionByName(new_current)
        daily = old_daily.unionByName(new_daily)

    def checked(name, df):
        return enforce_not_null(df, mart_not_null(name), name) if strict else df

    def rankings(read) -> DataFrame:
        summary = read("daily_city_weather_summary")
        return W.build_rankings(summary if dates is None else summary.where(by_date.isin(dates)), at)

    rules = {name: r for name, (_, r) in mart_rules().items()}
    in_cities = lambda rows, name=None: Part(rows, by_city, buckets, cities, rules.get(name, {}))
    return {
        STATE_CURRENT: in_cities(latest_per_key(current, ["city"], W.latest_order())),
        STATE_DAILY: in_cities(latest_snapshot(daily, ["city"], "source_ingested_at_utc", ["forecast_date"], W.latest_order())),
        "city_current_weather": in_cities(
            lambda read: checked("city_current_weather", read(STATE_CURRENT, True).select(*W.MART_CURRENT_COLS, at.alias("refreshed_at_utc"))), "city_current_weather"
        ),
        "daily_city_weather_summary": in_cities(
            lambda read: checked("daily_city_weather_summary", W.summarize_daily(read(STATE_DAILY, True)).withColumn("refreshed_at_utc", at)), "daily_city_weather_summary"
        ),
        "daily_temperature_rankings": Part(
            lambda read: checked("daily_temperature_rankings", rankings(read)), by_date, buckets, dates, rules["daily_temperature_rankings"]
        ),
        "city_rolling_3day_metrics": in_cities(
            lambda read: checked("city_rolling_3day_metrics", W.build_rolling(read("daily_city_weather_summary", True), at)), "city_rolling_3day_metrics"
        ),
    }


def publish_marts(
    spark: SparkSession, warehouse: str, stamp: str, strict: bool = True, rebuild: bool = False, buckets: int = MART_BUCKETS,
    before_commit: Callable[[], None] | None = None,
) -> Version | None:
    """Publish a version that covers all staged loads; the current one when it does already.

    Overtaken by another publisher, the parts are derived anew from the version that it
    published, for the loads that are still not covered. ``before_commit`` is called when
    everything is written and only the entry is missing.
    """
    mart = _path(warehouse, MART_DIR)
    for _ in range(ATTEMPTS):
        now = head(spark, mart)
        entries = read_log(spark, _path(warehouse, STAGED_LOG))
        done = set(covered(spark, mart))
        loads = sorted(load for e in entries for load in e["loads"] if load not in done)
        if now and not loads and not rebuild:
            return now
        if not entries:
            return None
        kept = now.tables[STATE_DAILY]["buckets"] if now and not rebuild else buckets
        parts = mart_parts(spark, warehouse, None if rebuild else now, entries, loads, stamp, strict, kept)
        try:
            return publish(spark, mart, parts, now, loads, check_primary_keys, before_commit)
        except Conflict:
            continue
    raise Conflict(f"{mart}: other publishers came first {ATTEMPTS} times")


def refresh_all(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    city_count: int,
    forecast_days: int = 7,
    run_at: _dt.datetime | None = None,
    strict: bool = True,
    source_dir: str = SOURCE_DIR,
    rebuild: bool = False,
    before_commit: Callable[[], None] | None = None,
) -> dict:
    """Load, stage, maintain and publish the marts, then build the quality checks.

    Returns ``{"raw": counts, "version", "checks": DataFrame, "marts": {name: DataFrame}}``.
    """
    run_at = run_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    counts = load_raw(spark, landing, warehouse, run_at, source_dir)
    out = refresh_from_raw(spark, warehouse, city_count, forecast_days, run_at, strict, rebuild, before_commit)
    out["raw"] = counts
    return out


def refresh_from_raw(
    spark: SparkSession,
    warehouse: str,
    city_count: int,
    forecast_days: int = 7,
    run_at: _dt.datetime | None = None,
    strict: bool = True,
    rebuild: bool = False,
    before_commit: Callable[[], None] | None = None,
) -> dict:
    """Stage every pending load already in raw (batch or streaming), then maintain and publish the marts."""
    stamp = _stamp(run_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    load_staging(spark, warehouse, stamp, strict)
    version = publish_marts(spark, warehouse, stamp, strict, rebuild, before_commit=before_commit)
    if version is None:
        return {"raw": None, "version": None, "checks": None, "marts": None}
    mart = _path(warehouse, MART_DIR)
    # Keys that occur twice never get this far.
    checks = counted_checks(spark, {n: version.counters(n) for n in MART_NAMES}, city_count, forecast_days)
    return {"raw": None, "version": version.name, "checks": checks, "marts": {n: read_version(spark, mart, version, n) for n in MART_NAMES}}


def published_marts(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {n: read_snapshot(spark, _path(warehouse, MART_DIR), n) for n in MART_NAMES}
