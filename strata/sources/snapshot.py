"""Publish of a set of tables as one unit, with versions that share unchanged files.

A version is an entry of a numbered log (``commits``) that names the version it
was made from. Its manifest lists, for each table and each bucket of its rows, the write
that holds the bucket, so a version writes the buckets that it changes and
refers to the files of earlier versions for all others. A version is current
from the moment that its entry exists; a publisher that was overtaken gets
Conflict, leaves nothing behind, and has to derive its tables anew from the version
that came first.

Counters (rows, and rows that break a rule) are taken by the job that writes
rows and kept in the manifest, so the checks of a version need no scan of it: they are
those of the version before, less those of the replaced buckets (which one job
counts if only some are replaced), plus those of the new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.commits import ATTEMPTS, Conflict, add_entry, read_log
from strata.sources.storage import add_marker, delete, names, read_marker

LOG = "_versions"
MANIFESTS = "_manifests"
DATA = "data"
#: Partition columns of the files: the version that wrote them and the bucket.
WRITE, BUCKET = "in_write", "in_bucket"

Reader = Callable[..., DataFrame]


@dataclass(frozen=True)
class Part:
    """What a version writes of one table.

    ``rows`` may be a function of a reader: ``read(name)`` gives a table as it is in
    the new version, ``read(name, True)`` only the buckets that this version wrote. ``bucket``
    gives each row's bucket, 0 to ``buckets`` - 1; ``touched`` are the buckets that the rows
    replace, all of them when None. ``rules`` name conditions whose rows are counted.
    """

    rows: DataFrame | Callable[[Reader], DataFrame]
    bucket: Column | None = None
    buckets: int = 1
    touched: list[int] | None = None
    rules: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    """A published version; ``tables`` is its manifest."""

    number: int
    name: str
    parent: str | None
    covers: list[str]
    tables: dict[str, dict]

    def counters(self, table: str) -> dict[str, int]:
        return self.tables[table]["counters"]


def _log(base: str) -> str:
    return f"{base.rstrip('/')}/{LOG}"


def _version(spark: SparkSession, base: str, entry: dict) -> Version:
    tables = json.loads(read_marker(spark, f"{base.rstrip('/')}/{MANIFESTS}/{entry['version']}.json"))
    return Version(entry["number"], entry["version"], entry["parent"], entry["covers"], tables)


def _chain(spark: SparkSession, base: str) -> list[dict]:
    """The log's entries; each names the one before as its parent, or the log is damaged."""
    entries = read_log(spark, _log(base))
    for k, e in enumerate(entries):
        if e["number"] != k + 1 or e["parent"] != (entries[k - 1]["version"] if k else None):
            raise ValueError(f"{_log(base)}: entry {e['number']} does not follow the one before")
    return entries


def head(spark: SparkSession, base: str) -> Version | None:
    """The current version with its manifest."""
    entries = _chain(spark, base)
    return _version(spark, base, entries[-1]) if entries else None


def current_version(spark: SparkSession, base: str) -> str | None:
    entries = _chain(spark, base)
    return entries[-1]["version"] if entries else None


def covered(spark: SparkSession, base: str) -> list[str]:
    """Everything that the current version and those it was made from cover."""
    return sorted({c for e in _chain(spark, base) for c in e["covers"]})


def _read(spark: SparkSession, base: str, name: str, entry: dict, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a manifest entry, of ``buckets`` or of all: only their files are read."""
    schema = StructType.fromJson(entry["schema"])
    parts = {b: w for b, w in entry["parts"].items() if buckets is None or int(b) in buckets}
    if not parts:
        return spark.createDataFrame([], schema)
    root = f"{base.rstrip('/')}/{DATA}/{name}"
    placed = StructType([*schema.fields, StructField(WRITE, StringType()), StructField(BUCKET, StringType())])
    files = spark.read.schema(placed).option("basePath", root).parquet(*[f"{root}/{WRITE}={w}" for w in sorted(set(parts.values()))])
    return files.where(F.concat_ws("/", WRITE, BUCKET).isin([f"{w}/{b}" for b, w in parts.items()])).select(*schema.fieldNames())


def read_version(spark: SparkSession, base: str, version: Version, name: str, buckets: list[int] | None = None) -> DataFrame:
    return _read(spark, base, name, version.tables[name], buckets)


def read_snapshot(spark: SparkSession, base: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the current version, or of the one named."""
    found = [e for e in _chain(spark, base) if version in (None, e["version"])]
    if not found:
        raise FileNotFoundError(f"no snapshot {version or ''} published under {base}")
    return read_version(spark, base, _version(spark, base, found[-1]), name)


def _counted(rules: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]]


def _replaced(spark: SparkSession, base: str, before: dict[str, dict], parts: dict[str, Part]) -> dict[str, dict[str, int]]:
    """The counters of the buckets that ``parts`` replace, for all tables by one job at most."""
    found, rows = {}, []
    for name, part in parts.items():
        old = before.get(name)
        gone = None if old is None else [b for b in old["parts"] if part.touched is None or int(b) in part.touched]
        if not gone:
            found[name] = dict.fromkeys(["rows", *part.rules], 0)
        elif len(gone) == len(old["parts"]):
            found[name] = old["counters"]
        else:
            one = _read(spark, base, name, old, [int(b) for b in gone]).agg(*_counted(part.rules))
            rows.append(one.select(F.lit(name).alias("name"), F.map_from_arrays(F.array(*map(F.lit, one.columns)), F.array(*one.columns)).alias("counters")))
    if rows:
        found |= {r["name"]: r["counters"] for r in reduce(DataFrame.unionByName, rows).collect()}
    return found


def _write(spark: SparkSession, base: str, version: str, name: str, part: Part, rows: DataFrame, before: dict | None, gone: dict[str, int]) -> dict:
    """Write a table's part and return its manifest entry. The counters are taken above the
    shuffle that deals the buckets, in the tasks that write, so no row is counted twice."""
    fresh = dict.fromkeys(gone, 0)
    parts = {}
    if part.touched != []:
        seen, path = Observation(), f"{base}/{DATA}/{name}/{WRITE}={version}"
        bucket = (part.bucket if part.bucket is not None else F.lit(0)).cast("string")
        out = rows.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET)).observe(seen, *_counted(part.rules))
        out.write.partitionBy(BUCKET).parquet(path)
        fresh = seen.get
        parts = {n.removeprefix(f"{BUCKET}="): version for n in names(spark, path) if n.startswith(f"{BUCKET}=")}
    keep = {} if before is None or part.touched is None else {b: w for b, w in before["parts"].items() if int(b) not in part.touched}
    old = before["counters"] if before else dict.fromkeys(gone, 0)
    return {
        "schema": rows.schema.jsonValue(), "buckets": part.buckets, "parts": keep | parts,
        "counters": {n: old.get(n, 0) - gone.get(n, 0) + fresh[n] for n in ["rows", *part.rules]},
    }


def publish(
    spark: SparkSession,
    base: str,
    parts: dict[str, Part],
    parent: Version | None,
    covers: list[str] | None = None,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
    before_commit: Callable[[], None] | None = None,
) -> Version:
    """Write ``parts`` in the order given as the version after ``parent``.

    Tables without a part are those of ``parent``. ``check`` sees what was written of each
    table and may raise; then, and on Conflict, the files written go.
    """
    base = base.rstrip("/")
    number = (parent.number if parent else 0) + 1
    version = f"{number:09d}-{uuid.uuid4().hex[:8]}"
    tables = dict(parent.tables) if parent else {}
    touched: dict[str, list[int] | None] = {}

    def read(name: str, written: bool = False) -> DataFrame:
        return _read(spark, base, name, tables[name], touched[name] if written else None)

    def take_back() -> None:
        for name in parts:
            delete(spark, f"{base}/{DATA}/{name}/{WRITE}={version}")
        delete(spark, f"{base}/{MANIFESTS}/{version}.json")

    try:
        gone = _replaced(spark, base, tables, parts)
        for name, part in parts.items():
            rows = part.rows(read) if callable(part.rows) else part.rows
            tables[name] = _write(spark, base, version, name, part, rows, tables.get(name), gone[name])
            touched[name] = part.touched
        if check:
            check({name: read(name, True) for name in parts})
        add_marker(spark, f"{base}/{MANIFESTS}", f"{version}.json", json.dumps(tables))
        if before_commit:
            before_commit()
    except BaseException:
        take_back()
        raise
    try:
        add_entry(spark, _log(base), number, {"version": version, "parent": parent.name if parent else None, "covers": sorted(covers or [])})
    except Conflict:
        take_back()
        raise
    return Version(number, version, parent.name if parent else None, sorted(covers or []), tables)


def publish_snapshot(
    spark: SparkSession,
    tables: dict[str, DataFrame | Callable[[Reader], DataFrame]],
    base: str,
    covers: list[str] | None = None,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> str:
    """Full refresh of several tables as one unit: each replaces all that it held."""
    for _ in range(ATTEMPTS):
        try:
            return publish(spark, base, {n: Part(rows) for n, rows in tables.items()}, head(spark, base), covers, check).name
        except Conflict:
            continue
    raise Conflict(f"{base}: other publishers came first {ATTEMPTS} times")


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the files that none of the newest ``keep`` versions refers to; returns the folders that went.

    Entries stay, for what they cover. Versions count by their number, not by a clock: what was
    written for the number after the current one may still be published and is left alone;
    what was written for an earlier one and is not in the log lost its turn.
    """
    base = base.rstrip("/")
    entries = _chain(spark, base)
    if not entries:
        return []
    kept = [_version(spark, base, e) for e in entries[-keep:]]
    live = {(t, w, b) for v in kept for t, e in v.tables.items() for b, w in e["parts"].items()}
    gone = []
    for table in names(spark, f"{base}/{DATA}"):
        for folder in names(spark, f"{base}/{DATA}/{table}"):
            write = folder.removeprefix(f"{WRITE}=")
            if not folder.startswith(f"{WRITE}=") or int(write[:9]) > entries[-1]["number"]:
                continue
            inner = [n for n in names(spark, f"{base}/{DATA}/{table}/{folder}") if n.startswith(f"{BUCKET}=")]
            dead = [n for n in inner if (table, write, n.removeprefix(f"{BUCKET}=")) not in live]
            gone += [f"{table}/{folder}"] if len(dead) == len(inner) else [f"{table}/{folder}/{n}" for n in dead]
    for name in names(spark, f"{base}/{MANIFESTS}"):
        if not name.startswith(".") and int(name[:9]) <= entries[-1]["number"] and name.removesuffix(".json") not in [v.name for v in kept]:
            delete(spark, f"{base}/{MANIFESTS}/{name}")
    for folder in gone:
        delete(spark, f"{base}/{DATA}/{folder}")
    return gone
