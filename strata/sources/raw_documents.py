"""Landing area of raw JSON documents: two layouts, their keys, read and write.

* One file per document under ``source=/year=/month=/day=/run_id=/city=<slug>.json``,
  as the source system lands them; it is read, never written here.
* Packed Parquet files under ``packed/source=/year=/month=/day=``, a row per
  document with its ``raw_file_path`` and ``landed_at``; ``write_raw_documents``
  writes these, so billions of small documents do not become billions of files.

A document is known by its path. Landing a path again replaces the document:
readers that see both rows take the one landed last.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import run_id, slug
from strata.sources.storage import exists

log = logging.getLogger("strata.sources")

# Fixed values of the landing layout.
SOURCE_DIR = "open_meteo"
RAW_FILE_GLOB = "source={source}/year=*/month=*/day=*/run_id=*/city=*.json"
DAYS_GLOB = "source={source}/{{{days}}}/run_id=*/city=*.json"
PACKED_GLOB = "source={source}/year=*/month=*/day=*/*.parquet"
PACKED = "packed"
PACKED_SCHEMA = "raw_file_path string, value string, landed_at timestamp, source string, year string, month string, day string"
DAY_COLS = ["year", "month", "day"]
# The stable key of a document: its path relative to the landing base,
# ending at the ``city=<slug>.json`` segment (a Spark-written document is a
# part file inside a directory of that name).
_KEY_PATTERN = r"(source=[^/]+/year=[^/]+/month=[^/]+/day=[^/]+/run_id=[^/]+/city=[^/]+\.json)"


def with_partition_columns(df: DataFrame, city: str | Column, run_at: str | Column, source_dir: str = SOURCE_DIR) -> DataFrame:
    """Add ``year, month, day, run_id, city_slug`` (UTC, zero padded) and ``raw_file_path``.

    ``raw_file_path`` is ``source=<s>/year=YYYY/month=MM/day=DD/run_id=YYYYMMDDTHHMMSSZ/city=<slug>.json``.
    """
    city_c = F.col(city) if isinstance(city, str) else city
    ts = F.col(run_at) if isinstance(run_at, str) else run_at
    out = df.select(
        "*",
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
        run_id(ts).alias("run_id"),
        slug(city_c).alias("city_slug"),
    )
    return out.withColumn(
        "raw_file_path",
        F.concat(
            F.lit(f"source={source_dir}/year="), "year", F.lit("/month="), "month", F.lit("/day="), "day",
            F.lit("/run_id="), "run_id", F.lit("/city="), "city_slug", F.lit(".json"),
        ),
    )


def write_raw_documents(docs: DataFrame, base: str, source_dir: str = SOURCE_DIR, landed_at: Column | None = None) -> None:
    """Land documents (``value``, ``raw_file_path`` and the day columns) in packed files.

    The rebalance hint lets AQE cut a large day into several files and put
    small days of a task into few.
    """
    out = docs.select(
        "raw_file_path", "value", (landed_at if landed_at is not None else F.current_timestamp()).alias("landed_at"),
        F.lit(source_dir).alias("source"), *DAY_COLS,
    )
    out.hint("rebalance", *[F.col(c) for c in DAY_COLS]).write.mode("append").partitionBy("source", *DAY_COLS).parquet(f"{base.rstrip('/')}/{PACKED}")


def _packed(spark: SparkSession, base: str, source_dir: str) -> DataFrame | None:
    path = f"{base.rstrip('/')}/{PACKED}"
    return spark.read.schema(PACKED_SCHEMA).parquet(path).where(F.col("source") == source_dir) if exists(spark, path) else None


def _or_none(spark: SparkSession, folder: str, read) -> DataFrame | None:
    """What ``read`` gives, or None when the folder is not there or no file in it matches."""
    if not exists(spark, folder):
        return None
    try:
        return read()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def document_key(file_path: Column) -> Column:
    """The key of the file that ``_metadata.file_path``, a URI, names: blanks and escapes as they were."""
    return F.regexp_extract(F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B"))), _KEY_PATTERN, 1)


def in_days(days: list[tuple[str, str, str]]) -> Column:
    """Rows whose day columns name one of ``days`` (a filter that prunes partitions)."""
    return F.concat_ws("-", *DAY_COLS).isin(["-".join(d) for d in days])


def landing_days(spark: SparkSession, base: str, source_dir: str = SOURCE_DIR) -> DataFrame:
    """Per day with files: ``year, month, day``, ``n_single`` (files of one document), ``n_packed``, and
    ``digest`` of the names, sizes and times of all its files. The files are listed, not opened.

    A day whose digest is known holds nothing new.
    """
    base = base.rstrip("/")
    parts = []
    for glob, packed in ((RAW_FILE_GLOB, False), (f"{PACKED}/{PACKED_GLOB}", True)):
        files = _or_none(spark, f"{base}/{glob.split('/year=')[0].format(source=source_dir)}", lambda g=glob: spark.read.format("binaryFile").load(f"{base}/{g.format(source=source_dir)}"))
        if files is not None:
            parts.append(files.select(F.regexp_extract("path", r"(source=.*)$", 1).alias("name"), "length", "modificationTime", F.lit(packed).alias("packed")))
    if not parts:
        return spark.createDataFrame([], "year string, month string, day string, n_single bigint, n_packed bigint, digest string")
    files = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    files = files.select("*", *[F.regexp_extract("name", rf"{c}=([^/]+)/", 1).alias(c) for c in DAY_COLS])
    part = lambda seed: F.hex(F.bit_xor(F.xxhash64(F.lit(seed), "name", "length", "modificationTime")))
    return files.groupBy(*DAY_COLS).agg(
        F.count_if(~F.col("packed")).alias("n_single"), F.count_if("packed").alias("n_packed"), F.concat_ws("-", F.count(F.lit(1)), part(1), part(2)).alias("digest")
    )


def packed_documents(spark: SparkSession, base: str, source_dir: str, days: list[tuple[str, str, str]]) -> DataFrame:
    """``year, month, day, n``: rows of packed documents in those of ``days`` that have some (file footers only)."""
    packed = _packed(spark, base, source_dir)
    if packed is None or not days:
        return spark.createDataFrame([], "year string, month string, day string, n bigint")
    return packed.where(in_days(days)).groupBy(*DAY_COLS).agg(F.count(F.lit(1)).alias("n"))


def read_raw_documents(
    spark: SparkSession, base: str, source_dir: str = SOURCE_DIR, days: list[tuple[str, str, str]] | None = None
) -> DataFrame:
    """One row per landed document: ``value`` (whole text), ``raw_file_path`` and ``landed_at``.

    With ``days`` only those days' folders are read. ``raw_file_path`` is
    relative to ``base`` so moving the landing area does not make every
    document look new. No matching file gives an empty frame and a warning.
    Partition directories are not parsed as columns: the document's own fields
    are authoritative.
    """
    base = base.rstrip("/")
    glob = RAW_FILE_GLOB.format(source=source_dir)
    if days is not None:
        glob = DAYS_GLOB.format(source=source_dir, days=",".join(f"year={y}/month={m}/day={d}" for y, m, d in days))
    parts = []
    files = _or_none(spark, f"{base}/source={source_dir}", lambda: spark.read.text(f"{base}/{glob}", wholetext=True)) if days != [] else None
    if files is not None:
        parts.append(files.select("value", document_key(F.col("_metadata.file_path")).alias("raw_file_path"), F.col("_metadata.file_modification_time").alias("landed_at")))
    packed = _packed(spark, base, source_dir)
    if packed is not None:
        parts.append((packed if days is None else packed.where(in_days(days))).select("value", "raw_file_path", "landed_at"))
    if not parts:
        log.warning("Nothing has landed under %s", base)
        return spark.createDataFrame([], "value string, raw_file_path string, landed_at timestamp")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def landed_last() -> list[Column]:
    """The order in which rows of one path supersede each other; it tells any two different rows apart."""
    return [F.col("landed_at").desc_nulls_last(), F.col("value").desc_nulls_last()]
