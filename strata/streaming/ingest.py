"""Incremental raw ingest with Structured Streaming (each landing file loaded once).

The file source tracks which files it has already read in its checkpoint;
``Trigger.AvailableNow`` processes everything that arrived since the last run
and stops. Each micro-batch is a load whose batch is named by the query's id and
the epoch, appended through the same idempotent anti-join as the batch loader.
A batch that is replayed after a failure finds its own load in raw's log, or none:
it is loaded exactly once.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.refresh import append_raw
from strata.sources.raw_documents import PACKED, PACKED_SCHEMA, RAW_FILE_GLOB, SOURCE_DIR, document_key
from strata.sources.storage import read_marker


def raw_document_stream(
    spark: SparkSession, landing: str, source_dir: str = SOURCE_DIR, packed: bool = False, max_files: int = 10_000
) -> DataFrame:
    """Streaming frame of ``value`` (whole document), ``raw_file_path`` and ``landed_at``.

    ``packed`` reads the packed layout, otherwise one file per document.
    ``max_files`` bounds a micro-batch; what it leaves is the next batch.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if packed:
        rows = reader.schema(PACKED_SCHEMA).parquet(f"{landing.rstrip('/')}/{PACKED}")
        return rows.where(F.col("source") == source_dir).select("value", "raw_file_path", "landed_at")
    rows = reader.format("text").option("wholetext", True).load(f"{landing.rstrip('/')}/{RAW_FILE_GLOB.format(source=source_dir)}")
    return rows.select(
        "value", document_key(F.col("_metadata.file_path")).alias("raw_file_path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def ingest_available(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    checkpoint: str,
    run_at: _dt.datetime | None = None,
    source_dir: str = SOURCE_DIR,
    packed: bool = False,
) -> None:
    """Load every landing document not yet seen by this checkpoint, then stop."""

    def append_batch(batch: DataFrame, epoch_id: int) -> None:
        at = run_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        # The query's id is in its checkpoint: a replay has the same one, a new checkpoint another.
        query_id = json.loads(read_marker(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        batch = batch.persist()  # read for its days and again to be appended
        try:
            append_raw(spark, batch, warehouse, at, batch_id=f"{query_id}-{epoch_id}")
        finally:
            batch.unpersist()

    query = (
        raw_document_stream(spark, landing, source_dir, packed)
        .writeStream.foreachBatch(append_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
