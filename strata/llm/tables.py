"""Input tables and written intermediates of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a private one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # the executors are other processes
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """The columns that text operators need, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
