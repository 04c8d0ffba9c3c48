"""Documents for the operators' tests: a given table's rows and hard cases."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Columns whose names the operators use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("n_words", T.StringType()),
    T.StructField("kept", T.StringType()),
    T.StructField("node", T.StringType()),
    T.StructField("found", T.IntegerType()),
    T.StructField("row", T.StringType()),
])
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
HARD = [
    (10_001, None), (10_002, ""), (10_003, "   \n\t "), (10_004, "one"), (10_005, "one"), (10_006, "Two words"), (10_007, LONG), (10_008, LONG + " tail"),
    (10_009, "nobreak here　wide\x85next \U0001F600 ▁mark"), (10_010, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (10_011, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (10_012, "A B C D e f g h i j k l m n o p q r s t u v w x y z"),
    (10_013, "same line here\nsame line here\nother"), (10_014, "x <|endoftext|> y  z\n"), (10_015, "\x00 nul"), (10_016, "tab\tsep\x0bvt\x0cff\rcr"),
]


def hard_rows():
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 2 else "src0", None, "x", "k", "n", 1, "r") for i, t in HARD]
    return rows + [rows[9], rows[9], (None, "a null id with a few words in it for good measure", "en", "src0", 5, "x", "k", "n", 1, "r")]


def documents(spark, sf_dir):
    """All rows of the given table and the hard ones, with the extra columns."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", "k", "n", 1, "r") for r in given]
    return spark.createDataFrame(rows + hard_rows(), SCHEMA).repartition(5)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOWER)


def fold(doc_id, by):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % by
