"""Raw document envelope: build it from rows, parse and validate it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import iso_utc_z, parse_iso_instant

# Fixed values of the source contract.
SOURCE_NAME = "open-meteo"
REQUIRED_KEYS = ["source", "city", "ingested_at_utc", "payload"]
# Columns of the raw table that hold text, and no NULL; a JSON null payload is a value.
TEXT_KEYS = ["source", "city", "ingested_at_utc"]


def build_envelope(
    df: DataFrame,
    city: str | Column,
    payload: Column,
    ingested_at: str | Column,
    source: str | Column = SOURCE_NAME,
    keep: list[str] | None = None,
) -> DataFrame:
    """One JSON document per row in column ``value``.

    ``{"source", "city", "ingested_at_utc": ISO-8601 UTC with Z, "payload"}``;
    ``payload`` is any struct/variant column. A NULL field is left out of the
    document (``to_json`` drops it), which the parser reports as a missing key.
    """
    city_c = F.col(city) if isinstance(city, str) else city
    ts_c = F.col(ingested_at) if isinstance(ingested_at, str) else ingested_at
    src_c = F.lit(source) if isinstance(source, str) else source
    doc = F.struct(
        src_c.alias("source"),
        city_c.alias("city"),
        iso_utc_z(ts_c).alias("ingested_at_utc"),
        payload.alias("payload"),
    )
    return df.select(*(keep or []), F.to_json(doc).alias("value"))


def parse_envelope(df: DataFrame, on_error: str = "raise", path_col: str = "raw_file_path") -> tuple[DataFrame, DataFrame]:
    """Parse ``value`` JSON text into the raw-layer columns.

    Returns ``(good, rejects)``. ``good`` has ``source, city, ingested_at_utc
    (TIMESTAMP), payload (VARIANT)`` plus the other input columns. Every required
    key must be present, and source, city and time must be JSON strings (the
    payload may be anything, also null); the time has to be an ISO-8601 instant.
    Of a key that an object holds several times the last value counts.
    ``rejects`` carries the input columns and a ``reject_reason``.

    ``on_error="raise"`` fails the job on the first bad document (lazily, inside
    the scan, no extra pass); ``"reject"`` routes bad documents to ``rejects``.
    """
    if on_error not in ("raise", "reject"):
        raise ValueError("on_error must be 'raise' or 'reject'")
    others = [c for c in df.columns if c != "value"]
    doc = F.try_parse_json("value")
    # A present key holding JSON null yields a variant null (not SQL NULL);
    # only an absent key (or a non-object document) yields SQL NULL. The
    # document is parsed once; presence is read from the parsed variant.
    missing = F.filter(
        F.array(*[F.when(F.try_variant_get(F.col("__doc"), f"$.{k}", "variant").isNull(), F.lit(k)) for k in REQUIRED_KEYS]),
        lambda k: k.isNotNull(),
    )
    member = lambda k: F.try_variant_get(F.col("__doc"), f"$.{k}", "variant")
    named = lambda wrong: F.filter(F.array(*[F.when(wrong(member(k)), F.lit(k)) for k in TEXT_KEYS]), lambda k: k.isNotNull())
    empty = named(F.is_variant_null)
    no_text = named(lambda v: F.schema_of_variant(v) != "STRING")
    ts_text = F.try_variant_get("__doc", "$.ingested_at_utc", "string")
    # Sound documents, nearly all, are told by one look at each member.
    sound = reduce(lambda a, b: a & b, [F.schema_of_variant(member(k)) == "STRING" for k in TEXT_KEYS])
    sound = sound & member("payload").isNotNull() & parse_iso_instant(ts_text).isNotNull()
    reason = (
        F.when(sound, F.lit(None))
        .when(F.col("__doc").isNull(), F.lit("invalid JSON document"))
        .when(F.size("__missing") > 0, F.concat(F.lit("missing keys "), F.array_join("__missing", ", ")))
        .when(F.size("__empty") > 0, F.concat(F.lit("null keys "), F.array_join("__empty", ", ")))
        .when(F.size("__no_text") > 0, F.concat(F.lit("no text in keys "), F.array_join("__no_text", ", ")))
        .when(parse_iso_instant(ts_text).isNull(), F.lit("unparseable ingested_at_utc"))
    )
    # A list of one, taken apart: a filter on the reason, pushed below a plain column, would parse the document anew for every member it asks for.
    staged = df.select(*others, "value", F.explode(F.array(doc)).alias("__doc"))
    staged = staged.withColumns({"__missing": missing, "__empty": empty, "__no_text": no_text})
    staged = staged.withColumn("__reason", reason)
    if on_error == "raise":
        label = F.coalesce(F.col(path_col), F.lit("<document>")) if path_col in others else F.lit("<document>")
        staged = staged.withColumn(
            "__reason",
            F.when(F.col("__reason").isNotNull(), F.raise_error(F.concat(F.col("__reason"), F.lit(" in "), label))),
        )
    good = staged.where(F.col("__reason").isNull()).select(
        F.try_variant_get("__doc", "$.source", "string").alias("source"),
        F.try_variant_get("__doc", "$.city", "string").alias("city"),
        parse_iso_instant(ts_text).alias("ingested_at_utc"),
        F.try_variant_get("__doc", "$.payload", "variant").alias("payload"),
        *others,
    )
    rejects = staged.where(F.col("__reason").isNotNull()).select(*others, "value", F.col("__reason").alias("reject_reason"))
    return good, rejects
