"""Scalar column functions (JSON paths, exact casts, UTC formatting, slugs).

Every function returns a Column built from Spark built-ins, so the work stays
inside whole-stage codegen; none of them runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _json_path(path: str | list[str]) -> str:
    if isinstance(path, str):
        parts = [p for p in path.replace("$.", "").split(".") if p]
    else:
        parts = list(path)
    return "$" + "".join(f".{p}" for p in parts)


def json_text(doc: ColumnOrName, path: str | list[str]) -> Column:
    """Text at a JSON path of a VARIANT document; missing key or JSON null gives NULL.

    Documents are parsed to VARIANT once (``parse_json``/``parse_envelope``) so
    every path is read from the binary form. Objects and arrays come back as
    JSON text.
    """
    return F.try_variant_get(_col(doc), _json_path(path), "string")


def json_array(doc: ColumnOrName, path: str | list[str], element: str = "string") -> Column:
    """Array at a JSON path as ``array<element>``; JSON null elements stay NULL.

    A missing path, JSON null or a non-array value gives NULL, so an explode
    over it yields no rows.
    """
    return F.try_variant_get(_col(doc), _json_path(path), f"array<{element}>")


def to_decimal(c: ColumnOrName, precision: int, scale: int) -> Column:
    """Exact cast to DECIMAL(p, s): half-up rounding, overflow raises (ANSI)."""
    return _col(c).cast(DecimalType(precision, scale))


# Fixed value: the shape of an ISO-8601 instant, a date with or without a time of day, and an offset.
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_iso_instant(c: ColumnOrName) -> Column:
    """ISO-8601 text to an instant (micros kept, further digits cut); other text gives NULL.

    A cast alone also takes times without a date, which it puts on the current
    day, and years; the shape is checked first. Text without an offset is UTC.
    """
    text = _col(c)
    spelled = F.regexp_replace(F.regexp_replace(text, ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2")
    # The cast wants seconds before an offset.
    spelled = F.regexp_replace(spelled, r"([T ]\d{2}:\d{2})(Z|[+-]|$)", "$1:00$2")
    return F.when(text.rlike(ISO_INSTANT), spelled.try_cast("timestamp"))


def order_key(ts: ColumnOrName, ident: ColumnOrName) -> Column:
    """A DECIMAL(38,0) that sorts exactly like ``(ts, ident)`` (NULL if either is NULL).

    ``(unix_micros(ts) + 1e17) * 1e20 + (ident + 2^63)``: timestamps of years
    1..9999 and any BIGINT id fit without overlap. ``max_by(x, key)`` over it
    keeps a fixed-width aggregation buffer, so the aggregate runs as a hash
    aggregate with a map-side partial step instead of a sort-based one.
    """
    micros = F.unix_micros(_col(ts).cast("timestamp")).cast("decimal(38,0)")
    big = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    ident_c = _col(ident).cast("decimal(38,0)") + big(2**63)
    return ((micros + big(10**17)) * big(10**20) + ident_c).cast("decimal(38,0)")


def iso_utc_z(ts: ColumnOrName) -> Column:
    """UTC ISO-8601 text ending in ``Z``; the fraction appears only when non-zero."""
    t = _col(ts)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), F.lit(None)).otherwise(
        F.concat(base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")), F.lit("Z"))
    )


def iso_utc_offset(ts: ColumnOrName) -> Column:
    """UTC ISO-8601 text ending in ``+00:00`` (fraction only when non-zero)."""
    return F.regexp_replace(iso_utc_z(ts), "Z$", "+00:00")


def run_id(ts: ColumnOrName) -> Column:
    """Run identifier at one-second resolution: ``YYYYMMDDTHHMMSSZ`` (UTC)."""
    return F.date_format(_col(ts), "yyyyMMdd'T'HHmmss'Z'")


def slug(c: ColumnOrName) -> Column:
    """File-safe name: trim, lower case, spaces to underscores."""
    trimmed = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    return F.replace(F.lower(trimmed), F.lit(" "), F.lit("_"))


def lookup_key(c: ColumnOrName) -> Column:
    """Normalised dimension key: trim and lower case."""
    return F.lower(F.regexp_replace(_col(c), r"^\s+|\s+$", ""))
