"""Window-shaped operators: latest row per key, latest snapshot, rank, rolling.

Each is written so the shuffle it needs is bounded per task even when one key
holds a large share of the rows:

* ``latest_per_key`` is ``row_number() = 1``; Catalyst plans it with a partial
  ``WindowGroupLimit`` before the exchange, so each map task ships at most one
  row per key (a map-side combine).
* ``latest_snapshot`` finds each key's newest snapshot with a partial
  aggregate and an equi-join (AQE splits a skewed join partition) instead of a
  window over the whole key.
* ``rank_within`` never sorts the rows of a ranking partition: a rank is the
  sum of the counts ahead on each sort column, taken from histograms that
  partial aggregates build, so only distinct values meet in a window, and of a
  type with many values only those of one range (``ranges.prefix_sums``).
* ``row_positions`` is ``ROW_NUMBER()`` by ranges of the order.
* ``rolling_rows`` is a physical-rows frame over (key, date) rows; with one row
  per key and date a partition is bounded by the calendar, not by the data.
  ``ranges.ranged_rolling`` does the same for keys without such a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ranges import prefix_sums, ranged_positions


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sort_spec(c: str | Column, descending: bool = False, nulls_first: bool | None = None) -> Column:
    """Sort expression with explicit NULL placement.

    ``nulls_first=None`` follows the SQL-standard default the source tables were
    written for: NULLs sort as the largest value (first when descending).
    """
    col = F.col(c) if isinstance(c, str) else c
    if nulls_first is None:
        nulls_first = descending
    if descending:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def _few_values(t: T.DataType) -> bool:
    """Types with so few values that all of them fit a window."""
    return isinstance(t, (T.BooleanType, T.ByteType, T.ShortType, T.DateType)) or (isinstance(t, T.DecimalType) and t.precision <= 6)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (ROW_NUMBER() = 1)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_snapshot(
    df: DataFrame,
    keys: list[str],
    snapshot: str,
    dedupe_by: list[str] | None = None,
    order: list[Column] | None = None,
) -> DataFrame:
    """Rows of each key's newest snapshot, optionally one row per ``keys + dedupe_by``.

    ``MAX(snapshot) GROUP BY keys`` joined back on (keys, snapshot); rows whose
    snapshot is NULL never match. Within the snapshot, ties on
    ``keys + dedupe_by`` keep the first row under ``order``.
    """
    newest = df.groupBy(*keys).agg(F.max(snapshot).alias(snapshot))
    rows = df.join(newest, on=[*keys, snapshot], how="inner")
    if dedupe_by:
        rows = latest_per_key(rows, [*keys, *dedupe_by], order or [])
    return rows.select(*df.columns)


def rank_within(
    df: DataFrame,
    by: list[str],
    value: str,
    tiebreak: list[str],
    out: str,
    descending: bool = True,
    nulls_first: bool | None = None,
) -> DataFrame:
    """``RANK() OVER (PARTITION BY by ORDER BY value, *tiebreak ASC)`` as BIGINT.

    rank = 1 + (rows of the partition ahead on ``value``)
             + (rows tied on ``value`` and ahead on the first tiebreak) + ...
    Each term comes from one histogram: the counts of the distinct values of a
    column under equal values of the columns before it, built with a partial
    aggregate. So what meets in one window is the distinct values of one column
    (a DECIMAL(6,2) has at most two million), never the rows; of a type with more
    values it is those of one range. Rows only join their terms, and a skewed
    join partition is split by AQE.
    """
    columns = [*by, value, *tiebreak]
    key = [f"__k{i}" for i in range(len(columns))]
    counts = df.groupBy(*[F.col(c).alias(k) for c, k in zip(columns, key)]).agg(F.count(F.lit(1)).alias("__n"))
    terms = None
    for end in range(len(by) + 1, len(columns) + 1):
        upper, last = key[: end - 1], key[end - 1]
        spec = sort_spec(last, descending, nulls_first) if end == len(by) + 1 else sort_spec(last)
        ahead = Window.partitionBy(*_cols(upper)).orderBy(spec).rowsBetween(Window.unboundedPreceding, -1)
        level = counts.groupBy(*key[:end]).agg(F.sum("__n").alias("__n"))
        if _few_values(level.schema[last].dataType):
            level = level.select(*key[:end], F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
        else:
            of_value = end == len(by) + 1
            level = prefix_sums(level, upper, [last], F.col("__n"), "__ahead", of_value and descending, nulls_first if of_value else None)
            level = level.select(*key[:end], "__ahead")
        if terms is not None:
            before = terms.select(*[F.col(k).alias(f"{k}b") for k in upper], F.col("__ahead").alias("__before"))
            level = level.join(before, on=[F.col(k).eqNullSafe(F.col(f"{k}b")) for k in upper])
            level = level.select(*key[:end], (F.col("__ahead") + F.col("__before")).alias("__ahead"))
        terms = level
    ranked = df.join(terms, on=[F.col(c).eqNullSafe(F.col(k)) for c, k in zip(columns, key)])
    return ranked.select(*df.columns, (F.col("__ahead") + 1).cast("bigint").alias(out))


def row_positions(df: DataFrame, by: list[str], order: list[str], out: str, size: str | None = None, piece: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY by ORDER BY order)`` (ascending) as BIGINT; ``size`` and ``piece`` as in ``ranged_positions``."""
    return ranged_positions(df, by, order, out, size=size, piece=piece)


def rolling_rows(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    aggs: dict[str, Column],
    preceding: int = 2,
) -> DataFrame:
    """Add frame aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``.

    ``aggs`` maps output names to aggregate expressions (``F.avg("x")``); all of
    them share one window node. The frame counts rows, not days: a missing
    date is not filled, and the first rows of a key use shorter frames.
    """
    w = Window.partitionBy(*_cols(by)).orderBy(*order).rowsBetween(-preceding, 0)
    return df.select("*", *[agg.over(w).alias(name) for name, agg in aggs.items()])
