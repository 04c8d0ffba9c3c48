"""Windows over hot groups: a group's rows are split into ranges of the order, and ranges meet by what they pass on.

A window function puts all rows of a group into one task. Here ``RANGES - 1``
borders cut the order of (group, order columns) into ranges of about equal
size, and a window holds one range of one group:

* ``prefix_sums`` adds to the sum inside the range the total of the group's
  ranges before it. ``ranged_positions`` is its sum of ones.
* ``ranged_rolling`` copies the last rows before each border over it.

The borders are the keys of the rows of least hash, found by a top-k over all
rows, so they are a function of the data alone: every branch of a plan, and
every task that is run again, cuts alike, whatever the types of the columns.
They decide cost only. A border lies inside one group, so at most ``RANGES - 1``
groups are split. Their borders are broadcast, and so are the totals of their
ranges; the rows of all other groups, which are one range each, meet neither a
search nor a second shuffle.

Cases: nulls of a group column are one group; nulls of an order column stand
last in ascending order unless asked first; rows equal in all order columns
fall into one range, in any order, as in a plain window; rows that are equal
in every column have one hash, so many copies of one row can waste borders; an
empty table has no borders and one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A power of two. The borders are one row of an array that goes to all tasks.
RANGES = 1024


def _ordered(cols: list[str], descending: bool, nulls_first: bool | None) -> tuple[list[Column], list[Column]]:
    """Fields whose ascending order is that of the columns (or its reverse if descending), and sort expressions."""
    nulls_first = descending if nulls_first is None else nulls_first
    fields, sort = [], []
    for k, c in enumerate(cols):
        flag = F.col(c).isNull() if descending == nulls_first else F.col(c).isNotNull()
        fields += [flag.alias(f"f{k}"), F.col(c).alias(f"c{k}")]
        if descending:
            sort.append(F.col(c).desc_nulls_first() if nulls_first else F.col(c).desc_nulls_last())
        else:
            sort.append(F.col(c).asc_nulls_first() if nulls_first else F.col(c).asc_nulls_last())
    return fields, sort


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return _hashable(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))


def _cut(
    df: DataFrame, by: list[str], order: list[str], out: str, descending: bool, nulls_first: bool | None, ranges: int | None
) -> DataFrame:
    """``with_range``, and in ``__split`` whether the row's group has borders."""
    ranges = ranges or RANGES
    fields, _ = _ordered(order, descending, nulls_first)
    groups = [f"__g{k}" for k in range(len(by))]
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)])
    least = df.select(*[F.col(c).alias(g) for c, g in zip(by, groups)], F.struct(*fields).alias("__key"), row.alias("__hash"))
    least = least.orderBy("__hash", *groups, "__key").limit(ranges - 1)
    borders = least.groupBy(*groups).agg(F.array_sort(F.collect_set("__key")).alias("__borders"))
    met = df.join(F.broadcast(borders), on=[F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, groups)], how="left")
    steps = [ranges >> k for k in range(1, ranges.bit_length())]
    # Binary search: how many borders are not above the key. Past the last border the comparison is null.
    found = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(F.get(F.col("__borders"), at + step - 1) <= F.struct(*fields), at + step).otherwise(at)
    )
    split = F.col("__borders").isNotNull()
    return met.select(*[F.col(f"`{c}`") for c in df.columns], F.when(split, found).otherwise(0).alias(out), split.alias("__split"))


def with_range(
    df: DataFrame, by: list[str], order: list[str], out: str, descending: bool = False, nulls_first: bool | None = None, ranges: int | None = None
) -> DataFrame:
    """``df`` with the number of the range of its group that its order falls into, ascending with the order
    (descending with a descending one)."""
    return _cut(df, by, order, out, descending, nulls_first, ranges).drop("__split")


def prefix_sums(
    df: DataFrame,
    by: list[str],
    order: list[str],
    weight: Column,
    out: str,
    descending: bool = False,
    nulls_first: bool | None = None,
    ranges: int | None = None,
    total: str | None = None,
    piece: str | None = None,
) -> DataFrame:
    """The sum of the whole number ``weight`` over the rows of the group that stand before each row.

    ``total`` names a column for the sum over the whole group, ``piece`` one for the row's range: the
    rows come out dealt by (group, range), so work on parts of a range needs no further shuffle.
    """
    _, sort = _ordered(order, descending, nulls_first)
    cut = _cut(df, by, order, "__range", descending, nulls_first, ranges).withColumn("__weight", weight.cast("bigint"))
    inside = Window.partitionBy(*by, "__range").orderBy(*sort)
    sums = [F.coalesce(F.sum("__weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__inside")]
    if total:
        sums.append(F.sum("__weight").over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__whole"))
    rows = cut.drop("__split").select("*", *sums)
    place = F.col("__range").desc() if descending else F.col("__range").asc()
    ranges_of = Window.partitionBy(*by).orderBy(place)
    names = [f"__by{k}" for k in range(len(by))]
    totals = cut.where("__split").groupBy(*by, "__range").agg(F.sum("__weight").alias("__total"))
    passed = totals.select(
        *[F.col(c).alias(n) for c, n in zip(by, names)], F.col("__range").alias("__at"),
        F.sum("__total").over(ranges_of.rowsBetween(Window.unboundedPreceding, -1)).alias("__passed"),
        F.sum("__total").over(ranges_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__all"),
    )
    on = [F.col("__range") == F.col("__at"), *[F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)]]
    both = rows.join(F.broadcast(passed), on=on, how="left")
    more = [F.coalesce("__all", "__whole").alias(total)] if total else []
    more += [F.col("__range").alias(piece)] if piece else []
    return both.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__inside") + F.coalesce("__passed", F.lit(0))).alias(out), *more)


def ranged_positions(
    df: DataFrame, by: list[str], order: list[str], out: str, ranges: int | None = None, size: str | None = None, piece: str | None = None
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY by ORDER BY order)`` (ascending) as BIGINT, no task holding a whole group.

    ``size`` names a column for the number of rows in the group; ``piece`` as in ``prefix_sums``.
    """
    return prefix_sums(df, by, order, F.lit(1), out, ranges=ranges, total=size, piece=piece).withColumn(out, F.col(out) + 1)


def ranged_rolling(
    df: DataFrame, by: list[str], order: list[str], aggs: dict[str, Column], preceding: int = 2, ranges: int | None = None
) -> DataFrame:
    """``windows.rolling_rows`` (ascending) with no task holding a whole group: a range's window also
    holds the ``preceding`` rows before its border."""
    _, sort = _ordered(order, False, None)
    cut = with_range(df, by, order, "__range", ranges=ranges)
    # The last rows of every range; a border's copies come from the nearest ranges that have some.
    last = Window.partitionBy(*by, "__range").orderBy(*[F.col(c).desc_nulls_first() for c in order])
    tails = cut.withColumn("__back", F.row_number().over(last)).where(F.col("__back") <= preceding)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ahead = Window.partitionBy(*by).orderBy("__range", F.col("__back").desc())
    tails = tails.select(
        "__range", F.lag("__range").over(ahead).alias("__before"), F.collect_list(row).over(ahead.rowsBetween(-preceding, -1)).alias("__rows"))
    # Of each border that lies inside a group: the first tail row behind it sees the rows to copy.
    copies = tails.where("__before is not null and __before != __range").select("__range", F.explode("__rows").alias("__row"))
    copies = copies.select("__row.*", "__range", F.lit(True).alias("__copy"))
    frame = Window.partitionBy(*by, "__range").orderBy(*sort).rowsBetween(-preceding, 0)
    both = cut.withColumn("__copy", F.lit(False)).unionByName(copies)
    rolled = both.select("*", *[agg.over(frame).alias(name) for name, agg in aggs.items()])
    return rolled.where("not __copy").select(*[F.col(f"`{c}`") for c in df.columns], *aggs)
