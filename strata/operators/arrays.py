"""Position-aligned explode of parallel arrays (lateral unnest on ordinality)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_aligned(
    df: DataFrame,
    arrays: dict[str, Column],
    keep: list[str] | None = None,
    position: str | None = None,
    first_of: Column | None = None,
) -> DataFrame:
    """One row per array position, arrays aligned by index.

    Rows are cut at the shortest array (a ragged document loses its tail), and
    a document with any array missing or NULL contributes no rows. JSON null
    elements become NULL values. ``position`` (1-based) is added when named.

    ``first_of`` is an array expression aligned with the others (for example
    the cast dates of a forecast): inside each document only the first position
    of every distinct non-NULL value is kept, so duplicates are removed without
    a shuffle.

    This is a narrow per-row transform: no shuffle, no join on the position.
    """
    keep = list(keep or [])
    names = list(arrays)
    tmp = {n: f"__arr_{i}" for i, n in enumerate(names)}
    extra = [first_of.alias("__key_arr")] if first_of is not None else []
    staged = df.select(*keep, *[arrays[n].alias(tmp[n]) for n in names], *extra)
    sizes = [F.size(F.col(tmp[n])) for n in names]
    shortest = reduce(F.least, sizes) if len(sizes) > 1 else sizes[0]
    zipped = F.transform(
        F.col(tmp[names[0]]),
        lambda x, i: F.struct(
            (i + 1).alias("__pos"),
            *[(x if k == 0 else F.get(F.col(tmp[n]), i)).alias(n) for k, n in enumerate(names)],
        ),
    )
    rows = F.slice(zipped, 1, F.greatest(shortest, F.lit(0)))
    if first_of is not None:
        # Sorted (value, position) pairs put the first position of each value
        # right behind another value, so one pass over the sorted pairs finds it.
        pairs = F.sort_array(F.transform(F.col("__key_arr"), lambda k, i: F.struct(k.alias("k"), (i + 1).alias("i"))))
        staged = staged.withColumn("__pairs", pairs)
        first = F.filter(
            F.col("__pairs"),
            lambda p, i: p["k"].isNull() | (i == 0) | ~p["k"].eqNullSafe(F.get(F.col("__pairs"), i - 1)["k"]),
        )
        staged = staged.withColumn("__rows", rows)
        kept = F.filter(F.sort_array(F.transform(first, lambda p: p["i"])), lambda i: i <= F.size("__rows"))
        rows = F.transform(kept, lambda i: F.element_at(F.col("__rows"), i))
    all_present = reduce(lambda a, b: a & b, [F.col(tmp[n]).isNotNull() for n in names])
    out = staged.select(*keep, F.explode(F.when(all_present, rows)).alias("__row"))
    cols = [F.col(k) for k in keep]
    if position:
        cols.append(F.col("__row.__pos").alias(position))
    cols += [F.col(f"__row.{n}").alias(n) for n in names]
    return out.select(*cols)
