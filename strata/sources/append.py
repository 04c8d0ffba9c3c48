"""Idempotent append (insert, skip rows whose key already exists)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import latest_per_key


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first under ``order`` (sort expressions; deterministic when total).

    ``row_number() = 1`` per key: Catalyst adds a partial ``WindowGroupLimit``
    before the shuffle, so a key repeated many times is cut to one row per map
    task before it is moved.
    """
    return latest_per_key(df, keys, order)


def append_if_absent(
    new: DataFrame,
    existing: DataFrame,
    keys: list[str],
    order: list[Column],
    prune_on: list[str] | None = None,
) -> DataFrame:
    """Rows of ``new`` to insert: one per key, and only keys absent from ``existing``.

    Of rows that share a key the first under ``order`` is taken; the caller
    names an order that tells any two different rows apart.

    ``prune_on`` names partition columns shared by both sides (e.g. year, month,
    day of the landing path): ``existing`` is first semi-joined with the
    partitions present in ``new``, so dynamic partition pruning reads only those
    partitions of a large history instead of all of it.
    """
    incoming = dedupe_first(new, keys, order)
    have = existing.select(*keys, *(prune_on or []))
    if prune_on:
        touched = new.select(*prune_on).distinct()
        have = have.join(touched, on=prune_on, how="left_semi")
    return incoming.join(have.select(*keys), on=keys, how="left_anti")


def append_counts(new: DataFrame, existing: DataFrame, keys: list[str], prune_on: list[str] | None = None) -> DataFrame:
    """One row ``inserted, skipped, total`` for appending ``new`` onto ``existing``.

    ``total`` counts incoming rows; a key repeated inside ``new`` or already in
    ``existing`` is skipped. ``prune_on`` restricts ``existing`` to the
    partitions ``new`` touches, as in ``append_if_absent``.
    """
    have = existing
    if prune_on:
        have = existing.join(new.select(*prune_on).distinct(), on=prune_on, how="left_semi")
    hits = have.select(*keys).distinct().withColumn("__have", F.lit(True))
    per_key = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    joined = per_key.join(hits, on=keys, how="left")
    return joined.agg(
        F.sum(F.when(F.col("__have").isNull(), 1).otherwise(0)).cast("bigint").alias("inserted"),
        (F.sum("__n") - F.sum(F.when(F.col("__have").isNull(), 1).otherwise(0))).cast("bigint").alias("skipped"),
        F.sum("__n").cast("bigint").alias("total"),
    ).select(
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )
