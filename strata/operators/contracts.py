"""Table contracts reported as violation DataFrames (parquet enforces none of them).

Each function returns the violating rows/groups; ``enforce`` turns a contract
into a lazy job failure instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def not_null_violations(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """One row per (row, column) holding a NULL in a NOT NULL column: ``keys..., column``."""
    nulls = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]),
        lambda x: x.isNotNull(),
    )
    flagged = df.select(*keys, nulls.alias("__cols")).where(F.size("__cols") > 0)
    return flagged.select(*keys, F.explode("__cols").alias("column"))


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n`` (partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def fk_violations(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (NULL keys are not checked)."""
    parent_keys = parent_keys or child_keys
    p = parent.select(*[F.col(pk).alias(ck) for ck, pk in zip(child_keys, parent_keys)]).distinct()
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys])
    return child.where(present).join(p, on=child_keys, how="left_anti")


@dataclass(frozen=True)
class ForeignKey:
    """``child.key`` refers to ``parent.parent_key``, among the parent rows of ``where`` if given."""

    name: str
    child: DataFrame
    key: str
    parent: DataFrame
    parent_key: str | None = None
    where: Column | None = None


def fk_violation_counts(contracts: list[ForeignKey]) -> DataFrame:
    """``(contract, violations)``: child rows whose non-NULL key has no parent, for all contracts at once.

    A child is scanned once for all its keys, a parent once for all its
    contracts. Child keys are stacked as (column, key) and counted first, so a
    key repeated millions of times crosses the shuffle as one row per map task;
    parent keys are stacked alike with a bit for each contract that they satisfy. One
    join then meets a key with its bits. Keys of one type are stacked together.
    """
    by_type: dict[DataType, list[ForeignKey]] = {}
    for c in contracts:
        by_type.setdefault(c.child.schema[c.key].dataType, []).append(c)
    return reduce(DataFrame.unionByName, [_counts_of_type(kind, group) for kind, group in by_type.items()])


def _stacked(frames: dict[int, tuple[DataFrame, dict[tuple, Column]]]) -> DataFrame:
    """One scan of each frame: a row for each of its keyed structs that holds a key."""
    parts = [df.select(F.inline(F.array(*structs.values()))).where("key IS NOT NULL") for df, structs in frames.values()]
    return reduce(DataFrame.unionByName, parts)


def _counts_of_type(kind: DataType, contracts: list[ForeignKey]) -> DataFrame:
    slots = {s: i for i, s in enumerate(dict.fromkeys((id(c.child), c.key) for c in contracts))}
    if len(contracts) > 62:
        raise ValueError("at most 62 foreign keys of one type at once")
    children: dict[int, tuple[DataFrame, dict[tuple, Column]]] = {}
    parents: dict[int, tuple[DataFrame, dict[tuple, Column]]] = {}
    for (child, key), slot in slots.items():
        frame = next(c.child for c in contracts if id(c.child) == child)
        one = F.struct(F.lit(slot).alias("slot"), F.col(key).alias("key"))
        children.setdefault(child, (frame, {}))[1][slot] = one
    for bit, c in enumerate(contracts):
        structs = parents.setdefault(id(c.parent), (c.parent, {}))[1]
        at = (slots[id(c.child), c.key], c.parent_key or c.key)
        flag = F.lit(1 << bit) if c.where is None else F.when(c.where, F.lit(1 << bit)).otherwise(F.lit(0))
        # Contracts of one child column and one parent column share their rows.
        structs[at] = [*structs.get(at, []), flag.cast("bigint")]
    for frame, structs in parents.values():
        for (slot, key), flags in structs.items():
            structs[slot, key] = F.struct(F.lit(slot).alias("slot"), F.col(key).cast(kind).alias("key"), reduce(Column.bitwiseOR, flags).alias("bits"))
    counted = _stacked(children).groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n"))
    known = _stacked(parents).groupBy("slot", "key").agg(F.bit_or("bits").alias("bits"))
    met = counted.join(known, ["slot", "key"], "left")
    lacks = lambda bit: F.coalesce(F.col("bits"), F.lit(0)).bitwiseAND(F.lit(1 << bit)) == 0
    broken = [
        F.coalesce(F.sum(F.when((F.col("slot") == slots[id(c.child), c.key]) & lacks(bit), F.col("n"))), F.lit(0)).cast("bigint").alias(f"c{bit}")
        for bit, c in enumerate(contracts)
    ]
    rows = F.array(*[F.struct(F.lit(c.name).alias("contract"), F.col(f"c{bit}").alias("violations")) for bit, c in enumerate(contracts)])
    return met.agg(*broken).select(F.inline(rows))


def apply_schema(df: DataFrame, schema: StructType, keys: list[str], on_error: str = "reject") -> tuple[DataFrame, DataFrame]:
    """Cast columns to the declared schema; returns ``(typed, rejects)``.

    A value that is present but does not fit its declared type (overflowing
    decimal precision, unparseable text) is a violation. ``on_error="raise"``
    fails the job at the first one; ``"reject"`` returns one reject row per
    (row, column) with the original value as text and keeps such rows out of
    ``typed``.
    """
    if on_error not in ("raise", "reject"):
        raise ValueError("on_error must be 'raise' or 'reject'")
    if on_error == "raise":
        return df.select(*keys, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in keys]), None
    fields = [f for f in schema.fields if f.name not in keys]
    tried = df.select(
        *keys,
        *[F.col(f.name).alias(f"__src_{f.name}") for f in fields],
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields],
    )
    # The original value is rendered as text only for the failing cells.
    bad = F.filter(
        F.array(*[
            F.when(
                F.col(f"__src_{f.name}").isNotNull() & F.col(f.name).isNull(),
                F.struct(F.lit(f.name).alias("column"), F.col(f"__src_{f.name}").cast("string").alias("value")),
            )
            for f in fields
        ]),
        lambda x: x.isNotNull(),
    )
    flagged = tried.withColumn("__bad", bad)
    typed = flagged.where(F.size("__bad") == 0).select(*keys, *[f.name for f in fields])
    rejects = flagged.where(F.size("__bad") > 0).select(*keys, F.explode("__bad").alias("__b")).select(
        *keys, F.col("__b.column").alias("column"), F.col("__b.value").alias("value")
    )
    return typed, rejects


def enforce_not_null(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """Same rows, but the job fails on the first NULL in ``cols`` (checked lazily in the scan)."""
    out = df
    for c in cols:
        out = out.withColumn(
            c,
            F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NOT NULL violated: {table}.{c}"))).otherwise(F.col(c)),
        )
    return out
