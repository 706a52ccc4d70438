"""A change feed between two states of a table: what was inserted, updated and deleted, with the rows before and after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row. Which values are NULL is part of it, as the hash by itself passes them over."""
    holes = F.concat(F.lit(""), *(F.col(c).isNull().cast("int").cast("string") for c in columns))
    return F.xxhash64(F.lit(seed), holes, *columns)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, op, before, after`` of every key whose row is not the same in both states; each has one row per key at most.

    Both states meet in one full outer join by key. Rows that are equal are told by 128 bits of digest and leave the plan right
    behind the join. A NULL is a key like any other.
    """
    values = [c for c in old.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        digest = F.struct(row_digest(values, 1), row_digest(values, 2))
        return df.select(*(F.col(c).alias(f"{name}_{c}") for c in keys), digest.alias(f"{name}_digest"), F.struct(*values).alias(name))

    same_key = F.lit(True)
    for c in keys:
        same_key = same_key & F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    met = side(old, "before").join(side(new.select(*old.columns), "after"), same_key, "full_outer")
    changed = met.filter(~F.col("before_digest").eqNullSafe(F.col("after_digest")))
    was, is_ = F.col("before_digest").isNotNull(), F.col("after_digest").isNotNull()
    op = F.when(~was, INSERT).when(~is_, DELETE).otherwise(UPDATE)
    key = [F.when(is_, F.col(f"after_{c}")).otherwise(F.col(f"before_{c}")).alias(c) for c in keys]
    return changed.select(*key, op.alias("op"), "before", "after")


def apply_feed(state: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the feed: rows of other keys as they are, and the ``after`` rows of inserts and updates."""
    values = [c for c in state.columns if c not in keys]
    other = feed.select(*(F.col(c).alias(f"_{c}") for c in keys))
    same_key = F.lit(True)
    for c in keys:
        same_key = same_key & F.col(c).eqNullSafe(F.col(f"_{c}"))
    kept = state.join(other, same_key, "left_anti")
    put = feed.filter(F.col("op") != DELETE).select(*keys, *(F.col("after").getField(c).alias(c) for c in values))
    return kept.unionByName(put.select(*state.columns))
