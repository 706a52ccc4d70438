"""Finding the few keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that one task takes; a key with more is cut into pieces of about this size.
PIECE_ROWS = 1_000_000
# A key is cut into at most so many pieces.
MAX_PIECES = 1000
# A table is cut into at most so many; the planner gives rows of unknown size the largest long.
MAX_TASKS, UNKNOWN_BYTES = 10_000, 2**62


def pieces_of(df: DataFrame, size: int) -> int:
    """How many pieces of ``size`` the stored bytes make that rows are read from; those of unknown size do not count. Reads no data."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(MAX_TASKS, -(-sum(n for n in sizes if n < UNKNOWN_BYTES) // size))


def hot_ranges(df: DataFrame, keys: Sequence[str], axis: str, rows: int = PIECE_ROWS) -> DataFrame:
    """Per hot key the values of ``axis`` at which to cut it: ``keys, _cuts``.

    The cuts are quantiles, so the pieces have equal numbers of rows however these are spread along
    the axis. A value that fills several pieces by itself is there as often (see ``share_of``). There are fewer than
    (all rows) / ``rows`` hot keys. The first pass reads the keys only and aggregates before it shuffles; the second
    sees only rows of hot keys.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows)
    steps = F.array(*(F.lit(i / MAX_PIECES) for i in range(1, MAX_PIECES)))
    hot = df.join(counts, list(keys)).groupBy(*keys).agg(
        F.first("_rows").alias("_rows"), F.percentile_approx(axis, steps, 20 * MAX_PIECES).alias("_at")
    )
    wanted = F.least(F.ceil(F.col("_rows") / rows).cast("int"), F.lit(MAX_PIECES))
    places = F.transform(F.sequence(F.lit(1), wanted - 1), lambda i: F.get("_at", F.floor(i * MAX_PIECES / wanted).cast("int") - 1))
    return hot.select(*keys, places.alias("_cuts"))


def as_number(df: DataFrame, column: str) -> Column:
    """A time or number as a double that grows with it."""
    if isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("timestamp").cast("double")
    return F.col(column).cast("double")


def piece_of(axis: Column) -> Column:
    """Which piece of its key a row falls into; 0 for keys that are not hot."""
    return F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < axis)), F.lit(0))


def share_of(axis: Column, row: Column) -> Column:
    """The second cut, across rows of one value: a share from 1 up for rows of a value that fills pieces by itself, else 0.

    Rows are dealt by a hash of ``row``, so a repeated task deals them as the first did; equal rows stay together.
    """
    marks = F.size(F.filter("_cuts", lambda cut: cut == axis))
    return F.when(marks > 1, F.pmod(F.xxhash64(row), marks + 1) + 1).otherwise(0).cast("int")


def shares(axis: Column) -> Column:
    """All shares that ``share_of`` may give at this value."""
    marks = F.size(F.filter("_cuts", lambda cut: cut == axis))
    return F.when(marks > 1, F.sequence(F.lit(1), marks + 1)).otherwise(F.array(F.lit(0)))
