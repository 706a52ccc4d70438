"""Latest rows, latest values, repeated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str | Column, unordered: bool = False
) -> DataFrame:
    """One row per key, the one with the largest ``order``; rows without an order are ignored, or,
    if ``unordered``, come before all others.

    A single aggregation that keeps one row per key and map task before the shuffle. Equal
    orders are decided by the remaining columns, so the result never depends on row order.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = df.withColumn("_order", _column(order))
    if not unordered:
        ordered = ordered.filter(F.col("_order").isNotNull())
    winner = ordered.groupBy(*keys).agg(F.max(F.struct("_order", *rest)).alias("_row"))
    return winner.select(*(c if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns))


def latest_keep_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that share their key's largest ``order``; rows without an order are ignored.

    The maximum is aggregated map-side and joined back instead of ranked in a window, so a key
    with very many rows, or very many ties, is never gathered in one task: AQE splits the
    row side of the join.
    """
    top = df.filter(F.col(order).isNotNull()).groupBy(*keys).agg(F.max(order).alias(order))
    return df.join(top, [*keys, order], "left_semi")


def row_number_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Spark limits each key to ``n`` rows per map task before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(*keys).orderBy(*(_column(c) for c in order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def last_non_null(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Per key the latest non-NULL value of each column, in one aggregation."""
    picks = [
        F.max(F.when(F.col(c).isNotNull() & F.col(order).isNotNull(), F.struct(order, c)))
        .getField(c)
        .alias(c)
        for c in columns
    ]
    return df.groupBy(*keys).agg(*picks)


def expected_state(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], day: Column
) -> DataFrame:
    """The latest row per key among the rows of ``day``, with last-non-NULL history columns."""
    of_day = df.filter(F.to_date(order) == day).drop(*columns)
    latest = latest_per_key(of_day, keys, order)
    return latest.join(last_non_null(df, keys, order, columns), list(keys), "left")


def top_one(df: DataFrame, order: str, columns: Mapping[str, Column]) -> DataFrame:
    """Values from the one row with the largest ``order``, as a one-row frame."""
    return df.agg(*(F.max_by(c, F.col(order)).alias(name) for name, c in columns.items()))


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_by_id(df: DataFrame, ids: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per id: the first by ``order``, or any one of them without an order.

    On a stream, the repeats are dropped within the watermark so that the state is bounded.
    """
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(list(ids))
    if not order:
        return df.dropDuplicates(list(ids))
    rest = [c for c in df.columns if c not in (*ids, *order)]
    first = df.groupBy(*ids).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return first.select(*(c if c in ids else F.col("_row").getField(c).alias(c) for c in df.columns))


def ordered_string_agg(
    df: DataFrame, keys: Sequence[str], line: str, text: str, delimiter: str = "^", block: int = 1024
) -> DataFrame:
    """Per key the non-NULL texts in ``line`` order, joined by ``delimiter``.

    Lines are joined in blocks of ``block`` line numbers first and the blocks afterwards, so a
    long key's rows are spread over many tasks and the last step handles joined strings only.
    """

    def joined(order: str, value: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(order, value)))
        return F.array_join(F.transform(parts, lambda p: p.getField(value)), delimiter)

    present = df.filter(F.col(text).isNotNull())
    blocks = present.groupBy(*keys, F.floor(F.col(line) / block).alias("_block")).agg(
        joined(line, text).alias(text)
    )
    return blocks.groupBy(*keys).agg(joined("_block", text).alias(text))
