"""Batch metrics, freshness and reconciliation."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.operators.feed import row_digest

# Fixed value: minutes of delay that are still in order.
FRESHNESS_MINUTES = 5

# The delays of the report, as name -> (earlier, later).
LAGS = {
    "diff_row_msg": ("msg_tm", "row_updt_tsp"),
    "diff_tms_row": ("row_updt_tsp", "tmstmp"),
    "diff_tms_msg": ("msg_tm", "tmstmp"),
    "diff_row_met": ("msg_enqueued_tsp", "row_updt_tsp"),
    "diff_tms_met": ("msg_enqueued_tsp", "tmstmp"),
}


def metric_columns(message_time: str = "msg_tm", inserted: str = "row_insert_tsp") -> list[Column]:
    """Row count, latest message, and insert time of the earliest and the latest message."""
    return [
        F.count(F.lit(1)).alias("batch_rows"),
        F.max(message_time).alias("latest_msg_tm"),
        F.min_by(inserted, message_time).alias("first_insert_tsp"),
        F.max_by(inserted, message_time).alias("last_insert_tsp"),
    ]


def batch_metrics(
    df: DataFrame, batch: Sequence[str], message_time: str = "msg_tm", inserted: str = "row_insert_tsp"
) -> DataFrame:
    return df.groupBy(*batch).agg(*metric_columns(message_time, inserted))


def _instants(now: datetime.datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now)


def freshness(
    df: DataFrame,
    platform: str,
    table: str,
    now: datetime.datetime | None = None,
    minutes: int = FRESHNESS_MINUTES,
    boundaries: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """One row if any delay of the table exceeds ``minutes``, none otherwise.

    ``zone`` names the wall clock that the table's times were shifted to; the present is then taken on
    that clock too. Delays count whole units; with ``boundaries`` they count the unit boundaries crossed, as
    some warehouses do. The scan reads three columns and aggregates to one row.
    """
    newest = df.agg(*(F.max(c).alias(c) for c in ("row_updt_tsp", "msg_tm", "msg_enqueued_tsp")))
    present = _instants(now) if zone is None else F.from_utc_timestamp(_instants(now), zone)
    newest = newest.withColumn("tmstmp", present.cast(df.schema["msg_tm"].dataType))

    def lag(unit: str, earlier: str, later: str) -> Column:
        start, end = F.col(earlier), F.col(later)
        if boundaries:
            start, end = F.date_trunc(unit, start), F.date_trunc(unit, end)
        return F.timestamp_diff(unit, start, end)

    late = reduce(
        lambda a, b: a | b, (lag("MINUTE", a, b) > minutes for a, b in LAGS.values())
    )
    return newest.filter(late).select(
        F.lit(platform).alias("platform"),
        F.lit(table).alias("table_name"),
        *(F.col(c).cast("string").alias(c) for c in ("row_updt_tsp", "msg_tm", "tmstmp", "msg_enqueued_tsp")),
        *(lag("SECOND", a, b).alias(name) for name, (a, b) in LAGS.items()),
    )


def freshness_report(
    tables: Mapping[tuple[str, str], DataFrame],
    now: datetime.datetime | None = None,
    minutes: int = FRESHNESS_MINUTES,
    boundary_platforms: Sequence[str] = (),
    zones: Mapping[str, str] | None = None,
) -> DataFrame:
    """Late tables of all platforms, sorted; at most one row per table. ``zones`` has the wall clock of
    each platform whose times are shifted."""
    rows = [
        freshness(df, platform, table, now, minutes, platform in boundary_platforms, (zones or {}).get(platform))
        for (platform, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("platform", "table_name")


def reconcile(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Compare two frames key by key.

    Returns ``keys, status, mismatched_cols`` with status ``match``, ``mismatch``,
    ``only_actual``, ``only_expected`` or, where a side has a key more than once,
    ``ambiguous``: pairing such rows with each other would say nothing. With
    ``null_safe=False`` a NULL agrees with any value.

    Both sides go through one aggregation, so repeated keys shrink before the shuffle.
    """
    columns = [c for c in expected.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("_side"), F.struct(*columns).alias("_row"))

    both = side(actual, "a").unionByName(side(expected, "e"))
    compared = both.groupBy(*keys).agg(
        *(F.count(F.when(F.col("_side") == s, 1)).alias(f"_n{s}") for s in "ae"),
        *(F.max(F.when(F.col("_side") == s, F.col("_row"))).alias(f"_{s}") for s in "ae"),
    )

    def differs(c: str) -> Column:
        a, e = F.col("_a").getField(c), F.col("_e").getField(c)
        return ~a.eqNullSafe(e) if null_safe else F.coalesce(a != e, F.lit(False))

    once = (F.col("_na") == 1) & (F.col("_ne") == 1)
    names = F.array_compact(F.array(*(F.when(once & differs(c), F.lit(c)) for c in columns)))
    status = (
        F.when(F.col("_ne") == 0, "only_actual")
        .when(F.col("_na") == 0, "only_expected")
        .when(~once, "ambiguous")
        .when(F.size("mismatched_cols") > 0, "mismatch")
        .otherwise("match")
    )
    return compared.withColumn("mismatched_cols", names).select(
        *keys, status.alias("status"), "mismatched_cols"
    )


# Ranges of hashed keys whose rows are compared by their digests before any row is.
DIGEST_RANGES = 1 << 16


def differing_ranges(actual: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str], ranges: int = DIGEST_RANGES) -> DataFrame:
    """Numbers of the key ranges (``_range``) in which the two frames do not hold the same rows.

    Of a range each side has the number of its rows and the sums of two digests of them; what is shuffled is one such row
    per range and task. The sums of 32-bit halves have room for two thousand million rows a range.
    """

    def side(df: DataFrame) -> DataFrame:
        digests = [row_digest([*keys, *columns], seed) for seed in (1, 2)]
        halves = [h for d in digests for h in (F.shiftrightunsigned(d, 32), d.bitwiseAND(F.lit(0xFFFFFFFF)))]
        sums = [F.sum(h).alias(f"_{i}") for i, h in enumerate(halves)]
        summed = df.groupBy(range_of(keys, ranges).alias("_range")).agg(F.count(F.lit(1)).alias("_n"), *sums)
        return summed.select("_range", F.struct("_n", *(f"_{i}" for i in range(len(halves)))).alias("_sums"))

    met = side(actual).join(side(expected).withColumnRenamed("_sums", "_other"), "_range", "full_outer")
    return met.filter(~F.col("_sums").eqNullSafe(F.col("_other"))).select("_range")


def range_of(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges))


def reconcile_by_digest(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], null_safe: bool = True, ranges: int = DIGEST_RANGES
) -> DataFrame:
    """What ``reconcile`` gives, comparing rows only where digests of key ranges differ.

    Rows of a range whose digests agree are the same on both sides, so its keys match, or are ambiguous if they occur more than
    once: only keys are shuffled. The ranges that differ are at most ``ranges`` numbers, which bounds the broadcast.
    """
    columns = [c for c in expected.columns if c not in keys]
    differ = F.broadcast(differing_ranges(actual, expected, keys, columns, ranges))

    def those(df: DataFrame, how: str) -> DataFrame:
        return df.select(*keys, *columns).withColumn("_range", range_of(keys, ranges)).join(differ, "_range", how).drop("_range")

    compared = reconcile(those(actual, "left_semi"), those(expected, "left_semi"), keys, null_safe)
    alike = those(actual, "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    status = F.when(F.col("_n") == 1, "match").otherwise("ambiguous").alias("status")
    return compared.unionAll(alike.select(*keys, status, F.array().cast("array<string>").alias("mismatched_cols")))


def match_report(reconciled: DataFrame) -> DataFrame:
    """Row counts per status."""
    return reconciled.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
