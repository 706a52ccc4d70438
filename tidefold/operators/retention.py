"""Retention: what leaves the tables some days after discharge, and table layout."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.operators.cdc import delete_by_keys
from tidefold.operators.skew import pieces_of
from tidefold.session import scratch_path

# Fixed value: days between discharge and removal.
RETENTION_DAYS = 2
# Stored bytes that one range of a layout takes.
RANGE_BYTES = 16 * 2**20


def retention_threshold(as_of: datetime.date | None, days: int) -> Column:
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(day, days).cast("timestamp_ntz")


def expired_keys(
    history: DataFrame,
    keys: Sequence[str] = ("pat_enc_csn_id",),
    discharged: str = "hosp_disch_tm",
    as_of: datetime.date | None = None,
    days: int = RETENTION_DAYS,
) -> DataFrame:
    """Keys with any row discharged before midnight ``days`` days before ``as_of``.

    The bare column is compared with a constant, so the filter reaches the scan.
    """
    kind = history.schema[discharged].dataType
    return (
        history.filter(F.col(discharged) < retention_threshold(as_of, days).cast(kind))
        .select(*keys)
        .distinct()
    )


def retain_master(history: DataFrame, expired: DataFrame, keys: Sequence[str] = ("pat_enc_csn_id",)) -> DataFrame:
    """All rows of an expired key go, also those without a discharge time."""
    return delete_by_keys(history, expired, keys)


def retain_following(rows: DataFrame, master: DataFrame, keys: Sequence[str] = ("pat_enc_csn_id",)) -> DataFrame:
    """Rows whose key the master still has; orphans go too, and no row is repeated."""
    return rows.join(master.select(*keys), list(keys), "left_semi")


def retire(
    history: DataFrame,
    history_children: Mapping[str, DataFrame],
    detail: DataFrame,
    detail_children: Mapping[str, DataFrame],
    keys: Sequence[str] = ("pat_enc_csn_id",),
    discharged: str = "hosp_disch_tm",
    as_of: datetime.date | None = None,
    days: int = RETENTION_DAYS,
) -> dict[str, DataFrame]:
    """The nightly job: history by date, its children by key, detail by what history kept."""
    master = retain_master(history, expired_keys(history, keys, discharged, as_of, days), keys)
    state = retain_following(detail, master, keys)
    return {
        "history": master,
        "detail": state,
        **{n: retain_following(df, master, keys) for n, df in history_children.items()},
        **{n: retain_following(df, state, keys) for n, df in detail_children.items()},
    }


def purge_keys(detail: DataFrame, history: DataFrame, keys: Sequence[str] = ("pat_enc_csn_id",)) -> DataFrame:
    """Keys of the detail table that history no longer has."""
    return detail.select(*keys).join(history.select(*keys), list(keys), "left_anti").distinct()


class DayTable:
    """History rows in one folder per day of discharge (``day``; open encounters under one of their own).

    A night's retention then writes only the days that hold rows of expired keys, by Spark's dynamic partition overwrite, and removes
    the folders of days that are left without rows. The files of all other days stay what they are.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, discharged: str = "hosp_disch_tm") -> None:
        self.spark, self.path, self.discharged = spark, path, discharged
        self.schema = T.StructType([*schema.fields, T.StructField("day", T.DateType())])

    def append(self, rows: DataFrame) -> None:
        self._writer(rows, "append")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def retire(self, keys: Sequence[str] = ("pat_enc_csn_id",), as_of: datetime.date | None = None, days: int = RETENTION_DAYS) -> list[datetime.date | None]:
        """Drop all rows of keys with a discharge before midnight ``days`` days before ``as_of``; the days that were touched.

        Whole days behind the threshold go without being read for more than their keys.
        """
        before = retention_threshold(as_of, days).cast("date")
        rows = self.read()
        # The condition on the folder's day prunes: keys are read from expired days only.
        path = scratch_path(self.spark, "expired")
        rows.filter(F.col("day") < before).select(*keys).distinct().write.parquet(path)
        expired = self.spark.read.parquet(path)
        met = rows.select(*keys, "day").join(expired, list(keys), "left_semi").select("day").distinct()
        touched = [r["day"] for r in met.collect()]  # one per day that is kept: some hundreds a year
        if not touched:
            return []
        known = F.col("day").isin([d for d in touched if d is not None])
        left = retain_master(rows.filter(known | F.col("day").isNull() if None in touched else known), expired, keys)
        kept = {r["day"] for r in left.select("day").distinct().collect()}
        if kept:
            self._writer(left.drop("day"), "overwrite")
        for day in set(touched) - kept:
            self._remove(day)
        return sorted(touched, key=lambda d: (d is not None, d))

    def _writer(self, rows: DataFrame, mode: str) -> None:
        dated = rows.withColumn("day", F.to_date(self.discharged)).select(*self.schema.fieldNames())
        dated.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

    def _remove(self, day: datetime.date | None) -> None:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/day={name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clustered(df: DataFrame, keys: Sequence[str], files: int, spread: Sequence[str] = ()) -> DataFrame:
    """Lay rows out in ``files`` key ranges, so that file statistics prune by key; in more where the rows come from more than
    that many times ``RANGE_BYTES``, as a task sorts one range.

    ``spread`` columns extend the range key: a key with very many rows then spans several
    files instead of filling one.
    """
    order = [*keys, *spread]
    return df.repartitionByRange(max(files, pieces_of(df, RANGE_BYTES)), *order).sortWithinPartitions(*order)
