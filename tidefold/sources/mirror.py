"""A second copy of the tables, in a warehouse or a directory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidefold.functions.times import LOCAL_ZONE, shift_timestamps


class DirectoryMirror:
    """Tables as parquet directories below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}")

    def write(self, df: DataFrame, table: str, mode: str = "append", zone: str | None = None) -> None:
        """Append or overwrite; with ``zone``, timestamps are written as its wall clock."""
        shifted = shift_timestamps(df, zone) if zone else df
        shifted.write.mode(mode).parquet(f"{self.root}/{table}")


class JdbcMirror:
    """Tables of a warehouse. Filters on what ``read`` returns run in the warehouse."""

    def __init__(self, spark: SparkSession, url: str, **options: str) -> None:
        self.spark, self.url, self.options = spark, url, options

    def read(self, table: str, partition: Mapping[str, str] | None = None) -> DataFrame:
        """``partition`` takes Spark's partitionColumn, lowerBound, upperBound, numPartitions."""
        return self._reader().option("dbtable", table).options(**(partition or {})).load()

    def query(self, sql: str) -> DataFrame:
        return self._reader().option("query", sql).load()

    def write(self, df: DataFrame, table: str, mode: str = "append", zone: str | None = LOCAL_ZONE) -> None:
        shifted = shift_timestamps(df, zone) if zone else df
        writer = shifted.write.format("jdbc").mode(mode).option("truncate", "true")
        writer.option("url", self.url).option("dbtable", table).options(**self.options).save()

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.options)
