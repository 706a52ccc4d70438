"""File tables that a replayed micro-batch cannot spoil.

Every batch writes its own folder, and one that is finished is not written again. Files
appear when Spark commits the job, and a folder counts once it has its ``_SUCCESS`` file.
A table stores what each batch adds and puts it together when read; a micro-batch therefore
writes in proportion to itself and not to the table. Compaction stores the outcome once,
and is also where retention removes rows and where the layout is chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.operators.cdc import fold
from tidefold.operators.latest import latest_keep_ties
from tidefold.spec import Cdc

BATCH = "batch_id"
SEQUENCE = "_seq"
Step = Callable[[DataFrame], DataFrame]


class Folders:
    """One folder of rows per batch number below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def folder(self, number: int) -> str:
        return f"{self.path}/{BATCH}={number}"

    def write(self, number: int, rows: DataFrame) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self.folder(number))

    def _files(self, pattern: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[int]:
        """Numbers of the finished folders, in order. Reads the listing, not the data."""
        path, files = self._files(f"{self.path}/{BATCH}=*/_SUCCESS")
        names = (s.getPath().getParent().getName() for s in files.globStatus(path) or ())
        return sorted(int(name.partition("=")[2]) for name in names)

    def finished(self, number: int) -> bool:
        path, files = self._files(f"{self.folder(number)}/_SUCCESS")
        return files.exists(path)

    def read(self, numbers: list[int]) -> DataFrame:
        """Rows of the given folders with their number in ``_seq``."""
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        if not numbers:
            rows = self.spark.createDataFrame([], schema)
        else:
            reader = self.spark.read.schema(schema).option("basePath", self.path)
            rows = reader.parquet(*(self.folder(n) for n in numbers))
        return rows.withColumnRenamed(BATCH, SEQUENCE)

    def remove(self, numbers: list[int]) -> None:
        for number in numbers:
            path, files = self._files(self.folder(number))
            files.delete(path, True)


class FoldedTable:
    """A table made of a compacted base and the batches after it.

    Without ``settle`` the table is all rows. With it, ``settle`` turns the numbered rows of a
    key in ``keys`` into the table's rows for that key, numbered too. Settling an earlier
    outcome together with later batches has to give what settling all batches gives.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        settle: Step | None = None,
        keys: Sequence[str] = (),
    ) -> None:
        self.spark, self.path, self.settle, self.keys = spark, path, settle, list(keys)
        self.changes = Folders(spark, f"{path}/changes", schema)
        with_origin = T.StructType([*schema.fields, T.StructField("_from", T.LongType())])
        self.base = Folders(spark, f"{path}/base", with_origin)

    def write(self, number: int, rows: DataFrame) -> None:
        """Add a batch. One that is there already stays as it is: a replay brings the same rows, and
        writing them to new files would send them once more to whoever follows the table as a stream."""
        if not self.changes.finished(number):
            self.changes.write(number, rows)

    def _settled(self, below: int | None, base_below: int | None) -> DataFrame:
        """Numbered rows from the last base under ``base_below`` and the batches after it.

        Base rows of keys that no later batch mentions are settled already. They only pass an
        anti join with the mentioned keys, which for few batches is a broadcast: reading a
        large table does not shuffle it.
        """
        bases = [n for n in self.base.committed() if base_below is None or n < base_below]
        after = bases[-1] if bases else -1
        batches = [n for n in self.changes.committed() if n > after and (below is None or n < below)]
        rows = self.changes.read(batches)
        if not bases:
            return self.settle(rows) if self.settle else rows
        base = self.base.read([after]).drop(SEQUENCE).withColumnRenamed("_from", SEQUENCE)
        if not batches:
            return base
        if not self.settle:
            return base.unionByName(rows)
        mentioned = rows.select(*self.keys).distinct()
        touched = base.join(mentioned, self.keys, "left_semi").unionByName(rows)
        untouched = base.join(mentioned, self.keys, "left_anti")
        return untouched.unionByName(self.settle(touched))

    def batches(self, before: int) -> bool:
        """Whether any batch below ``before`` has been written."""
        return any(n < before for n in (*self.base.committed(), *self.changes.committed()))

    def read(self, before: int | None = None) -> DataFrame:
        """The table after all batches, or after those below ``before``."""
        return self._settled(before, before).drop(SEQUENCE)

    def compact(self, number: int, keep: Step | None = None, layout: Step | None = None) -> None:
        """Store the table after batch ``number`` as the base that later reads start from.

        ``keep`` selects the rows that stay, ``layout`` arranges them in files. Compacting a
        number again starts from the base below it, so it never reads what it replaces.
        """
        rows = self._settled(number + 1, number).withColumnRenamed(SEQUENCE, "_from")
        rows = keep(rows) if keep else rows
        self.base.write(number, layout(rows) if layout else rows)

    def remove_compacted(self) -> None:
        """Delete what the last base replaces. Not while a query started earlier still reads."""
        bases = self.base.committed()
        if bases:
            self.base.remove(bases[:-1])
            self.changes.remove([n for n in self.changes.committed() if n <= bases[-1]])


def state_table(spark: SparkSession, path: str, schema: T.StructType, cdc: Cdc) -> FoldedTable:
    """Rule-driven state: batches store change rows with flags; a settled row has all set."""
    flags = [r.flag for r in cdc.rules]
    with_flags = T.StructType([*schema.fields, *(T.StructField(f, T.BooleanType()) for f in flags)])

    def settle(numbered: DataFrame) -> DataFrame:
        state = fold(numbered.withColumn("_at", F.col(SEQUENCE)), cdc, SEQUENCE)
        return state.withColumnRenamed("_at", SEQUENCE).withColumns({f: F.lit(True) for f in flags})

    return FoldedTable(spark, path, with_flags, settle, cdc.key)


def replacing_table(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> FoldedTable:
    """Row sets by key: the last batch that mentions a key decides all its rows."""
    return FoldedTable(spark, path, schema, lambda rows: latest_keep_ties(rows, keys, SEQUENCE), keys)
