"""Message files as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schema of Spark's binaryFile source; a stream has to name it.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def binary_stream(
    spark: SparkSession,
    directory: str,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New files of a directory as they arrive; with ``archive``, moved there once done."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(directory)


def per_trigger(spark: SparkSession, directory: str, batches: int, least: int = 1) -> int:
    """How many files a trigger takes so that what waits in a directory is done in at most so many batches.

    A micro-batch costs about the same however few files it has, so a fixed number of files makes a backlog's time grow with its
    number of files. Reads the listing, as the stream does.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    waiting = sum(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(path))
    return max(least, -(-waiting // batches))


def rows_per_file(rows: int, least: int, most: int, files: int = 200) -> int:
    """Records per file so that a table makes about so many files: not below ``least``, and not above ``most``, as a whole file is one value."""
    return max(least, min(most, -(-rows // files)))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def decoded(files: DataFrame, with_name: bool = False) -> DataFrame:
    """``text`` of every file, and its name as ``msg_nm``."""
    text = F.decode("content", "UTF-8").alias("text")
    return files.select(text, file_name(F.col("path")).alias("msg_nm")) if with_name else files.select(text)


def spread_small(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Use all cores on an input that is small but expensive to parse.

    A small file is one task however much work its rows are. Only an input with fewer splits
    than cores is shuffled, so what is shuffled is less than one file split per core.
    ``source`` is the scan that ``df`` comes from, where that is one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (source or df)._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df


def table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Rows appended to a file table, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
