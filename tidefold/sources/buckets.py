"""Tables written once in the order that later joins and aggregations need."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.operators.skew import PIECE_ROWS
from tidefold.session import scratch_path


def bucketed(df: DataFrame, key: str, buckets: int, name: str, most: int = PIECE_ROWS) -> DataFrame:
    """``df`` as a table of ``buckets`` buckets by ``key``, sorted by it.

    Tables with one number of buckets and one type of key join by it, and are aggregated by it, without a shuffle. A bucket is one task, and
    nothing can split it later, so a table with a key (NULL included) of more than ``most`` rows is written without buckets: joins
    shuffle it then, and adaptive execution splits the key. The files lie in the shared folder, the catalog holds the name only.
    """
    spark = df.sparkSession
    largest = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    path = scratch_path(spark, name)
    if largest > most:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    table = f"{name}_{uuid.uuid4().hex}"
    # One task per bucket, so that a bucket is one sorted file.
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)
