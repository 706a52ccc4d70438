"""Events of a message bus, and the order that their positions give them.

A bus numbers the events of each partition. ``position`` reads partition, sequence and offset from an id as this module makes it,
and ``arrival`` turns them into a value that rows can be compared by: within a partition the bus never takes back time, so enqueue
time and then sequence is the partition's own order, and between partitions the time decides. Plain numbers, as queues
give them, are compared as numbers; a message without a number has the place of its time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBER = "decimal(38,0)"
# No number has a dash behind a digit, unless it has an exponent. Telling so is cheaper than a cast that fails.
_COMPOSED = r"^[^eE]*[0-9]-[^eE]*$"


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    earliest: bool = True,
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Kafka records in the shape of bus events; how many at most per trigger is up to the caller.

    Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if earliest else "latest")
        .options(**options)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(
        F.col("value").alias("body"),
        F.col("partition").cast("string").alias("partition"),
        F.col("offset").cast("string").alias("offset"),
        F.col("offset").alias("sequenceNumber"),
        F.col("timestamp").alias("enqueuedTime"),
    )


def message_id(*parts: str) -> Column:
    return F.concat_ws("-", *parts)


def with_read_time(events: DataFrame) -> DataFrame:
    """``text, msg_nm, read_tmsp``; the time is that of the micro-batch."""
    return events.select(
        F.col("body").cast("string").alias("text"),
        message_id("partition", "sequenceNumber", "offset").alias("msg_nm"),
        F.current_timestamp().alias("read_tmsp"),
    )


def with_enqueue_time(events: DataFrame, zone: str | None = None) -> DataFrame:
    """``msg, msg_nm, msg_enqueued_tsp``; with ``zone`` the time is that zone's wall clock."""
    enqueued = F.col("enqueuedTime")
    return events.select(
        F.col("body").cast("string").alias("msg"),
        message_id("offset", "sequenceNumber").alias("msg_nm"),
        (F.from_utc_timestamp(enqueued, zone) if zone else enqueued).alias("msg_enqueued_tsp"),
    )


def with_position(events: DataFrame) -> DataFrame:
    """``msg, msg_nm, msg_enqueued_tsp``; the id names partition, sequence and offset."""
    return events.select(
        F.col("body").cast("string").alias("msg"),
        message_id("partition", "sequenceNumber", "offset").alias("msg_nm"),
        F.col("enqueuedTime").alias("msg_enqueued_tsp"),
    )


def _plain(msg_nm: Column) -> Column:
    """An id that is a number."""
    return F.when(~msg_nm.rlike(_COMPOSED), msg_nm.try_cast(_NUMBER))


def position(msg_nm: Column) -> Column:
    """``partition, sequence, offset`` of an id: ``partition-sequence-offset``, ``offset-sequence`` or a plain number.

    NULL if there is no sequence that can be read. A partition's name may hold dashes; it is empty in the shorter forms.
    """
    parts = F.split(msg_nm, "-")
    size = F.size(parts)
    long_form = size >= 3

    def number(at: Column) -> Column:
        return F.try_element_at(parts, at).try_cast(_NUMBER)

    plain = _plain(msg_nm)
    sequence = F.when(plain.isNotNull(), plain).when(long_form, number(size - 1)).otherwise(number(F.lit(2)))
    offset = F.when(plain.isNotNull(), F.lit(None)).when(long_form, number(size)).otherwise(number(F.lit(1)))
    partition = F.when(plain.isNull() & long_form, F.array_join(F.slice(parts, 1, F.greatest(size - 2, F.lit(1))), "-")).otherwise("")
    return F.when(sequence.isNotNull(), F.struct(partition.alias("partition"), sequence.alias("sequence"), offset.alias("offset")))


def arrival(msg_nm: Column, enqueued: Column) -> Column:
    """What orders messages: NULL for those that have neither a readable position nor, without any id, a time."""
    at = position(msg_nm)
    plain = _plain(msg_nm).isNotNull()
    placed = F.struct(
        F.when(~plain, enqueued).alias("enqueued"), at["sequence"].alias("sequence"), at["offset"].alias("offset"), at["partition"].alias("partition")
    )
    unnumbered = F.struct(
        enqueued.alias("enqueued"), F.lit(None).cast(_NUMBER).alias("sequence"), F.lit(None).cast(_NUMBER).alias("offset"), F.lit(None).cast("string").alias("partition")
    )
    return F.when(at.isNotNull(), placed).when(msg_nm.isNull() & enqueued.isNotNull(), unnumbered)


def high_water(df: DataFrame, msg_nm: str = "msg_nm") -> DataFrame:
    """How far each partition has been read: ``partition, sequence, offset``, one row for each."""
    placed = df.select(position(F.col(msg_nm)).alias("_p")).filter("_p IS NOT NULL").select("_p.*")
    return highest(placed)


def highest(marks: DataFrame) -> DataFrame:
    """One mark per partition out of several."""
    top = F.max(F.struct("sequence", "offset")).alias("_top")
    return marks.groupBy("partition").agg(top).select("partition", "_top.sequence", "_top.offset")


def beyond(events: DataFrame, marks: DataFrame) -> DataFrame:
    """Events of a bus that lie behind the mark of their partition, and all of partitions without one.

    What a stream that starts from the earliest event has been through already is left out before it is parsed. There is
    one mark per partition of the bus, which bounds the broadcast.
    """
    known = marks.select(F.col("partition").alias("_at"), F.col("sequence").alias("_mark"))
    met = events.join(F.broadcast(known), F.col("partition") == F.col("_at"), "left")
    return met.filter(F.col("_mark").isNull() | (F.col("sequenceNumber") > F.col("_mark"))).drop("_at", "_mark")
