"""The running jobs: messages to history and latest state, append streams, copies."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidefold.functions.frames import audit_stamp, conform
from tidefold.functions.times import LOCAL_ZONE, shift_timestamps
from tidefold.operators import cdc as change
from tidefold.operators import ledger
from tidefold.operators.latest import dedup_by_id
from tidefold.operators.observe import batch_metrics
from tidefold.operators.retention import (
    RETENTION_DAYS, clustered, expired_keys, retain_following, retain_master, retention_threshold,
)
from tidefold.plans import messages
from tidefold.session import scratch_path
from tidefold.sources import bus
from tidefold.sources.mirror import DirectoryMirror, JdbcMirror
from tidefold.spec import CHILDREN, TABLES, Cdc, schema_of
from tidefold.streaming.tables import SEQUENCE, Folders, FoldedTable, replacing_table, state_table

METRICS = schema_of(
    "table_name string, batch_rows long, latest_msg_tm timestamp, first_insert_tsp timestamp, "
    "last_insert_tsp timestamp, seconds double"
)
REJECTED = schema_of("msg string, msg_nm string, msg_enqueued_tsp timestamp, insert_user_id string, reason string")
# Why a text is in quarantine.
NO_MESSAGE, NO_KEY = "no message", "no encounter number that fits"
NO_POSITION = "no position that can be read"
# What the staged parse keeps beside the five parts.
STAGED = ("raw", "is_valid", "msg_nm", "msg_enqueued_tsp", "insert_user_id", "place", "name")
DELIVERED = schema_of("msg string, msg_nm string, msg_enqueued_tsp timestamp, insert_user_id string, place long, name binary")
MARKS = schema_of("partition string, sequence decimal(38,0), offset decimal(38,0)")
# A batch number of the table is the stream's batch number plus this times the generation.
GENERATION = 10**12


def start(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch: every so often, or once over all there is."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(handle).start()


def together(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Run independent writes side by side; each is a small job of its own."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        for job in running:
            job.result()


def append_stream(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a file table."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = df.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def distinct_stream(
    df: DataFrame, keys: list[str], time: str, late: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the first event of each key to a file table. A key is remembered for ``late`` after its event time, by
    the stream's own clock, so that the state holds the keys of that time and not of all time; events later than that are left out."""
    return append_stream(dedup_by_id(df.withWatermark(time, late), keys), path, checkpoint, every)


def window_counts(
    df: DataFrame, keys: list[str], time: str, width: str, late: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append ``begin, end``, the keys and the number of rows of each window that no event can come to any more."""
    counted = df.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("rows"))
    closed = counted.select(F.col("window.start").alias("begin"), F.col("window.end").alias("end"), *keys, "rows")
    return append_stream(closed, path, checkpoint, every)


def table_append_stream(df: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a table of the catalog."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).toTable(table)


class EncounterTables:
    """History, latest state, children, flowsheet, quarantine and metrics of the feeds below one root."""

    def __init__(self, spark: SparkSession, root: str, cdc: Cdc | None = None) -> None:
        self.spark = spark
        self.cdc = cdc or Cdc(order=bus.arrival(F.col("msg_nm"), F.col("msg_enqueued_tsp")))
        self.history = FoldedTable(spark, f"{root}/adt_hist", TABLES["adt_hist"].schema)
        self.detail = state_table(spark, f"{root}/adt_dtl", TABLES["adt_dtl"].schema, self.cdc)
        self.child_history = {
            n: FoldedTable(spark, f"{root}/{n}_hist", TABLES[f"{n}_hist"].schema) for n in CHILDREN
        }
        self.children = {
            n: replacing_table(spark, f"{root}/{n}", TABLES[n].schema, list(TABLES[n].key)) for n in CHILDREN
        }
        self.flowsheet = FoldedTable(spark, f"{root}/flwsht", TABLES["flwsht"].schema)
        self.metrics = FoldedTable(spark, f"{root}/batch_metrics", METRICS)
        self.flowsheet_metrics = FoldedTable(spark, f"{root}/flwsht_metrics", METRICS)
        self.rejected = FoldedTable(spark, f"{root}/rejected", REJECTED)
        self.ledger = FoldedTable(spark, f"{root}/ledger", ledger.SCHEMA)
        self.marks = FoldedTable(spark, f"{root}/marks", MARKS)
        self.delivered = Folders(spark, f"{root}/delivered", DELIVERED)
        staged = messages.staged_schema(spark, list(STAGED)).add("reason", "string")
        self.staged = Folders(spark, f"{root}/staged", staged)

    def read(self, name: str) -> DataFrame:
        """A table by name, in its specified columns."""
        tables = {"adt_hist": self.history, "adt_dtl": self.detail, "flwsht": self.flowsheet, **self.children}
        tables |= {f"{n}_hist": t for n, t in self.child_history.items()}
        return tables[name].read().select(*TABLES[name].columns)

    def apply(self, batch: DataFrame, number: int, as_of: Column | None = None) -> None:
        """Take in one batch of ``msg, msg_nm, msg_enqueued_tsp, insert_user_id``.

        Applying a batch again, under its own or another number, changes nothing: of a message the first delivery
        counts, those that an earlier batch brought are left out, with a number or without, and the folders are replaced.
        What is no message, has no encounter number that fits or no place in the order goes to ``rejected``.
        A batch whose metrics are written, as they are last, is done. What earlier batches brought is left out before anything
        is parsed. The staged parse, and the texts before it, are emptied once the tables are written.
        """
        begin = time.monotonic()
        if self.metrics.changes.finished(number):
            return self._unstage(number)
        moment = F.current_timestamp() if as_of is None else as_of
        refused = (
            F.when(~F.col("is_valid"), NO_MESSAGE)
            .when(F.col("encounter.pat_enc_csn_id").try_cast("decimal(18,0)").isNull(), NO_KEY)
            .when(bus.arrival(F.col("msg_nm"), F.col("msg_enqueued_tsp")).isNull(), NO_POSITION)
        )
        parts = {n: messages.CHILD_PARTS[n] for n in CHILDREN}
        counts = {"adt_hist": F.lit(1)}
        for name, p in parts.items():
            counts[f"{name}_hist"] = F.size(p) if p in ("dx", "reasons") else F.col(p).isNotNull().cast("int")
        sized = {t: F.when(F.col("reason").isNull(), F.greatest(n, F.lit(0))) for t, n in counts.items()}
        # Which tables get rows, and what the metrics say of them.
        measures = [
            F.count("reason").alias("rejected"), F.min("row_insert_tsp").alias("first"), F.max("row_insert_tsp").alias("last"),
            *(F.coalesce(F.sum(n), F.lit(0)).alias(t) for t, n in sized.items()),
            *(F.max(F.when(n > 0, F.col("encounter.msg_tm"))).alias(f"{t}_tm") for t, n in sized.items()),
        ]
        # One staged write per batch: the source is read once and every message parsed once, why a text is refused is found once,
        # what is to be known of the batch is counted on the way, and a lost executor costs a re-read of files. The raw text
        # is kept of refused messages only.
        seen = Observation()
        parsed = messages.fan_out(messages.validate(self._fresh(batch, number).withColumn("raw", F.col("msg"))), carry=STAGED)
        judged = parsed.withColumn("row_insert_tsp", moment).withColumn("reason", refused)
        staged = judged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
        self.staged.write(number, staged.observe(seen, *measures))
        found = seen.get
        parsed = self.staged.read([number])
        sound = parsed.filter(F.col("reason").isNull())

        def stamped(rows: DataFrame, table: str) -> DataFrame:
            stamps = {"row_updt_tsp": F.col("row_insert_tsp"), "updt_user_id": F.col("insert_user_id")}
            return conform(rows.withColumns(stamps), TABLES[table])

        def history() -> DataFrame:
            return stamped(sound.select("encounter.*", "row_insert_tsp"), "adt_hist")

        def changes() -> DataFrame:
            rows = change.stamp_changes(change.transform(history(), self.cdc), self.cdc)
            # The few rows of the metrics know the latest update; the state need not be read.
            marks = self.metrics.read(before=number).filter(F.col("table_name") == "adt_hist")
            return change.incremental_since(rows, marks.select(F.col("last_insert_tsp").alias(self.cdc.updated)), self.cdc)

        def quarantined() -> DataFrame:
            return parsed.filter(F.col("reason").isNotNull()).withColumn("msg", F.col("raw"))

        def children(name: str) -> DataFrame:
            rows = messages.children(sound.select(*messages.PARTS, "row_insert_tsp"), parts[name])
            return stamped(rows, f"{name}_hist")

        def latest(name: str) -> DataFrame:
            return change.latest_children(children(name), ["pat_enc_csn_id"], "msg_tm")

        def names() -> DataFrame:
            return parsed.select("place", "name").sortWithinPartitions("place")

        taken = found["rejected"] + found["adt_hist"]
        writes = [
            (self.ledger, taken, names),
            (self.marks, taken, lambda: bus.high_water(parsed)),
            (self.rejected, found["rejected"], quarantined),
            (self.history, found["adt_hist"], history),
            (self.detail, found["adt_hist"], changes),
            *((self.child_history[n], found[f"{n}_hist"], partial(children, n)) for n in CHILDREN),
            *((self.children[n], found[f"{n}_hist"], partial(latest, n)) for n in CHILDREN),
        ]
        # A table that gets nothing costs no job; what an earlier attempt may have left goes.
        for table, n, _ in writes:
            if not n:
                table.changes.remove([number])
        # Each write plans itself in its own thread: for a small batch planning is most of the work.
        together(self.spark, [partial(lambda t, rows: t.write(number, rows()), t, rows) for t, n, rows in writes if n])
        seconds = time.monotonic() - begin
        measured = [
            (t, found[t], found[f"{t}_tm"], found["first"], found["last"], seconds) for t in counts if found[t]
        ]
        if measured:
            self.metrics.write(number, self.spark.createDataFrame(measured, METRICS))
        self._unstage(number)

    def _unstage(self, number: int) -> None:
        for folders in (self.staged, self.delivered):
            folders.remove([number])

    def _fresh(self, batch: DataFrame, number: int) -> DataFrame:
        """The batch's messages, each once, without those that earlier batches brought.

        Only where there are earlier batches the texts are written first, so that the ranges that their names are in are known
        before the ledger is read. Names decide alone, and the texts are joined with no more than the names that come again.
        """
        first = self._first(batch)
        if not self.ledger.batches(before=number):
            return first
        seen = Observation()
        self.delivered.write(number, first.observe(seen, F.count(F.lit(1)).alias("n"), *ledger.measures()))
        found = seen.get
        first = self.delivered.read([number]).drop(SEQUENCE)
        again = self._repeats(first, number, ledger.ranges(found["low"], found["high"], found["parts"]))
        if again is None:
            return first
        repeated, count = again
        return first.limit(0) if count == found["n"] else first.join(repeated, ["place", "name"], "left_anti")

    def _first(self, batch: DataFrame) -> DataFrame:
        """The batch's messages under their names, of each name the first delivery."""
        spark = self.spark
        delivered = batch.withColumn("msg_nm", F.col("msg_nm").cast("string"))
        number, text = F.col("msg_nm"), F.col("msg")
        named = delivered.withColumns({"place": ledger.place_of(number, text), "name": ledger.name_of(number, text)})
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return dedup_by_id(named.repartition(tasks, "name"), ["name"], ["msg_enqueued_tsp", "msg"])

    def _repeats(self, first: DataFrame, number: int, spans: list[tuple[int, int]]) -> tuple[DataFrame, int] | None:
        """Names in the batch that earlier batches brought, and how many, None if there are none."""
        if not spans:
            return None
        known = self.ledger.read(before=number)
        count = Observation()
        path = scratch_path(self.spark, "repeats")
        ledger.repeats(first, known, spans).observe(count, F.count(F.lit(1)).alias("n")).write.parquet(path)
        n = count.get["n"]
        return (self.spark.read.schema(ledger.SCHEMA).parquet(path), n) if n else None

    def positions(self) -> DataFrame:
        """How far each partition of the bus has been taken in (see ``bus.beyond``)."""
        return bus.highest(self.marks.read())

    def apply_flowsheet(self, events: DataFrame, number: int, as_of: Column | None = None, user: str | None = None) -> None:
        """Take in one batch of flowsheet events (``msg, msg_nm, msg_enqueued_tsp``); a replay replaces its folder."""
        begin = time.monotonic()
        self.flowsheet.write(number, flowsheet_rows(events, as_of, user))
        rows = self.flowsheet.changes.read([number]).withColumn("table_name", F.lit("flwsht"))
        measured = batch_metrics(rows, ["table_name"])
        self.flowsheet_metrics.write(number, measured.withColumn("seconds", F.lit(time.monotonic() - begin)))

    def retire(
        self, number: int, as_of: datetime.date | None = None, days: int = RETENTION_DAYS, files: int | None = None
    ) -> None:
        """Nightly, after batch ``number``: drop expired encounters from all tables, flowsheet
        included, and quarantined texts of that age, and lay history out by insert time and the latest tables by
        encounter. Raw texts of other batches are gone already; ``remove_compacted`` deletes the replaced files."""

        def layout(key: str, spread: str) -> Callable[[DataFrame], DataFrame] | None:
            return (lambda df: clustered(df, [key], files, [spread])) if files else None

        by_time = layout("row_insert_tsp", "pat_enc_csn_id")
        by_key = layout("pat_enc_csn_id", "msg_tm")
        expired = expired_keys(self.history.read(before=number + 1), as_of=as_of, days=days)
        self.history.compact(number, lambda df: retain_master(df, expired), by_time)
        # What decides the other tables is written once and read by each of them.
        kept = self._keys(self.history, number)
        for table in self.child_history.values():
            table.compact(number, lambda df: retain_following(df, kept), by_time)
        every = max([number, *self.flowsheet.changes.committed()[-1:]])
        self.flowsheet.compact(every, lambda df: retain_following(df, kept), by_time)
        self.detail.compact(number, lambda df: retain_following(df, kept), by_key)
        current = self._keys(self.detail, number)
        for table in self.children.values():
            table.compact(number, lambda df: retain_following(df, current), by_key)
        day = retention_threshold(as_of, days).cast("timestamp")
        self.rejected.compact(number, lambda df: df.filter(F.col("msg_enqueued_tsp") >= day))
        self.metrics.compact(number)
        self.flowsheet_metrics.compact(every)
        self.marks.compact(number, bus_marks)
        self.ledger.compact(number, None, (lambda df: clustered(df, ["place"], files)) if files else None)
        for folders in (self.staged, self.delivered):
            folders.remove(folders.committed())

    def _keys(self, table: FoldedTable, number: int) -> DataFrame:
        path = scratch_path(self.spark, "keys")
        keys = table.read(before=number + 1).select("pat_enc_csn_id").distinct()
        keys.write.parquet(path)
        return self.spark.read.schema(keys.schema).parquet(path)

    def remove_compacted(self) -> None:
        """Delete what the last ``retire`` replaced, in all tables."""
        tables = (
            self.history, self.detail, self.flowsheet, self.metrics, self.flowsheet_metrics, self.rejected, self.ledger, self.marks,
        )
        for table in (*tables, *self.child_history.values(), *self.children.values()):
            table.remove_compacted()

    def run(
        self, stream: DataFrame, checkpoint: str, every: str | None = None, generation: int = 0
    ) -> StreamingQuery:
        """Apply every micro-batch. Raise ``generation`` with every new checkpoint folder, so
        that its batch numbers do not meet those of the one before."""
        first = generation * GENERATION
        return start(stream, lambda df, n: self.apply(df, first + n), checkpoint, every)


def bus_marks(rows: DataFrame) -> DataFrame:
    """One stored mark per partition."""
    return bus.highest(rows).withColumn("_from", F.lit(0).cast("long"))


def flowsheet_rows(events: DataFrame, as_of: Column | None = None, user: str | None = None, strict: bool = False) -> DataFrame:
    """Bus events to flowsheet table rows; works on streams too."""
    parsed = messages.parse_flowsheet(events, "msg", strict)
    return conform(audit_stamp(parsed, as_of, user, "msg_enqueued_tsp"), TABLES["flwsht"])


def medication_rows(events: DataFrame) -> DataFrame:
    """Bus events to medication table rows; works on streams too."""
    return conform(messages.parse_medication(events, "msg"), TABLES["med_admn"])


def upsert_stream(
    df: DataFrame,
    table: FoldedTable,
    keys: list[str],
    order: str,
    checkpoint: str,
    history: FoldedTable | None = None,
    every: str | None = None,
    generation: int = 0,
) -> StreamingQuery:
    """Keep the latest rows per key, and with ``history`` append every row there too."""
    first = generation * GENERATION

    def handle(batch: DataFrame, n: int) -> None:
        if history:
            history.write(first + n, batch)
            batch = history.changes.read([first + n]).drop(SEQUENCE)
        table.write(first + n, change.latest_children(batch, keys, order))

    return start(df, handle, checkpoint, every)


def mirror_changes(
    table: FoldedTable, number: int, changed: DataFrame, zone: str = LOCAL_ZONE
) -> None:
    """Bring a mirror up to date with the changed rows only, as the wall clock of ``zone``.

    ``table`` is a replacing table: the rows replace all that the mirror has for their keys.
    """
    table.write(number, shift_timestamps(changed, zone))


def copy_stream(
    df: DataFrame, mirror: DirectoryMirror | JdbcMirror, table: str, checkpoint: str,
    every: str | None = None, zone: str | None = None,
) -> StreamingQuery:
    """Copy appended rows to a mirror. A directory gets one folder per batch, replaced on replay."""

    def handle(batch: DataFrame, n: int) -> None:
        if isinstance(mirror, DirectoryMirror):
            mirror.write(batch, f"{table}/batch_id={n}", "overwrite", zone)
        else:
            mirror.write(batch, table, "append", zone)

    return start(df, handle, checkpoint, every)
