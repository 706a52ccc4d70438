"""Streams that stop, start again and see messages twice."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidefold.operators.latest import dedup_by_id
from tidefold.sources import bus, files
from tidefold.streaming import jobs
from tidefold.streaming.tables import FoldedTable, replacing_table

T0 = datetime.datetime(2024, 1, 15, 12)


def message(key, trigger, minute, *segments):
    at = (T0 + datetime.timedelta(minutes=minute)).strftime("%Y%m%d%H%M%S")
    pv1 = f"PV1|{'|' * 18}{key}{'|' * 25}{at}|{at}"
    return "\r".join([f"MSH|^~\\&|||||{at}||ADT^{trigger}", pv1, *segments])


def dx(code):
    return f"OBX|||8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED^LN||{code}"


def batch(spark, *lines):
    data = [(text, n, T0 + datetime.timedelta(minutes=n), "loader") for n, text in lines]
    return spark.createDataFrame(data, "msg string, msg_nm int, msg_enqueued_tsp timestamp, insert_user_id string")


ONE = [(9, message(1, "A01", 1, dx("a"), dx("b"))), (10, message(1, "A04", 2)), (11, message(2, "A03", 3, dx("c"))), (12, "no message")]
TWO = [(13, message(1, "A11", 4, dx("d"))), (14, message(2, "A13", 5)), (15, message("x", "A01", 6))]


def state(tables):
    return {
        int(r.pat_enc_csn_id): (r.msg_nm, r.adt_arvl_tm is not None, r.hosp_admsn_tm is not None, r.hosp_disch_tm is not None, r.cncl_admsn_flg)
        for r in tables.read("adt_dtl").collect()
    }


FINAL = {1: ("13", True, True, False, "True"), 2: ("14", False, False, False, None)}


def check_final(tables):
    assert state(tables) == FINAL
    assert rows(tables.read("adt_hist"), "msg_nm") == [("10",), ("11",), ("13",), ("14",), ("9",)]
    # Message 14 names no diagnosis, so encounter 2 keeps what it has.
    assert rows(tables.read("encntr_dx"), F.col("pat_enc_csn_id").cast("int"), "dx_icd_cd") == [(1, "d"), (2, "c")]
    assert tables.read("encntr_dx_hist").count() == 4


def test_two_batches(spark, scratch):
    tables = jobs.EncounterTables(spark, scratch)
    tables.apply(batch(spark, *ONE), 0)
    assert state(tables) == {1: ("10", True, True, False, None), 2: ("11", False, False, True, None)}
    assert rows(tables.read("encntr_dx"), "dx_icd_cd") == [("a",), ("b",), ("c",)]
    tables.apply(batch(spark, *TWO), 1)
    check_final(tables)
    assert rows(tables.rejected.read(), "msg_nm", "reason") == [("12", jobs.NO_MESSAGE), ("15", jobs.NO_KEY)]
    assert rows(tables.metrics.read().filter("table_name = 'adt_hist'"), "batch_rows") == [(2,), (3,)]
    assert tables.staged.committed() == []


def test_repeats_change_nothing(spark, scratch):
    """The same batch under its number, under a new one, and mixed with new messages."""
    tables = jobs.EncounterTables(spark, scratch)
    for number, lines in ((0, ONE), (0, ONE), (1, ONE), (2, ONE + TWO + TWO), (3, TWO + ONE)):
        tables.apply(batch(spark, *lines), number)
    check_final(tables)


def test_compaction_in_between(spark, scratch):
    tables = jobs.EncounterTables(spark, scratch)
    tables.apply(batch(spark, *ONE), 0)
    for table in (tables.history, tables.detail, *tables.children.values(), *tables.child_history.values()):
        table.compact(0)
        table.compact(0)
        table.remove_compacted()
    tables.apply(batch(spark, *TWO), 1)
    check_final(tables)
    tables.apply(batch(spark, *TWO), 1)
    check_final(tables)


def test_reading_does_not_shuffle_the_base(spark, scratch):
    """Only the keys of later batches are settled again; the rest passes a broadcast."""
    rows_ = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table = replacing_table(spark, scratch, rows_.schema, ["k"])
    table.write(0, rows_)
    table.compact(0)
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()
    table.write(1, rows_.filter("k = 7").withColumn("v", F.lit("new")))
    got = table.read()
    assert got.filter("v = 'new'").count() == 1 and got.count() == 100
    text = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin[^\n]*LeftAnti[^\n]*\n(?:(?!Exchange hash)[^\n]*\n){1,4}[^\n]*FileScan", text)


def test_retention_removes_from_all_tables(spark, scratch):
    tables = jobs.EncounterTables(spark, scratch)
    tables.apply(batch(spark, *ONE), 0)
    tables.retire(0, datetime.date(2024, 1, 18), files=2)
    for name in ("adt_hist", "adt_dtl", "encntr_dx", "encntr_dx_hist"):
        assert {int(k) for (k,) in rows(tables.read(name), "pat_enc_csn_id")} == {1}
    tables.apply(batch(spark, *TWO), 1)
    assert set(state(tables)) == {1, 2}


def test_stream_restarts_where_it_stopped(spark, scratch):
    tables = jobs.EncounterTables(spark, f"{scratch}/tables")
    schema = batch(spark, ONE[0]).schema
    for lines in (ONE, TWO, ONE):
        batch(spark, *lines).write.mode("append").parquet(f"{scratch}/in")
        jobs_run = tables.run(files.table_stream(spark, f"{scratch}/in", schema), f"{scratch}/checkpoint")
        jobs_run.awaitTermination()
        assert jobs_run.exception() is None
    check_final(tables)
    # A lost checkpoint: everything is delivered again, numbered behind what is there.
    tables.run(files.table_stream(spark, f"{scratch}/in", schema), f"{scratch}/fresh", generation=1).awaitTermination()
    check_final(tables)


def test_unfinished_folders_do_not_count(spark, scratch):
    table = FoldedTable(spark, scratch, spark.range(1).schema)
    table.write(0, spark.range(3))
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(table.changes.folder(1))
    assert table.read().count() == 3
    table.write(1, spark.range(2))
    assert table.read().count() == 5 and table.read(before=1).count() == 3


def test_bus_projections(spark):
    events = spark.createDataFrame(
        [(bytearray(b"hi"), "0", "7", 8, T0)], "body binary, partition string, offset string, sequenceNumber long, enqueuedTime timestamp"
    )
    assert rows(bus.with_read_time(events), "text", "msg_nm") == [("hi", "0-8-7")]
    assert rows(bus.with_enqueue_time(events), "msg", "msg_nm", "msg_enqueued_tsp") == [("hi", "7-8", T0)]
    shifted = bus.with_enqueue_time(events, "US/Central").first().msg_enqueued_tsp
    assert shifted == T0 - datetime.timedelta(hours=6)


def test_stream_dedup_is_bounded_by_a_watermark(spark, scratch):
    spark.createDataFrame([(1, T0), (1, T0), (2, T0)], "id int, t timestamp").write.parquet(f"{scratch}/in")
    stream = files.table_stream(spark, f"{scratch}/in", "id int, t timestamp").withWatermark("t", "1 hour")
    jobs.append_stream(dedup_by_id(stream, ["id"]), f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    assert rows(spark.read.parquet(f"{scratch}/out"), "id") == [(1,), (2,)]


def test_table_append_stream(spark, scratch):
    spark.range(5).write.parquet(f"{scratch}/in")
    stream = files.table_stream(spark, f"{scratch}/in", "id long")
    spark.sql(f"CREATE TABLE appended (id LONG) USING parquet LOCATION '{scratch}/table'")
    try:
        jobs.table_append_stream(stream, "appended", f"{scratch}/checkpoint").awaitTermination()
        assert spark.table("appended").count() == 5
    finally:
        spark.sql("DROP TABLE appended")


@pytest.mark.parametrize("small", [True, False])
def test_only_small_inputs_are_spread(spark, data, small):
    df = spark.read.parquet(f"{data}/events.parquet")
    if not small:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        parts = files.spread_small(df)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ("Repartition" in parts) is small


def events_of(spark, lines):
    """Bus events: partition, sequence, offset, minute, text."""
    data = [(bytearray(text.encode()), p, o, s, T0 + datetime.timedelta(minutes=m)) for p, s, o, m, text in lines]
    return spark.createDataFrame(data, "body binary, partition string, offset string, sequenceNumber long, enqueuedTime timestamp")


def from_bus(spark, lines, read=bus.with_enqueue_time):
    return read(events_of(spark, lines)).withColumn("insert_user_id", F.lit("loader"))


def test_positions(spark):
    ids = ["17", "300-8", "p-8-300", "a-b-8-300", "lost", "x-y", "1-x", "x-4", "", None, "-5", "9" * 38]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, id string").select("i", bus.position(F.col("id")).alias("p")).collect()
    shown = {ids[r.i]: r.p and (r.p.partition, r.p.sequence, r.p.offset) for r in got}
    assert shown == {
        "17": ("", 17, None), "300-8": ("", 8, 300), "p-8-300": ("p", 8, 300), "a-b-8-300": ("a-b", 8, 300), "lost": None, "x-y": None,
        "1-x": None, "x-4": ("", 4, None), "": None, None: None, "-5": ("", -5, None), "9" * 38: ("", int("9" * 38), None),
    }


@pytest.mark.parametrize("read", [bus.with_enqueue_time, bus.with_position])
def test_bus_ids_order_the_state(spark, scratch, read):
    """9 and 10 as sequences; the later time wins between partitions; what has no position is kept apart."""
    tables = jobs.EncounterTables(spark, scratch)
    lines = [
        ("0", 9, "90", 1, message(1, "A01", 1)), ("0", 10, "100", 1, message(1, "A04", 2)), ("1", 3, "7", 5, message(1, "A11", 4)),
        ("1", 2, "6", 2, message(2, "A13", 5)), ("1", None, "x", 3, message(2, "A01", 6)),
    ]
    tables.apply(from_bus(spark, lines, read), 0)
    tables.apply(from_bus(spark, lines[:2] + lines[4:], read), 1)
    last = {1: read is bus.with_position and "1-3-7" or "7-3", 2: read is bus.with_position and "1-2-6" or "6-2"}
    assert {k: v[0] for k, v in state(tables).items()} == last
    assert tables.read("adt_hist").count() == 4
    assert [r.reason for r in tables.rejected.read().collect()] == [jobs.NO_POSITION]
    marks = {r.partition: int(r.sequence) for r in tables.positions().collect()}
    assert marks == ({"0": 10, "1": 3} if read is bus.with_position else {"": 10})
    left = bus.beyond(events_of(spark, [("0", 10, "1", 1, "a"), ("0", 11, "1", 1, "b"), ("1", 4, "1", 1, "c"), ("2", 1, "1", 1, "d")]), tables.positions())
    assert rows(left, F.col("body").cast("string")) == ([("b",), ("c",), ("d",)] if read is bus.with_position else [("a",), ("b",), ("c",), ("d",)])


def test_messages_without_a_number_are_stored_once(spark, scratch):
    tables = jobs.EncounterTables(spark, scratch)
    lines = [(None, message(1, "A01", 1, dx("a"))), (None, message(1, "A04", 2)), (7, message(2, "A03", 3)), (None, "no message")]

    def plain(*lines):
        data = [(text, n, T0, "loader") for n, text in lines]
        return spark.createDataFrame(data, "msg string, msg_nm int, msg_enqueued_tsp timestamp, insert_user_id string")

    for number, part in ((0, lines[:2]), (1, lines), (1, lines), (2, lines + lines), (3, [*lines, (None, message(3, "A01", 9))])):
        tables.apply(plain(*part), number)
        if number == 2:
            for table in (tables.history, tables.ledger, tables.marks, tables.rejected):
                table.compact(2, jobs.bus_marks if table is tables.marks else None)
                table.remove_compacted()
    assert rows(tables.read("adt_hist"), F.col("pat_enc_csn_id").cast("int"), "trigger_evnt") == [(1, "A01"), (1, "A04"), (2, "A03"), (3, "A01")]
    assert set(state(tables)) == {1, 2, 3} and tables.rejected.read().count() == 1
    # Nothing to order it by.
    tables.apply(spark.createDataFrame([(message(4, "A01", 1), None, None, "l")], "msg string, msg_nm int, msg_enqueued_tsp timestamp, insert_user_id string"), 4)
    assert rows(tables.rejected.read(), "reason") == [(jobs.NO_MESSAGE,), (jobs.NO_POSITION,)]


def test_empty_batches(spark, scratch):
    tables = jobs.EncounterTables(spark, scratch)
    for number in range(2):
        tables.apply(batch(spark, *ONE).limit(0), number)
    assert tables.read("adt_hist").count() == 0
    tables.apply(batch(spark, *ONE), 2)
    tables.apply(batch(spark, *ONE).limit(0), 3)
    assert tables.read("adt_hist").count() == 3


def test_ledger_ranges_reach_the_scan(spark, scratch):
    """Of a ledger laid out by place, a batch opens the files its numbers and hashes may be in."""
    from tidefold.operators import ledger
    from tidefold.operators.retention import clustered

    def named(df):
        return df.select(ledger.place_of(F.col("n"), F.col("t")).alias("place"), ledger.name_of(F.col("n"), F.col("t")).alias("name"))

    every = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("n"), F.concat(F.lit("t"), "id").alias("t"))
    clustered(named(every), ["place"], 16).write.parquet(f"{scratch}/ledger")
    known = spark.read.schema(ledger.SCHEMA).parquet(f"{scratch}/ledger")
    some = every.filter("t IN ('t100', 't102', 't555')").unionAll(spark.createDataFrame([("7", "x"), (None, "new")], "n string, t string"))
    batch_ = named(some)
    m = batch_.agg(*ledger.measures()).first()
    spans = ledger.ranges(m["low"], m["high"], m["parts"])
    assert (7, 102) in spans and all(b <= e for b, e in spans) and 2 <= len(spans) <= 3
    assert ledger.repeats(batch_, known, spans).count() == 3
    scan = ledger.within(known, spans)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(place", scan._jdf.queryExecution().executedPlan().toString())
    assert scan.select(F.input_file_name()).distinct().count() <= 4 and scan.count() < 2000
    assert ledger.ranges(None, None, None) == [] and ledger.ranges(None, None, -1) == [(-(2**63), -1)]


def test_digest_places_are_below_zero(spark):
    from tidefold.operators import ledger

    got = spark.range(3000).select(ledger.place_of(F.lit(None).cast("string"), F.col("id").cast("string")).alias("place"))
    assert got.filter("place >= 0").isEmpty()
    for r in got.groupBy(F.shiftright(-1 - F.col("place"), 57).alias("part")).agg(F.min("place").alias("b"), F.max("place").alias("e")).collect():
        ((b, e),) = ledger.ranges(None, None, 1 << r.part if r.part < 63 else -(2**63))
        assert b <= r.b <= r.e <= e


def test_state_holds_the_keys_within_the_watermark_only(spark, scratch):
    """Over restarts: repeats within it are dropped, state of earlier keys goes, rows that come too late are left out."""
    held = []
    for hour in range(0, 60, 10):
        minutes = [*range(hour * 60, hour * 60 + 60), *range(hour * 60, hour * 60 + 60)]
        # Minute 59 comes again with the next file but one: by then it is behind the watermark.
        minutes += [(hour - 20) * 60 + 59] if hour >= 20 else []
        part = spark.createDataFrame([(m, T0 + datetime.timedelta(minutes=m)) for m in minutes], "id int, t timestamp")
        part.write.mode("append").parquet(f"{scratch}/in")
        stream = files.table_stream(spark, f"{scratch}/in", "id int, t timestamp")
        job = jobs.distinct_stream(stream, ["id"], "t", "2 hours", f"{scratch}/out", f"{scratch}/checkpoint")
        job.awaitTermination()
        held.append(job.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert rows(spark.read.parquet(f"{scratch}/out").groupBy("id").count(), "count") == [(1,)] * 360
    assert max(held) <= 120


def test_closed_windows_are_counted_once(spark, scratch):
    for hour in (0, 3, 9):
        part = spark.createDataFrame([("k", T0 + datetime.timedelta(hours=hour, minutes=m)) for m in (1, 2, 59)] + [("late", T0)], "k string, t timestamp")
        part.write.mode("append").parquet(f"{scratch}/in")
        stream = files.table_stream(spark, f"{scratch}/in", "k string, t timestamp")
        jobs.window_counts(stream, ["k"], "t", "1 hour", "1 hour", f"{scratch}/out", f"{scratch}/checkpoint").awaitTermination()
    got = rows(spark.read.parquet(f"{scratch}/out"), F.hour("begin"), "k", "rows")
    assert got == [(12, "k", 3), (12, "late", 2), (15, "k", 3)]  # the third one came too late


@pytest.mark.parametrize("name", ["stream_archive", "stream_files"])
def test_a_backlog_of_files_is_a_bounded_number_of_batches(spark, scratch, monkeypatch, name):
    """Many files, few batches, every row, and the files of all batches but the last in the archive."""
    from checks import streams

    rows_ = spark.range(70000).selectExpr("id AS event_id", "id % 7 AS user_id", "'view' AS event_type", "CAST(NULL AS STRING) AS props")
    rows_.repartition(70).write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: f"{scratch}/{name}")
    monkeypatch.setattr(streams, "table", lambda spark, sf, name: spark.read.parquet(f"{sf}/{name}.parquet").repartition(70))
    got = getattr(streams, name)(spark, scratch)
    assert got.count() == 70000 and got.select("event_id").distinct().count() == 70000
    batches = spark.read.text(f"{scratch}/{name.partition('_')[2]}/checkpoint/commits").select(F.input_file_name()).distinct().count()
    assert 1 < batches <= streams._BACKLOG_BATCHES


def test_files_per_trigger(spark, scratch):
    spark.range(10).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(scratch)
    assert [files.per_trigger(spark, scratch, n) for n in (3, 10, 20)] == [4, 1, 1] and files.per_trigger(spark, scratch, 20, least=3) == 3
    assert [files.rows_per_file(n, 500, 250_000) for n in (0, 1000, 600_000, 10**9)] == [500, 500, 3000, 250_000]


def test_messages_that_come_again_are_not_parsed_again(spark, scratch, monkeypatch):
    """Repeats go before the parse, a finished batch is not parsed at all, and raw text is kept of refused messages only."""
    tables, parsed, raw = jobs.EncounterTables(spark, scratch), [], []
    fan_out, write = jobs.messages.fan_out, tables.staged.write

    def counted(df, **given):
        parsed.append(df.count())
        return fan_out(df, **given)

    def kept(number, df):
        write(number, df)
        raw.append(tables.staged.read([number]).filter("raw IS NOT NULL").count())

    monkeypatch.setattr(jobs.messages, "fan_out", counted)
    monkeypatch.setattr(tables.staged, "write", kept)
    for number, lines in ((0, ONE), (0, ONE), (1, ONE + TWO), (2, TWO + ONE)):
        tables.apply(batch(spark, *lines), number)
    assert parsed == [4, 3, 0] and raw == [1, 1, 0]
    check_final(tables)
    assert tables.staged.committed() == tables.delivered.committed() == []


def test_layout_ranges_grow_with_the_table(spark, scratch, monkeypatch):
    """A task sorts one range, so a larger table has more of them; rows of unknown size take the number given."""
    from tidefold.operators import retention

    spark.range(20000).selectExpr("id", "id % 3 AS k").write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    assert retention.clustered(stored, ["id"], 2).rdd.getNumPartitions() == 2
    monkeypatch.setattr(retention, "RANGE_BYTES", 10_000)
    laid_out = retention.clustered(stored, ["k"], 2, ["id"])
    assert laid_out.rdd.getNumPartitions() > 4 and laid_out.exceptAll(stored).isEmpty() and laid_out.count() == 20000
    assert retention.clustered(spark.createDataFrame(stored.rdd, stored.schema), ["id"], 2).rdd.getNumPartitions() == 2
