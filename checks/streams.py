"""Streams, file tables and mirrors; their results live below the shared scratch folder."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import Checks, comparable, components, digits, message, segment, table
from checks import cdc as cdc_checks
from checks.cdc import LINE, MERGE_SQL
from checks.history import FLAG_RULES, LATEST, RULE_JOINS, RULE_VALUES, TRIGGER, rules_sql
from checks.messages import _flowsheet_sql, checks as message_checks, flowsheet_messages, medication_messages
from tidefold.operators import cdc as change
from tidefold.operators.retention import clustered
from tidefold.session import scratch_path
from tidefold.sources import bus, files
from tidefold.sources.mirror import DirectoryMirror
from tidefold.spec import CHILDREN, TABLES
from tidefold.streaming import jobs
from tidefold.streaming.tables import FoldedTable, replacing_table

checks = Checks()


# Observation codes of the message format.
_CHIEF_COMPLAINT = "8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED^LN"
_VISIT_REASON = "8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100^LN"
_ACUITY = "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN"
_TRIAGE_NOTE = "54094-8^TRIAGE NOTE:FIND:PT:EMERGENCY DEPARTMENT:DOC^LN"


def _message(key: Column, note: Column) -> Column:
    """The message that an event stands for; every encounter column and every child table is filled."""

    def tagged(tag: str, expression: str) -> Column:
        return F.concat(F.lit(tag), F.expr(expression).cast("string"))

    ts = F.col("ts")
    place = components({1: tagged("D", "user_id % 5"), 2: tagged("R", "user_id % 7"), 3: tagged("B", "user_id % 3"), 5: "S"})
    return message(
        segment("MSH", {7: digits(ts), 9: F.concat(F.lit("ADT^"), F.expr(TRIGGER)), 10: tagged("G", "event_id")}),
        segment("EVN", {5: components({1: tagged("E", "user_id"), 14: tagged("L", "user_id % 6")})}),
        segment("PID", {3: tagged("M", "user_id"), 7: "19800115000000", 8: F.substring("event_type", 1, 1)}),
        segment("ZPD", {7: F.expr("CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END")}),
        segment("PV1", {2: F.upper("event_type"), 3: place, 19: key, 36: tagged("H", "event_id % 4"), 44: digits(ts + F.expr("INTERVAL 1 MINUTE")), 45: digits(ts + F.expr("INTERVAL 3 MINUTE")), 50: F.col("user_id") + 7000}),
        segment("PV2", {2: tagged("A", "event_id % 3"), 38: "W"}),
        segment("ZPV", {15: tagged("Z", "event_id % 5")}),
        segment("DG1", {4: tagged("C", "event_id"), 6: "E"}),
        segment("OBX", {3: _CHIEF_COMPLAINT, 5: tagged("D", "event_id")}),
        segment("OBX", {3: _VISIT_REASON, 5: components({9: tagged("V", "event_id")})}),
        segment("OBX", {3: _ACUITY, 5: components({2: tagged("Q", "event_id % 5")})}),
        segment("OBX", {3: _TRIAGE_NOTE, 5: note}),
    )


_DELIVERY = "CASE WHEN day(ts) < 11 THEN 1 WHEN day(ts) < 21 THEN 2 ELSE 3 END"


def encounter_messages(spark: SparkSession, sf: str) -> DataFrame:
    """One message per event, with the number of the batch that delivers it."""
    return table(spark, sf, "events").select(
        _message(F.col("user_id"), F.col("props")).alias("msg"), F.col("event_id").cast("int").alias("msg_nm"),
        F.col("ts").cast("timestamp").alias("msg_enqueued_tsp"), F.concat(F.lit("u"), "user_id").alias("insert_user_id"),
        F.expr(_DELIVERY).alias("batch"),
    )


MESSAGE = "msg string, msg_nm int, msg_enqueued_tsp timestamp, insert_user_id string"


def run_feed(spark: SparkSession, sf: str) -> jobs.EncounterTables:
    """Three deliveries through a file stream, the second one delivered again at the end."""
    root = scratch_path(spark, "feed")
    tables = jobs.EncounterTables(spark, f"{root}/tables")
    rendered = encounter_messages(spark, sf)
    for delivery in (1, 2, 3, 2):
        rendered.filter(F.col("batch") == delivery).drop("batch").write.mode("append").parquet(f"{root}/in")
        stream = files.table_stream(spark, f"{root}/in", MESSAGE)
        tables.run(stream, f"{root}/checkpoint").awaitTermination()
    return tables


# The feed stores whole seconds of local time.
_S = f"""s AS (SELECT user_id AS pat_enc_csn_id, event_id AS msg_nm, {TRIGGER} AS trigger_evnt, props,
    date_trunc('second', ts) + INTERVAL 6 HOUR AS msg_tm, ts AS msg_enqueued_tsp, concat('u', user_id) AS insert_user_id,
    date_trunc('second', ts) + INTERVAL 361 MINUTE AS adt_arvl_tm, date_trunc('second', ts) + INTERVAL 361 MINUTE AS hosp_admsn_tm,
    date_trunc('second', ts) + INTERVAL 363 MINUTE AS hosp_disch_tm, 'ADT' AS msg_typ, 'STL' AS msg_src, concat('G', event_id) AS bod_id,
    concat('M', user_id) AS pat_mrn_id, TIMESTAMP '1980-01-15 06:00:00' AS birth_dt, CAST(NULL AS TIMESTAMP) AS death_dt,
    upper(event_type) AS pat_class_abbr, concat('D', user_id % 5) AS dept_abbr, concat('L', user_id % 6) AS loc_abbr,
    concat('R', user_id % 7) AS room_nm, concat('B', user_id % 3) AS bed_label, 'S' AS bed_stat, substr(event_type, 1, 1) AS sex_abbr,
    'W' AS means_of_arrv_abbr, concat('Q', event_id % 5) AS acuity_level_abbr, concat('Z', event_id % 5) AS ed_dsptn_abbr,
    concat('H', event_id % 4) AS disch_dsptn_abbr, user_id + 7000 AS hsp_acct_id, concat('A', event_id % 3) AS accommodation_abbr,
    concat('E', user_id) AS user_id, concat('u', user_id) AS updt_user_id,
    CASE WHEN event_id % 2 = 0 THEN 'Y' END AS pregnancy_flg FROM events)"""
_DETAIL = [c for c in TABLES["adt_dtl"].columns if c not in ("row_insert_tsp", "row_updt_tsp")]
_PLAIN = ", ".join(c for c in _DETAIL if c not in (*FLAG_RULES, "msg_nm"))
DETAIL_SQL = f"""WITH {_S}, h AS (SELECT * FROM s), {LATEST}, {rules_sql(FLAG_RULES)}
    SELECT CAST(msg_nm AS VARCHAR) AS msg_nm, {_PLAIN}, {RULE_VALUES} FROM l {RULE_JOINS}"""


@checks.add("stream_state", DETAIL_SQL)
def stream_state(spark, sf):
    return comparable(run_feed(spark, sf).read("adt_dtl").select(*_DETAIL))


def _loaded(spark, sf) -> jobs.EncounterTables:
    """Batches applied one by one: the second twice under its number and once under a new one."""
    tables = jobs.EncounterTables(spark, scratch_path(spark, "replay"))
    rendered = encounter_messages(spark, sf)
    for number, delivery in ((0, 1), (1, 2), (1, 2), (2, 3), (3, 2)):
        tables.apply(rendered.filter(F.col("batch") == delivery).drop("batch"), number)
    return tables


@checks.add("replay_idempotent", DETAIL_SQL)
def replay_idempotent(spark, sf):
    return comparable(_loaded(spark, sf).read("adt_dtl").select(*_DETAIL))


@checks.add(
    "stream_history",
    f"""WITH {_S} SELECT pat_enc_csn_id, CAST(msg_nm AS VARCHAR) AS msg_nm, trigger_evnt, msg_tm, msg_enqueued_tsp,
    insert_user_id, 1 AS copies FROM s""",
)
def stream_history(spark, sf):
    names = ["pat_enc_csn_id", "msg_nm", "trigger_evnt", "msg_tm", "msg_enqueued_tsp", "insert_user_id"]
    history = _loaded(spark, sf).read("adt_hist").select(*names)
    return comparable(history.groupBy(*history.columns).agg(F.count("*").cast("int").alias("copies")))


@checks.add(
    "stream_children",
    f"""WITH {_S}, h AS (SELECT * FROM s), {LATEST}
    SELECT 'encntr_dx' AS child, pat_enc_csn_id, msg_tm, concat('D', msg_nm) AS payload FROM l
    UNION ALL SELECT 'encntr_er_complnt', pat_enc_csn_id, msg_tm, concat('C', msg_nm) FROM l
    UNION ALL SELECT 'encntr_visit_rsn', pat_enc_csn_id, msg_tm, concat('V', msg_nm) FROM l
    UNION ALL SELECT 'encntr_nte', pat_enc_csn_id, msg_tm, props FROM l""",
)
def stream_children(spark, sf):
    """Latest children after compaction on the way and more batches behind it."""
    tables = jobs.EncounterTables(spark, scratch_path(spark, "children"))
    rendered = encounter_messages(spark, sf)
    for number in (1, 2, 3):
        tables.apply(rendered.filter(F.col("batch") == number).drop("batch"), number)
        if number == 2:
            for child in CHILDREN:
                tables.children[child].compact(number)
                tables.children[child].remove_compacted()
    return comparable(_child_rows(tables))


def _child_rows(tables: jobs.EncounterTables) -> DataFrame:
    """The latest rows of all child tables under one payload column."""
    shown = {"encntr_dx": "dx_icd_cd", "encntr_er_complnt": "er_complnt", "encntr_visit_rsn": "encntr_rsn", "encntr_nte": "nte_txt"}
    parts = [
        tables.read(n).select(F.lit(n).alias("child"), "pat_enc_csn_id", "msg_tm", F.col(c).alias("payload"))
        for n, c in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_SOUND = "event_id % 10 NOT IN (1, 2, 6)"


@checks.add(
    "stream_dirty",
    f"""WITH e AS (SELECT * FROM events WHERE {_SOUND}),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM e) WHERE rn = 1)
    SELECT 'adt_hist' AS name, user_id AS pat_enc_csn_id, CAST(event_id AS VARCHAR) AS msg_nm, NULL AS payload, 1 AS copies FROM e
    UNION ALL SELECT 'adt_dtl', user_id, CAST(event_id AS VARCHAR), NULL, 1 FROM l
    UNION ALL SELECT 'encntr_dx', user_id, NULL, concat('D', event_id), 1 FROM l
    UNION ALL SELECT 'encntr_er_complnt', user_id, NULL, concat('C', event_id), 1 FROM l
    UNION ALL SELECT 'encntr_visit_rsn', user_id, NULL, concat('V', event_id), 1 FROM l
    UNION ALL SELECT 'encntr_nte', user_id, NULL, props, 1 FROM l
    UNION ALL SELECT 'rejected', -1, CAST(event_id AS VARCHAR),
        CASE WHEN event_id % 10 = 6 THEN 'no message' ELSE 'no encounter number that fits' END, 1 FROM events WHERE NOT {_SOUND}""",
)
def stream_dirty(spark, sf):
    """A feed of bad messages: numbers of 19 digits, none at all, framed text, no message, repeats with a later time, and
    numbers with two payloads. Nothing is lost, doubled or in the way of the rest."""
    kind = F.col("event_id") % 10
    key = F.when(kind == 1, F.lit("1234567890123456789")).when(kind == 2, F.lit("")).otherwise(F.col("user_id").cast("string"))
    framed = F.concat(F.lit("\x0b"), _message(key, F.col("props")), F.lit("\x1c\r"))
    text = F.when(kind == 3, framed).when(kind == 6, F.lit("no message")).otherwise(_message(key, F.col("props")))
    first = table(spark, sf, "events").select(
        text.alias("msg"), F.col("event_id").cast("int").alias("msg_nm"), F.col("ts").cast("timestamp").alias("msg_enqueued_tsp"),
        F.concat(F.lit("u"), "user_id").alias("insert_user_id"), F.expr(_DELIVERY).alias("batch"),
    )
    hour = F.col("msg_enqueued_tsp") + F.expr("INTERVAL 1 HOUR")
    number = F.col("msg_nm") % 10
    later = first.filter(number.isin(4, 6)).withColumns({"batch": F.col("batch") + 1, "msg_enqueued_tsp": hour})
    other = first.filter(number == 5).withColumns({"msg": F.replace("msg", F.lit("|C"), F.lit("|X")), "msg_enqueued_tsp": hour})
    feed = first.unionByName(later).unionByName(other)
    tables = jobs.EncounterTables(spark, scratch_path(spark, "dirty"))
    for batch in (1, 2, 3, 4):
        tables.apply(feed.filter(F.col("batch") == batch).drop("batch"), batch)

    def named(rows: DataFrame, name: str, key: str, number: str, payload: str) -> DataFrame:
        return rows.selectExpr(f"'{name}' AS name", f"CAST({key} AS BIGINT) AS pat_enc_csn_id", f"{number} AS msg_nm", f"{payload} AS payload")

    parts = [named(tables.read(n), n, "pat_enc_csn_id", "msg_nm", "CAST(NULL AS STRING)") for n in ("adt_hist", "adt_dtl")]
    children = _child_rows(tables).selectExpr("child AS name", "CAST(pat_enc_csn_id AS BIGINT) AS pat_enc_csn_id", "CAST(NULL AS STRING) AS msg_nm", "payload")
    rows = reduce(DataFrame.unionByName, [*parts, children, named(tables.rejected.read(), "rejected", "-1", "msg_nm", "reason")])
    return rows.groupBy(*rows.columns).agg(F.count("*").cast("int").alias("copies"))


_BUS_SOUND = "event_id % 10 <> 3"


@checks.add(
    "stream_bus_ids",
    f"""WITH e AS (SELECT * FROM events WHERE {_BUS_SOUND}),
    l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e)
    SELECT 'adt_hist' AS name, user_id AS pat_enc_csn_id, concat(event_id * 7, '-', event_id) AS msg_nm, 1 AS copies FROM e
    UNION ALL SELECT 'adt_dtl', user_id, concat(event_id * 7, '-', event_id), 1 FROM l WHERE rn = 1
    UNION ALL SELECT 'rejected', -1, concat('lost', event_id), 1 FROM events WHERE NOT {_BUS_SOUND}
    UNION ALL SELECT 'mark', -1, CAST(max(event_id) AS VARCHAR), 1 FROM e""",
)
def stream_bus_ids(spark, sf):
    """Events of a bus under the ids that the bus module gives them, one delivery twice; those without a sequence are kept apart."""
    lost = F.col("event_id") % 10 == 3
    events = table(spark, sf, "events").select(
        F.encode(_message(F.col("user_id"), F.col("props")), "UTF-8").alias("body"), F.expr("CAST(user_id % 4 AS STRING)").alias("partition"),
        F.when(lost, F.concat(F.lit("lost"), "event_id")).otherwise((F.col("event_id") * 7).cast("string")).alias("offset"),
        F.when(~lost, F.col("event_id")).alias("sequenceNumber"), F.col("ts").cast("timestamp").alias("enqueuedTime"), F.expr(_DELIVERY).alias("batch"),
    )
    tables = jobs.EncounterTables(spark, scratch_path(spark, "bus"))
    for number, delivery in enumerate((1, 2, 3, 2)):
        batch = bus.with_enqueue_time(events.filter(F.col("batch") == delivery))
        tables.apply(batch.withColumn("insert_user_id", F.lit("bus")), number)

    def named(rows: DataFrame, name: str, key: str, number: str) -> DataFrame:
        return rows.selectExpr(f"'{name}' AS name", f"CAST({key} AS BIGINT) AS pat_enc_csn_id", f"CAST({number} AS STRING) AS msg_nm")

    parts = [named(tables.read(n), n, "pat_enc_csn_id", "msg_nm") for n in ("adt_hist", "adt_dtl")]
    parts += [named(tables.rejected.read(), "rejected", "-1", "msg_nm"), named(tables.positions(), "mark", "-1", "sequence")]
    return reduce(DataFrame.unionByName, parts).groupBy("name", "pat_enc_csn_id", "msg_nm").agg(F.count("*").cast("int").alias("copies"))


@checks.add(
    "stream_ledger",
    """SELECT concat('G', event_id) AS bod_id, user_id AS pat_enc_csn_id,
    CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS msg_nm, 1 AS copies FROM events""",
)
def stream_ledger(spark, sf):
    """Every other message has no number; each delivery comes again, one in a batch with new messages, one after the nightly layout."""
    rendered = encounter_messages(spark, sf).withColumn("msg_nm", F.when(F.col("msg_nm") % 2 == 0, F.col("msg_nm")))
    tables = jobs.EncounterTables(spark, scratch_path(spark, "ledger"))
    for number, deliveries in enumerate(([1], [1, 2], [2], [3, 1], [3])):
        tables.apply(rendered.filter(F.col("batch").isin(deliveries)).drop("batch"), number)
        if number == 2:
            tables.ledger.compact(number, None, lambda df: clustered(df, ["place"], 8))
            tables.ledger.remove_compacted()
    history = tables.read("adt_hist").select("bod_id", F.col("pat_enc_csn_id").cast("long"), "msg_nm")
    return history.groupBy(*history.columns).agg(F.count("*").cast("int").alias("copies"))


@checks.add(
    "stream_dedup",
    """SELECT 'event' AS name, event_id, user_id, event_type, ts AS at, 1 AS copies FROM events
    UNION ALL SELECT 'hour', -1, -1, event_type, date_trunc('hour', ts), CAST(count(*) AS INTEGER) FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY ALL""",
)
def stream_dedup(spark, sf):
    """Events delivered twice, stopped and started three times: each once, and the closed hours' counts, with bounded state."""
    root = scratch_path(spark, "dedup")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    ends = [F.lit(f"2024-01-{d:02} 00:00:00").cast("timestamp") for d in (1, 11, 21)] + [F.lit("2999-01-01").cast("timestamp")]
    for begin, end in zip(ends, ends[1:]):
        part = events.filter((F.col("at") >= begin) & (F.col("at") < end))
        # An hour in a file, in order, and each event in two files of one batch; the last hour of a part comes again with the next.
        again = events.filter((F.col("at") >= begin - F.expr("INTERVAL 1 HOUR")) & (F.col("at") < begin))
        part.unionAll(part).unionAll(again).repartition(4).write.mode("append").parquet(f"{root}/in")
        stream = files.table_stream(spark, f"{root}/in", events.schema)
        jobs.distinct_stream(stream, ["event_id"], "at", "2 hours", f"{root}/once", f"{root}/c1").awaitTermination()
        once = files.table_stream(spark, f"{root}/once", events.schema)
        jobs.window_counts(once, ["event_type"], "at", "1 hour", "2 hours", f"{root}/hours", f"{root}/c2").awaitTermination()
    kept = spark.read.parquet(f"{root}/once").select(F.lit("event").alias("name"), "event_id", "user_id", "event_type", "at")
    one = kept.groupBy(*kept.columns).agg(F.count("*").cast("int").alias("copies"))
    none = F.lit(-1).cast("long")
    hours = spark.read.parquet(f"{root}/hours").select(
        F.lit("hour").alias("name"), none.alias("event_id"), none.alias("user_id"), "event_type", F.col("begin").alias("at"), F.col("rows").cast("int").alias("copies"),
    )
    return comparable(one.unionByName(hours))


_SHIFTED = ", ".join(
    f"{c} - INTERVAL 6 HOUR AS {c}" for c in ("msg_tm", "row_insert_tsp", "row_updt_tsp", "adt_arvl_tm", "hosp_admsn_tm", "hosp_disch_tm")
)


@checks.add(
    "mirror_changes",
    f"""SELECT pat_enc_csn_id, msg_nm, trigger_evnt, cncl_admsn_flg, {_SHIFTED} FROM ({MERGE_SQL})""",
)
def mirror_changes(spark, sf):
    """A mirror filled after two batches takes only the rows the third one changed."""
    kept = ["pat_enc_csn_id", "msg_nm", "trigger_evnt", "cncl_admsn_flg"]
    moments = ["msg_tm", "row_insert_tsp", "row_updt_tsp", "adt_arvl_tm", "hosp_admsn_tm", "hosp_disch_tm"]

    def typed(df):
        return df.select(*kept, *(F.col(c).cast("timestamp").alias(c) for c in moments))

    state, changes = cdc_checks._state(spark, sf, 1, 2), cdc_checks._changes(spark, sf, 3)
    changed = typed(change.changed_rows(state, changes, cdc_checks.FLAGGED))
    mirror = replacing_table(spark, scratch_path(spark, "mirrored"), changed.schema, ["pat_enc_csn_id"])
    jobs.mirror_changes(mirror, 2, typed(state))
    jobs.mirror_changes(mirror, 3, changed)
    return comparable(mirror.read())


EXPIRED = "SELECT user_id FROM events WHERE event_type IN ('view', 'click') AND ts + INTERVAL 363 MINUTE < TIMESTAMP '2024-01-03 00:00:00'"


_STAY = f"FROM events WHERE user_id NOT IN ({EXPIRED}) GROUP BY ALL"
_KEPT_TABLES = ("adt_hist", "adt_dtl", *CHILDREN, *(f"{n}_hist" for n in CHILDREN), "flwsht")


@checks.add(
    "stream_retention",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, user_id AS pat_enc_csn_id, {'count(*)' if n.endswith('hist') or n == 'flwsht' else '1'} AS rows {_STAY}"
        for n in _KEPT_TABLES
    )
    + " UNION ALL SELECT 'raw texts', -1, 0",
)
def stream_retention(spark, sf):
    """All deliveries, then the nightly job: who was discharged by January 2nd leaves all tables, and no raw text is left."""
    tables = jobs.EncounterTables(spark, scratch_path(spark, "retention"))
    rendered = encounter_messages(spark, sf)
    events = table(spark, sf, "events")
    sheet = events.select(
        message(
            segment("MSH", {7: digits(F.col("ts"))}), segment("PV1", {19: F.col("user_id")}), segment("OBR", {3: "520240101000000"}),
            segment("OBX", {3: "PULSE&7", 5: "60", 14: digits(F.col("ts"))}),
        ).alias("msg"), F.col("event_id").cast("string").alias("msg_nm"), F.col("ts").cast("timestamp").alias("msg_enqueued_tsp"),
    )
    tables.apply_flowsheet(sheet, 7)
    for number in (1, 2, 3):
        tables.apply(rendered.filter(F.col("batch") == number).drop("batch"), number)
    tables.retire(3, datetime.date(2024, 1, 5), files=4)
    tables.remove_compacted()
    counts = [
        tables.read(n).groupBy("pat_enc_csn_id").agg(F.count("*").alias("rows")).withColumn("name", F.lit(n))
        for n in _KEPT_TABLES
    ]
    raw = tables.staged.read(tables.staged.committed()).select("raw").unionAll(tables.rejected.read().select("msg"))
    left = raw.agg(F.count("*").alias("rows")).select(F.lit(-1).cast("decimal(18,0)").alias("pat_enc_csn_id"), "rows", F.lit("raw texts").alias("name"))
    return comparable(reduce(DataFrame.unionByName, [*counts, left]))


@checks.add("stream_append", message_checks.sql["hl7_medication"])
def stream_append(spark, sf):
    """Medication messages through a file stream into an append table."""
    root = scratch_path(spark, "append")
    rendered = medication_messages(spark, sf)
    rendered.write.parquet(f"{root}/in")
    stream = files.table_stream(spark, f"{root}/in", rendered.schema, max_files=4)
    jobs.append_stream(jobs.medication_rows(stream), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return comparable(spark.read.parquet(f"{root}/out"))


@checks.add(
    "stream_flowsheet",
    f"""SELECT *, ts_ AS row_insert_tsp, ts_ AS row_updt_tsp, 'loader' AS insert_user_id, 'loader' AS updt_user_id
    FROM (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS ts_ FROM ({_flowsheet_sql(False)}))""".replace("SELECT *, ts_ AS", "SELECT * EXCLUDE (ts_), ts_ AS"),
)
def stream_flowsheet(spark, sf):
    root = scratch_path(spark, "flowsheet")
    rendered = flowsheet_messages(spark, sf)
    rendered.write.parquet(f"{root}/in")
    stream = files.table_stream(spark, f"{root}/in", rendered.schema)
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = jobs.flowsheet_rows(stream, as_of, "loader")
    jobs.append_stream(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return comparable(spark.read.parquet(f"{root}/out"))


# In how many batches a backlog of files is taken in, however many files it has.
_BACKLOG_BATCHES = 20


@checks.add("stream_files", "SELECT event_id, user_id, event_type, props, true AS named FROM events")
def stream_files(spark, sf):
    """Text files through the binary file stream, archived when done, split into their lines."""
    root = scratch_path(spark, "files")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    lines = events.select(F.to_json(F.struct(*events.columns)).alias("value"))
    lines.write.option("maxRecordsPerFile", files.rows_per_file(events.count(), 2000, 50_000)).text(f"{root}/in")
    taken = files.per_trigger(spark, f"{root}/in", _BACKLOG_BATCHES, least=3)
    texts = files.decoded(files.binary_stream(spark, f"{root}/in", max_files=taken, archive=f"{root}/done"), with_name=True)
    jobs.append_stream(texts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    split = spark.read.parquet(f"{root}/out").select("msg_nm", F.explode(F.split("text", "\n")).alias("line"))
    row = F.from_json("line", "event_id long, user_id long, event_type string, props string")
    named = F.col("msg_nm").startswith("part-").alias("named")
    return split.filter("line <> ''").select(row.alias("e"), named).select("e.*", "named")


@checks.add("stream_archive", "SELECT event_id, true AS archived FROM events")
def stream_archive(spark, sf):
    """Every processed file is in the archive or, if of the last batch, still in its folder; none is in both."""
    root = scratch_path(spark, "archive")
    events = table(spark, sf, "events")
    size = files.rows_per_file(events.count(), 500, 250_000)
    events.select(F.col("event_id").cast("string")).write.option("maxRecordsPerFile", size).text(f"{root}/in")
    taken = files.per_trigger(spark, f"{root}/in", _BACKLOG_BATCHES)
    texts = files.decoded(files.binary_stream(spark, f"{root}/in", max_files=taken, archive=f"{root}/done"))
    jobs.append_stream(texts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    done, left = reader.text(f"{root}/done"), reader.text(f"{root}/in")
    archived = F.lit(not done.isEmpty() and spark.read.parquet(f"{root}/out").count() > 1)
    return done.unionAll(left).select(F.col("value").cast("long").alias("event_id"), archived.alias("archived"))


@checks.add("stream_timed", "SELECT event_id, user_id, ts AS msg_tm FROM events")
def stream_timed(spark, sf):
    """Batches by a clock: a trigger every second, a few files each, stopped when its input is done."""
    root = scratch_path(spark, "timed")
    rows = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("msg_tm"))
    rows.repartition(4).write.parquet(f"{root}/in")
    stream = files.table_stream(spark, f"{root}/in", rows.schema, max_files=2)
    running = jobs.append_stream(stream, f"{root}/out", f"{root}/checkpoint", every="1 second")
    running.processAllAvailable()
    running.stop()
    return comparable(spark.read.parquet(f"{root}/out"))


@checks.add(
    "stream_copy",
    "SELECT event_id, ts - INTERVAL 6 HOUR AS msg_tm FROM events",
)
def stream_copy(spark, sf):
    """Appended rows copied to a mirror, with its wall clock."""
    root = scratch_path(spark, "copy")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("msg_tm"))
    rows.write.parquet(f"{root}/in")
    mirror = DirectoryMirror(spark, f"{root}/mirror")
    stream = files.table_stream(spark, f"{root}/in", rows.schema)
    jobs.copy_stream(stream, mirror, "events", f"{root}/checkpoint", zone="US/Central").awaitTermination()
    return comparable(mirror.read("events").drop("batch_id"))


@checks.add(
    "stream_upsert",
    """SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
    FROM events) WHERE rn = 1""",
)
def stream_upsert(spark, sf):
    """Latest rows per key and the whole history from one stream; the latest come back."""
    root = scratch_path(spark, "upsert")
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    history = FoldedTable(spark, f"{root}/history", events.schema)
    latest = replacing_table(spark, f"{root}/latest", events.schema, ["user_id"])
    cut = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.filter(cut), events.filter(~cut)):
        part.write.mode("append").parquet(f"{root}/in")
        stream = files.table_stream(spark, f"{root}/in", events.schema)
        jobs.upsert_stream(stream, latest, ["user_id"], "ts", f"{root}/checkpoint", history).awaitTermination()
    return latest.read()


@checks.add("mirror_read", "SELECT event_id, user_id, ts - INTERVAL 6 HOUR AS msg_tm, value FROM events")
def mirror_read(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("msg_tm"), "value"
    )
    mirror = DirectoryMirror(spark, scratch_path(spark, "mirror"))
    mirror.write(rows, "events", "overwrite", zone="US/Central")
    return comparable(mirror.read("events"))


@checks.add("compact_cluster", f"SELECT {LINE} FROM lineitem")
def compact_cluster(spark, sf):
    """Rewritten in key ranges; a key with very many lines may span several files."""
    path = scratch_path(spark, "clustered")
    laid_out = clustered(table(spark, sf, "lineitem"), ["l_orderkey"], 8, ["l_shipdate"])
    laid_out.write.parquet(path)
    return spark.read.parquet(path)


@checks.add(
    "table_lifecycle",
    f"""SELECT {LINE} FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'
    UNION ALL SELECT {LINE} FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag <> 'R'""",
)
def table_lifecycle(spark, sf):
    """Empty, written, written again, emptied, refilled, cut down by a rewrite of itself, appended to."""
    lines = table(spark, sf, "lineitem")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    store = FoldedTable(spark, scratch_path(spark, "lifecycle"), lines.schema)
    assert store.read().isEmpty()
    store.write(0, lines)
    store.write(0, lines)
    store.compact(0, lambda df: df.filter(F.lit(False)))
    assert store.read().isEmpty()
    store.write(1, lines.filter(early))
    store.compact(1, lambda df: df.filter("l_returnflag <> 'R'"))
    store.remove_compacted()
    store.write(2, lines.filter(~early))
    return store.read()
