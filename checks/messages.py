"""Messages rendered from the test tables and taken apart again.

The SQL never sees a message: it gives the table columns that were rendered. Where each value
stands in a message is pinned separately by the literal messages in ``tests/test_messages.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import Checks, comparable, components, digits, message, segment, table, utc_sql
from tidefold.functions import nested
from tidefold.plans import messages as plans
from tidefold.sources.files import spread_small

checks = Checks()

TRIGGERS = {"1-URGENT": "A01", "2-HIGH": "A03", "3-MEDIUM": "A04", "4-NOT SPECIFIED": "A11", "5-LOW": "A13"}
TRIGGER = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRIGGERS.items()) + " END"


def encounter_messages(spark, sf) -> DataFrame:
    """One message per order, with its customer as the patient."""
    joined = spread_small(table(spark, sf, "orders")).join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    day = F.col("o_orderdate")
    trigger = F.expr(TRIGGER)
    text = message(
        segment("MSH", {3: "SRC", 7: digits(day), 9: components({1: "ADT", 2: trigger}),
                        10: F.concat(F.lit("M"), "o_orderkey"), 11: "T", 12: "2.5.1"}),
        segment("EVN", {1: trigger, 2: digits(day), 5: components({1: F.concat(F.lit("U"), "c_nationkey"), 14: F.concat(F.lit("LOC"), "c_nationkey")})}),
        segment("PID", {1: "1", 3: F.concat(components({1: F.col("c_name"), 4: "X"}), F.lit("~other^^^Y")),
                        7: digits(day, 8), 8: F.substring("c_mktsegment", 1, 1), 29: F.when(F.col("o_orderstatus") == "F", digits(day, 12))}),
        segment("ZPD", {7: F.when(F.col("o_orderstatus") == "P", "y").otherwise("N")}),
        segment("PV1", {1: "1", 2: F.col("c_mktsegment"),
                        3: components({1: F.concat(F.lit("D"), "c_nationkey"), 2: F.col("o_orderstatus"), 3: F.col("o_orderkey"), 5: "Ready"}),
                        19: F.col("o_orderkey"), 36: F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")),
                        44: digits(day + F.expr("INTERVAL 8 HOUR")), 45: digits(day + F.expr("INTERVAL 555 MINUTE"), 12),
                        50: F.col("o_custkey") + 70000}),
        segment("PV2", {2: "STD", 38: F.when(F.col("o_orderstatus") == "O", "Car")}),
        segment("ZPV", {15: "ADM"}),
        # Fixed value: the acuity code.
        segment("OBX", {3: "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN", 5: components({1: "2", 2: F.col("o_orderpriority")})}),
        segment("OBX", {3: "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN", 5: "7"}),
        segment("OBX", {3: "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN", 5: components({2: F.when(F.col("o_orderstatus") == "F", "Urgent")})}),
        segment("DG1", {1: "1", 4: "Sample", 6: "E"}),
    )
    return joined.select(
        text.alias("msg"), F.col("o_orderkey").alias("msg_nm"), day.cast("timestamp").alias("msg_enqueued_tsp"),
        F.lit("loader").alias("insert_user_id"), "o_orderkey", "o_orderstatus",
    )


_ARRIVAL = utc_sql("(o_orderdate + INTERVAL 8 HOUR)")
_DISCHARGE = utc_sql("(o_orderdate + INTERVAL 555 MINUTE)")
_GATED = f"""CASE WHEN {TRIGGER} = 'A04' THEN {_ARRIVAL} END AS adt_arvl_tm,
    CASE WHEN {TRIGGER} IN ('A01', 'A11') THEN {_ARRIVAL} END AS hosp_admsn_tm,
    CASE WHEN {TRIGGER} IN ('A03', 'A13') THEN {_DISCHARGE} END AS hosp_disch_tm"""
_DAY = utc_sql("o_orderdate")
ENCOUNTER_SQL = f"""SELECT 'ADT' AS msg_typ, 'STL' AS msg_src, {TRIGGER} AS trigger_evnt, {_DAY} AS msg_tm,
    o_orderkey AS msg_nm, concat('M', o_orderkey) AS bod_id, c_name AS pat_mrn_id, o_orderkey AS pat_enc_csn_id,
    {_DAY} AS birth_dt, CASE WHEN o_orderstatus = 'F' THEN {_DAY} END AS death_dt, c_mktsegment AS pat_class_abbr,
    concat('D', c_nationkey) AS dept_abbr, concat('LOC', c_nationkey) AS loc_abbr, o_orderstatus AS room_nm,
    CAST(o_orderkey AS VARCHAR) AS bed_label, 'Ready' AS bed_stat, substr(c_mktsegment, 1, 1) AS sex_abbr,
    CASE WHEN o_orderstatus = 'O' THEN 'Car' END AS means_of_arrv_abbr,
    CASE WHEN o_orderstatus = 'F' THEN concat(o_orderpriority, '|||Urgent') ELSE o_orderpriority END AS acuity_level_abbr,
    'ADM' AS ed_dsptn_abbr, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS disch_dsptn_abbr,
    o_custkey + 70000 AS hsp_acct_id, 'STD' AS accommodation_abbr, concat('U', c_nationkey) AS user_id,
    'loader' AS insert_user_id, o_orderdate AS msg_enqueued_tsp, CASE WHEN o_orderstatus = 'P' THEN 'y' END AS pregnancy_flg,
    {_GATED} FROM orders JOIN customer ON o_custkey = c_custkey"""


@checks.add("hl7_encounter", ENCOUNTER_SQL)
def encounter(spark, sf):
    return comparable(plans.parse_encounter(encounter_messages(spark, sf)))


@checks.add("hl7_gated_times", f"SELECT o_orderkey AS msg_nm, {_GATED} FROM orders")
def gated_times(spark, sf):
    parsed = plans.parse_encounter(encounter_messages(spark, sf))
    return comparable(parsed.select("msg_nm", "adt_arvl_tm", "hosp_admsn_tm", "hosp_disch_tm"))


@checks.add(
    "hl7_validate",
    """SELECT o_orderkey, o_orderstatus <> 'P' AS is_valid, CASE WHEN o_orderstatus <> 'P' THEN
    concat_ws(chr(13), 'MSH|^~\\&|S', concat('PV1|', o_orderkey)) END AS msg FROM orders""",
)
def validate(spark, sf):
    """Messages with line feeds, and texts that only look like messages."""
    head = F.when(F.col("o_orderstatus") == "P", "EVN|").when(F.col("o_orderstatus") == "O", " MSH|^~\\&|S")
    texts = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.coalesce(head, F.lit("MSH|^~\\&|S")), F.lit("\nPV1|"), "o_orderkey").alias("msg")
    )
    return plans.validate(texts)


def clinical_messages(spark, sf) -> DataFrame:
    """One message per order line with observations of every kind."""
    lines = spread_small(table(spark, sf, "lineitem"))
    # Observation codes of the message format.
    chief = "8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED"
    note = "54094-8^TRIAGE NOTE:FIND:PT:EMERGENCY DEPARTMENT:DOC^LN"
    returned = F.col("l_returnflag") == "R"
    text = message(
        segment("MSH", {7: digits(F.col("l_shipdate")), 9: "ADT^A04"}),
        segment("PV1", {19: F.col("l_orderkey")}),
        segment("OBX", {3: f"{chief}^LN", 5: components({1: F.col("l_partkey"), 2: F.col("l_returnflag"), 3: "ICD-10-CM"})}),
        segment("OBX", {3: f"{chief}^LN", 5: components({1: F.when(returned, F.col("l_suppkey")), 9: "no code"})}),
        segment("OBX", {3: f"{chief}:18100^LN", 5: components({9: F.concat(F.lit("reason "), "l_linenumber")})}),
        segment("OBX", {3: f"{chief}:18100^LN", 5: components({9: F.when(returned, F.lit("returned"))})}),
        segment("OBX", {3: "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN", 5: components({2: F.col("l_returnflag")})}),
        segment("OBX", {3: "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN", 5: components({2: F.when(returned, F.col("l_linestatus"))})}),
        segment("OBX", {3: note, 5: "first note"}),
        segment("OBX", {3: note, 5: F.when(~returned, F.concat(F.lit("note on "), "l_partkey"))}),
        segment("DG1", {4: F.concat(F.lit("complaint "), "l_suppkey"),
                        6: F.when(F.col("l_linestatus") == "O", "E").when(returned, "10800;EPT").otherwise("18400;EPT")}),
    )
    return lines.select(
        text.alias("msg"), F.monotonically_increasing_id().cast("string").alias("msg_nm"),
        F.col("l_shipdate").cast("timestamp").alias("msg_enqueued_tsp"), F.lit("loader").alias("insert_user_id"),
    )


_SHIPPED = utc_sql("l_shipdate")
_HEAD = f"""'STL' AS msg_src, {_SHIPPED} AS msg_tm, l_orderkey AS pat_enc_csn_id, 'loader' AS insert_user_id,
    l_shipdate AS msg_enqueued_tsp"""
_DX = f"""SELECT {_HEAD}, CAST(l_partkey AS VARCHAR) AS dx_icd_cd, l_returnflag AS dx_nm, 'ICD-10-CM' AS dx_cd_typ FROM lineitem
    UNION ALL SELECT {_HEAD}, CAST(l_suppkey AS VARCHAR), NULL, NULL FROM lineitem WHERE l_returnflag = 'R'"""
_REASON = f"""SELECT {_HEAD}, concat('reason ', l_linenumber) AS encntr_rsn FROM lineitem
    UNION ALL SELECT {_HEAD}, 'returned' FROM lineitem WHERE l_returnflag = 'R'"""
_COMPLAINT = f"""SELECT {_HEAD}, concat('complaint ', l_suppkey) AS er_complnt FROM lineitem
    WHERE l_linestatus = 'O' OR l_returnflag = 'R'"""
_NOTE = f"""SELECT {_HEAD}, concat('note on ', l_partkey) AS nte_txt, 'ED' AS nte_typ FROM lineitem WHERE l_returnflag <> 'R'"""


def _child(name: str, kind: str, sql: str) -> None:
    @checks.add(name, sql)
    def query(spark, sf):
        return comparable(plans.children(plans.fan_out(clinical_messages(spark, sf)), kind))


_child("hl7_explode_obs", "dx", _DX)
_child("hl7_visit_reasons", "reasons", _REASON)
_child("hl7_conditional_child", "complaint", _COMPLAINT)
_child("hl7_last_obs", "note", _NOTE)


@checks.add(
    "hl7_repeat_join",
    """SELECT l_orderkey AS pat_enc_csn_id, CASE WHEN l_returnflag = 'R' THEN concat(l_returnflag, '|||', l_linestatus)
    ELSE l_returnflag END AS acuity_level_abbr FROM lineitem""",
)
def repeat_join(spark, sf):
    parsed = plans.parse_encounter(clinical_messages(spark, sf))
    return parsed.select("pat_enc_csn_id", "acuity_level_abbr")


def _counts(fanned: DataFrame) -> DataFrame:
    return fanned.select(
        F.col("encounter.pat_enc_csn_id").alias("pat_enc_csn_id"), F.size("dx").cast("long").alias("n_dx"),
        F.size("reasons").cast("long").alias("n_reasons"), F.col("complaint.er_complnt").alias("er_complnt"),
        F.col("note.nte_txt").alias("nte_txt"),
    )


_FAN_OUT = """SELECT l_orderkey AS pat_enc_csn_id, CAST(1 + CAST(l_returnflag = 'R' AS INTEGER) AS BIGINT) AS n_dx,
    CAST(1 + CAST(l_returnflag = 'R' AS INTEGER) AS BIGINT) AS n_reasons,
    CASE WHEN l_linestatus = 'O' OR l_returnflag = 'R' THEN concat('complaint ', l_suppkey) END AS er_complnt,
    CASE WHEN l_returnflag <> 'R' THEN concat('note on ', l_partkey) END AS nte_txt FROM lineitem"""


@checks.add("hl7_fanout", _FAN_OUT)
def fan_out(spark, sf):
    return _counts(plans.fan_out(clinical_messages(spark, sf)))


@checks.add("envelope_decode", _FAN_OUT)
def envelope_decode(spark, sf):
    """The five parts through JSON text and back."""
    fanned = plans.fan_out(clinical_messages(spark, sf))
    return _counts(plans.from_envelope(plans.to_envelope(fanned), fanned.schema))


@checks.add(
    "envelope_variant",
    """SELECT event_id, CASE WHEN event_id % 10 <> 5 THEN CAST(user_id AS VARCHAR) END AS user_id, event_type AS kind,
    CASE WHEN event_id % 3 = 0 THEN 'added' END AS extra, CAST(event_id % 2 AS VARCHAR) AS second, 'read' AS status FROM events WHERE event_id % 10 NOT IN (3, 4, 6)
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, 'rejected' FROM events WHERE event_id % 10 IN (3, 4, 6)""",
)
def envelope_variant(spark, sf):
    """Envelopes of no fixed shape: fields that come and go, a number that is a text, lists, cut-off JSON, JSON that is no object."""
    kind = F.col("event_id") % 10
    extra = F.when(F.col("event_id") % 3 == 0, F.lit(',"more":{"extra":"added"}')).otherwise("")
    user = F.when(kind == 5, F.lit('"none"')).otherwise(F.col("user_id").cast("string"))
    whole = F.concat(
        F.lit('{"head":{"user":'), user, F.lit(',"kind":"'), F.col("event_type"), F.lit('"},"list":[7,'), (F.col("event_id") % 2).cast("string"), F.lit("]"), extra, F.lit("}"),
    )
    text = F.when(kind == 3, F.expr("left(whole, length(whole) - 1)")).when(kind == 4, "[1, 2]").when(kind == 6, F.lit(None)).otherwise(F.col("whole"))
    sent = table(spark, sf, "events").select("event_id", whole.alias("whole"), "user_id", "event_type").select("event_id", text.alias("message_content"))
    opened = plans.open_envelope(sent)
    paths = {"user_id": ("$.head.user", "long"), "kind": ("$.head.kind", "string"), "extra": ("$.more.extra", "string"), "second": ("$.list[1]", "long")}
    read = plans.envelope_parts(opened, paths).withColumns({"status": F.lit("read"), **{c: F.col(c).cast("string") for c in ("user_id", "second")}})
    left = plans.envelope_rejected(opened).select("event_id", F.lit("rejected").alias("status"))
    return read.unionByName(left, allowMissingColumns=True)


def flowsheet_messages(spark, sf) -> DataFrame:
    """One message per event with two measurements; purchases leave the second one's time out."""
    events = spread_small(table(spark, sf, "events"))
    text = message(
        segment("MSH", {7: digits(F.col("ts")), 9: "ORU^R01"}),
        segment("PID", {3: F.concat(F.lit("P"), "user_id")}),
        segment("PV1", {19: F.col("user_id")}),
        segment("OBR", {3: F.concat("event_id", digits(F.col("ts")))}),
        segment("OBX", {3: F.concat("event_type", F.lit("&"), "user_id", F.lit("^x")), 5: F.col("value"), 6: "bpm",
                        14: digits(F.col("ts")), 16: F.concat(F.lit("U"), "user_id", F.lit("^X"))}),
        segment("OBX", {3: "TEMP^Temp", 5: F.col("props"), 14: F.when(F.col("event_type") != "purchase", digits(F.col("ts"), 12))}),
    )
    return events.select(text.alias("msg"), F.col("event_id").cast("string").alias("msg_nm"), F.col("ts").cast("timestamp").alias("msg_enqueued_tsp"))


def _flowsheet_sql(strict: bool) -> str:
    head = """'ORU' AS msg_typ, date_trunc('second', ts) + INTERVAL 6 HOUR AS msg_tm, concat('P', user_id) AS pat_mrn_id,
        user_id AS pat_enc_csn_id, event_id AS fsd_id"""
    only = "WHERE event_type <> 'purchase'"
    return f"""SELECT {head}, event_type AS flwsht_nm, CAST(user_id AS VARCHAR) AS flwsht_row_num, CAST(value AS VARCHAR) AS meas_val,
        'bpm' AS meas_typ, date_trunc('second', ts) + INTERVAL 6 HOUR AS rcrd_tm, concat('U', user_id) AS entry_user_id,
        CAST(event_id AS VARCHAR) AS msg_nm, ts AS msg_enqueued_tsp FROM events {only if strict else ""}
    UNION ALL SELECT {head}, 'TEMP', NULL, props, NULL, date_trunc('minute', ts) + INTERVAL 6 HOUR, NULL,
        CAST(event_id AS VARCHAR), ts FROM events {only}"""


@checks.add("hl7_flowsheet", _flowsheet_sql(False))
def flowsheet(spark, sf):
    return comparable(plans.parse_flowsheet(flowsheet_messages(spark, sf)))


@checks.add("hl7_flowsheet_strict", _flowsheet_sql(True))
def flowsheet_strict(spark, sf):
    return comparable(plans.parse_flowsheet(flowsheet_messages(spark, sf), strict=True))


def medication_messages(spark, sf) -> DataFrame:
    """One message per order line with its part as the medication."""
    joined = spread_small(table(spark, sf, "lineitem")).join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    # The digits are a column of the row, so that they are written once and not for each field that has them.
    noon = digits(F.col("l_shipdate") + F.expr("INTERVAL 12 HOUR"))
    joined, day = joined.withColumn("noon", noon), F.col("noon")
    text = message(
        segment("MSH", {7: day, 9: "RAS^O17"}),
        segment("PID", {3: F.concat(F.lit("P"), "l_suppkey", F.lit("^^^X"))}),
        segment("PV1", {19: F.col("l_orderkey")}),
        segment("ORC", {1: F.col("l_linestatus"), 2: F.concat("l_orderkey", F.lit("^SYS")),
                        7: components({2: F.col("l_quantity"), 4: day, 5: F.substring(day, 1, 12), 6: F.col("l_returnflag")}), 9: day,
                        10: "U1^A", 12: F.concat("l_suppkey", F.lit("^B")), 29: "IP"}),
        segment("RXA", {3: day, 5: components({1: F.col("p_partkey"), 2: F.col("p_name"), 3: F.col("p_brand"), 4: F.col("p_type")}),
                        6: F.col("p_size"), 7: "mg", 10: "U2^C", 11: "DEPT1", 20: "GIVEN"}),
        segment("RXR", {1: "PO"}),
    )
    return joined.select(text.alias("msg"), F.lit("1-2").alias("msg_nm"), F.col("l_shipdate").cast("timestamp").alias("msg_enqueued_tsp"))


# Noon UTC is 6 or 7 in the morning there, so the day's own daylight rule applies.
_LOCAL_NOON = f"(l_shipdate + INTERVAL 12 HOUR - ({utc_sql('(l_shipdate + INTERVAL 6 HOUR)')} - (l_shipdate + INTERVAL 6 HOUR)))"


@checks.add(
    "hl7_medication",
    f"""SELECT {_LOCAL_NOON} AS msg_tm, 'RAS' AS msg_typ, concat('P', l_suppkey) AS pat_mrn_id, l_orderkey AS pat_enc_csn_id,
    l_orderkey AS ord_id, l_linestatus AS ord_stat, CAST(l_quantity AS VARCHAR) AS ord_qnt, {_LOCAL_NOON} AS ord_strt_tm,
    CAST(NULL AS TIMESTAMP) AS ord_end_tm, l_returnflag AS typ, 'U1' AS ord_crtr, l_suppkey AS ord_prvdr_id, 'IP' AS ord_typ,
    {_LOCAL_NOON} AS admn_tm, CAST(p_partkey AS VARCHAR) AS med_id, p_name AS med_nm, p_brand AS med_brnd_nm,
    CAST(p_size AS VARCHAR) AS dose, 'mg' AS units, 'U2' AS admn_prvdr, 'DEPT1' AS admn_dept, 'GIVEN' AS mar_actn,
    'PO' AS med_route, '1-2' AS msg_nm, l_shipdate AS msg_enqueued_tsp FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def medication(spark, sf):
    return comparable(plans.parse_medication(medication_messages(spark, sf)))


@checks.add(
    "split_messages",
    """SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''""",
)
def split_messages(spark, sf):
    """Every document as a file whose lines are the messages."""
    joined = F.regexp_replace("text", "\n", "\n" + nested.MESSAGE_DELIMITER.replace("$", "\\$") + "\n")
    files = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("\n"), joined).alias("file"))
    # The line feed before a delimiter stays with the message, as it does in a file.
    pieces = files.select("doc_id", F.explode(nested.split_messages(F.col("file"))).alias("piece"))
    lines = pieces.select("doc_id", F.regexp_replace("piece", "\n$", "").alias("line"))
    return lines.filter("line <> ''")


ORDER_XML = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("hdr", T.StructType([T.StructField("status", T.StringType()), T.StructField("who", T.LongType())])),
        T.StructField("obs", T.ArrayType(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))),
        T.StructField("tag", T.ArrayType(T.StringType())),
    ]
)


@checks.add(
    "flatten_nested",
    """SELECT o_orderkey AS id, o_orderstatus AS "hdr.status", o_custkey AS "hdr.who", o_orderpriority AS "obs.a",
    o_orderstatus AS "obs.b", 'last' AS tag FROM orders""",
)
def flatten_nested(spark, sf):
    """Of repeated elements the last one that has the value counts."""
    return nested.flatten_xml(_xml_orders(spark, sf), "doc", ORDER_XML)


def _xml_orders(spark, sf) -> DataFrame:
    xml = F.format_string(
        "<m><id>%d</id><hdr><status>%s</status><who>%d</who></hdr><obs><a>x</a><b>%s</b></obs>"
        "<obs><a>%s</a></obs><tag>first</tag><tag>last</tag></m>",
        "o_orderkey", "o_orderstatus", "o_custkey", "o_orderstatus", "o_orderpriority",
    )
    return table(spark, sf, "orders").select(xml.alias("doc"))


@checks.add("flatten_inferred", checks.sql["flatten_nested"])
def flatten_inferred(spark, sf):
    """The same documents without a schema given: it is read off a sample of them."""
    return nested.flatten_xml(_xml_orders(spark, sf), "doc")


@checks.add("column_lookup", "SELECT event_id, value AS amount, event_type AS kind FROM events")
def column_lookup(spark, sf):
    """Columns of a flattened document found by the end of their path and by a part of it."""
    events = table(spark, sf, "events")
    body = F.struct(F.struct(F.col("value").alias("amount")).alias("paid"), F.struct(F.col("event_type").alias("kindOf")).alias("what"))
    flat = nested.flatten_struct(events.select("event_id", body.alias("doc")), "doc")
    amount, kind = nested.column_ending(flat, "amount"), nested.path_containing(flat, "kindOf")
    return flat.select("event_id", F.col(f"`{amount}`").alias("amount"), F.col(f"`{kind}`").alias("kind"))
