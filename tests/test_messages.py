"""Literal messages: where every value stands."""

import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidefold.functions import hl7, nested, times
from tidefold.plans import messages as plans

ENCOUNTER = "\n".join(
    [
        r"MSH|^~\&|SRC|FAC|||20240115093000||ADT^A03^ADT_A03|M0001|T|2.5.1",
        "EVN|A03|20240115093000|||U77^^^^^^^^^^^^^LOC1",
        "PID|1||P1001^^^X~P9999^^^Y||||19800102|F",
        "ZPD|||||||y",
        "PV1|1|INPATIENT|DEPT1^ROOM2^BED3^FAC^Ready||||||||||||||||500123|||||||||||||||||HOME||||||||20240114080000|202401150915|||||70001",
        "PV2||STD||||||||||||||||||||||||||||||||||||Car",
        "ZPV|||||||||||||||ADM",
        "OBX|1|CWE|8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED^LN||A01.1^Test finding^ICD-10-CM",
        "OBX|2|CWE|8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED^LN||B02.2^^ICD-10-CM",
        "OBX|3|TX|8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100^LN||^^^^^^^^Reason one",
        "OBX|4|CWE|11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN||2^Emergent^X",
        "OBX|5|CWE|11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER^LN||3^Urgent^X",
        "OBX|6|TX|54094-8^TRIAGE NOTE:FIND:PT:EMERGENCY DEPARTMENT:DOC^LN||first note",
        "OBX|7|TX|54094-8^TRIAGE NOTE:FIND:PT:EMERGENCY DEPARTMENT:DOC^LN||last note",
        "DG1|1|||Sample complaint||E",
    ]
)
EXPECTED = {
    "msg_typ": "ADT", "msg_src": "STL", "trigger_evnt": "A03", "bod_id": "M0001", "pat_mrn_id": "P1001",
    "pat_enc_csn_id": 500123, "death_dt": None, "pat_class_abbr": "INPATIENT", "dept_abbr": "DEPT1", "room_nm": "ROOM2",
    "bed_label": "BED3", "bed_stat": "Ready", "loc_abbr": "LOC1", "sex_abbr": "F", "means_of_arrv_abbr": "Car",
    "acuity_level_abbr": "Emergent|||Urgent", "ed_dsptn_abbr": "ADM", "disch_dsptn_abbr": "HOME", "hosp_admsn_tm": None,
    "adt_arvl_tm": None, "hsp_acct_id": 70001, "accommodation_abbr": "STD", "user_id": "U77", "pregnancy_flg": "y",
}
LOCAL = {
    "msg_tm": "2024-01-15 09:30:00-06:00",
    "birth_dt": "1980-01-02 00:00:00-06:00",
    "hosp_disch_tm": "2024-01-15 09:15:00-06:00",
}


def frame(spark, *texts):
    rows = [(t, i, datetime.datetime(2024, 1, 15, 16), "loader") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "msg string, msg_nm int, msg_enqueued_tsp timestamp, insert_user_id string")


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n"])
def test_encounter_fields(spark, end):
    parsed = plans.parse_encounter(frame(spark, ENCOUNTER.replace("\n", end)))
    assert parsed.columns == plans.ENCOUNTER_COLUMNS
    shown = parsed.withColumns({c: times.local_text(F.col(c)) for c in LOCAL}).first().asDict()
    for name, value in {**EXPECTED, **LOCAL}.items():
        assert shown[name] == value, name


@pytest.mark.parametrize("trigger, arrival, admission, discharge", [
    ("A04", True, False, False), ("A01", False, True, False), ("A11", False, True, False),
    ("A03", False, False, True), ("A13", False, False, True), ("A08", False, False, False),
])
def test_times_depend_on_the_trigger(spark, trigger, arrival, admission, discharge):
    row = plans.parse_encounter(frame(spark, ENCOUNTER.replace("ADT^A03", f"ADT^{trigger}"))).first()
    assert (row.adt_arvl_tm is not None, row.hosp_admsn_tm is not None, row.hosp_disch_tm is not None) == (
        arrival, admission, discharge,
    )


def test_children(spark):
    fanned = plans.fan_out(frame(spark, ENCOUNTER))
    assert rows(plans.children(fanned, "dx"), "pat_enc_csn_id", "dx_icd_cd", "dx_nm", "dx_cd_typ") == [
        (500123, "A01.1", "Test finding", "ICD-10-CM"),
        (500123, "B02.2", None, "ICD-10-CM"),
    ]
    assert rows(plans.children(fanned, "reasons"), "encntr_rsn") == [("Reason one",)]
    assert rows(plans.children(fanned, "complaint"), "er_complnt") == [("Sample complaint",)]
    assert rows(plans.children(fanned, "note"), "nte_txt", "nte_typ") == [("last note", "ED")]
    assert fanned.select("encounter.*").columns == plans.ENCOUNTER_COLUMNS


@pytest.mark.parametrize("kind, complaint", [("E", True), ("10800;EPT", True), ("18400;EPT", False), ("", False)])
def test_complaint_type(spark, kind, complaint):
    fanned = plans.fan_out(frame(spark, ENCOUNTER.replace("Sample complaint||E", f"Sample complaint||{kind}")))
    assert plans.children(fanned, "complaint").count() == int(complaint)


def test_message_without_observations(spark):
    bare = "\n".join(line for line in ENCOUNTER.split("\n") if not line.startswith(("OBX", "DG1")))
    fanned = plans.fan_out(frame(spark, bare))
    assert all(plans.children(fanned, k).count() == 0 for k in ("dx", "reasons", "complaint", "note"))
    assert fanned.first().encounter.acuity_level_abbr is None


def test_last_note_blank_gives_no_note(spark):
    fanned = plans.fan_out(frame(spark, ENCOUNTER.replace("last note", "")))
    assert plans.children(fanned, "note").count() == 0


def test_key_that_is_no_number(spark):
    row = plans.parse_encounter(frame(spark, ENCOUNTER.replace("500123", "50x123"))).first()
    assert row.pat_enc_csn_id is None


def test_bad_times_are_null(spark):
    row = plans.parse_encounter(frame(spark, ENCOUNTER.replace("20240115093000", "20241315093000"))).first()
    assert row.msg_tm is None
    row = plans.parse_encounter(frame(spark, ENCOUNTER.replace("202401150915", "2024011509"))).first()
    assert row.hosp_disch_tm is None


def test_validation_modes(spark):
    texts = frame(spark, "MSH|^~\\&|A\nPV1|1", "EVN|A01", None)
    permissive = plans.validate(texts)
    assert rows(permissive, "is_valid", "msg") == [(False, None), (False, None), (True, "MSH|^~\\&|A\rPV1|1")]
    assert plans.validate(texts, mode="DROP").count() == 1
    with pytest.raises(SparkRuntimeException, match="Invalid message"):
        plans.validate(texts, mode="FAILFAST").collect()


def test_envelope_round_trip(spark):
    fanned = plans.fan_out(frame(spark, ENCOUNTER))
    back = plans.from_envelope(plans.to_envelope(fanned), fanned.schema)
    assert back.first() == fanned.first()


FLOWSHEET = "\n".join(
    [
        r"MSH|^~\&|||||20240115100000||ORU^R01|M0002",
        "PID|1||P1001",
        "PV1|1||||||||||||||||||500123",
        "OBR|1||424220240115100000",
        "OBX|1|NM|PULSE&7^Pulse||72|bpm||||||||20240115095500||U77^X",
        "OBX|2|NM|TEMP^Temp||36.6|C||||||||20240115095600||U77",
    ]
)


def test_flowsheet(spark):
    parsed = plans.parse_flowsheet(frame(spark, FLOWSHEET)).withColumn("at", times.local_text(F.col("rcrd_tm")))
    columns = ("fsd_id", "flwsht_nm", "flwsht_row_num", "meas_val", "meas_typ", "at", "entry_user_id")
    assert rows(parsed, *columns) == [
        (4242, "PULSE", "7", "72", "bpm", "2024-01-15 09:55:00-06:00", "U77"),
        (4242, "TEMP", None, "36.6", "C", "2024-01-15 09:56:00-06:00", "U77"),
    ]


def test_flowsheet_with_an_unreadable_time(spark):
    texts = frame(spark, FLOWSHEET.replace("20240115095600", ""))
    assert rows(plans.parse_flowsheet(texts), "flwsht_nm") == [("PULSE",)]
    assert plans.parse_flowsheet(texts, strict=True).count() == 0


MEDICATION = "\n".join(
    [
        r"MSH|^~\&|||||20240115110000||RAS^O17|M0003",
        "PID|1||P1001^^^X",
        "PV1|1||||||||||||||||||500123",
        "ORC|OK|9001^SYS|||||^1^^20240115000000^20240120000000^R||20240115105500|U1^A||3003^B|||||||||||||||||IP",
        "RXA|||20240115105900||MED1^Drug A^Brand A^Disp A|5|mg|||U2^C|DEPT1|||||||||GIVEN",
        "RXR|PO",
    ]
)


def test_medication(spark):
    row = plans.parse_medication(frame(spark, MEDICATION), stored=False).withColumn(
        "admn_tm", F.col("admn_tm").cast("string")
    ).first().asDict()
    want = {
        "msg_typ": "RAS", "pat_mrn_id": "P1001", "pat_enc_csn_id": 500123, "ord_id": 9001, "ord_stat": "OK", "ord_qnt": "1",
        "ord_typ": "IP", "typ": "R", "ord_crtr": "U1", "ord_prvdr_id": 3003, "med_id": "MED1", "med_nm": "Drug A",
        "med_brnd_nm": "Brand A", "med_disp_nm": "Disp A", "dose": "5", "units": "mg", "admn_prvdr": "U2",
        "admn_dept": "DEPT1", "mar_actn": "GIVEN", "med_route": "PO", "admn_tm": "2024-01-15 04:59:00",
        "ord_admn": "20240115105500",
    }
    for name, value in want.items():
        assert row[name] == value, name
    assert "med_disp_nm" not in plans.parse_medication(frame(spark, MEDICATION)).columns


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_local_times_do_not_depend_on_the_session(spark, zone):
    """The repeated autumn hour reads as standard time, the skipped spring hour moves on."""
    texts = [("20241103013000",), ("20240310023000",), ("20240715093000",), ("20240102",), ("2024010209",), ("x",)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = times.parse_local(spark.createDataFrame(texts, "t string"), ["t"])
        got = [r[0] for r in df.select(F.unix_seconds("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = datetime.timezone.utc
    want = [(2024, 11, 3, 7, 30), (2024, 3, 10, 8, 30), (2024, 7, 15, 14, 30), (2024, 1, 2, 6)]
    assert got == [int(datetime.datetime(*w, tzinfo=utc).timestamp()) for w in want] + [None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_shifted_times(spark, zone):
    """14 digits that are a time, and nothing else; the wall clock is that of the zone, daylight time included."""
    good = {"20240115105959": (2024, 1, 15, 4, 59, 59), "20240715000000": (2024, 7, 14, 19), "20240229235959": (2024, 2, 29, 17, 59, 59)}
    bad = ["20230229120000", "20240115240000", "20240115106000", "20240115105960", "20241315105959", "20240100105959", "202401151059",
           "2024011510595", "202401151059590", "20240115 05959", "2024011510595 ", " 0240115105959", "+0240115105959", "-0240115105959",
           "2024011510595.", "2024.115105959", "2024011510595x", "\u0662\u0660240115105959", "", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
        got = [r[0] for r in df.select(F.unix_seconds(times.parse_shifted("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = datetime.timezone.utc
    assert got == [int(datetime.datetime(*w, tzinfo=utc).timestamp()) for w in good.values()] + [None] * len(bad)


def test_components(spark):
    """A component that a value does not have is blank, one of no value is NULL."""
    df = spark.createDataFrame([(["a^b~c^d"],), ([""],), ([None],), ([],)], "s array<string>")
    for number, want in ((1, ["a", "", None, None]), (2, ["b", "", None, None]), (3, ["", "", None, None])):
        assert [r[0] for r in df.select(hl7.raw(F.col("s"), 0, number)).collect()] == want
        assert [r[0] for r in df.select(hl7.part(F.col("s"), 0, number)).collect()] == [w or None for w in want]


def test_medication_with_missing_parts(spark):
    """Segments that are not there, or shorter than what is wanted of them, leave NULLs; of repeated segments the first counts."""
    texts = [("MSH|^~\\&|\rPV1|1\rORC|NW|7^S\rORC|XX|8^S\rRXA|||20240115105900||M1",), ("MSH|^~\\&",), ("",), (None,)]
    df = spark.createDataFrame([(t, "n", None) for (t,) in texts], "msg string, msg_nm string, msg_enqueued_tsp timestamp")
    got = [r.asDict() for r in plans.parse_medication(df).collect()]
    fixed = {"msg_typ", "msg_nm"}
    assert {k: str(v) for k, v in got[0].items() if v is not None and k not in fixed} == {
        "ord_stat": "NW", "ord_id": "7", "admn_tm": "2024-01-15 04:59:00", "med_id": "M1",
    }
    assert all(v is None for row in got[1:] for k, v in row.items() if k not in fixed)


def test_split_messages(spark):
    d = nested.MESSAGE_DELIMITER
    texts = [(f"\na\nb{d}\nc{d}",), ("alone",), (f"x{d}{d}y",)]
    df = spark.createDataFrame(texts, "t string")
    split = [r[0] for r in df.select(nested.split_messages(F.col("t"))).collect()]
    assert split == [["a\nb", "c"], ["alone"], ["x", "y"]]
    whole = [r[0] for r in df.select(nested.split_messages(F.col("t"), keep_whole=True)).collect()]
    assert whole == [[f"a\nb{d}\nc{d}"], ["alone"], [f"x{d}{d}y"]]


def test_column_lookup(spark):
    df = spark.createDataFrame([(1, 2)], "`m.hdr.id` int, `m.hdr.who.name` int")
    assert nested.column_ending(df, "name") == "m.hdr.who.name"
    assert nested.path_containing(df, "who") == "m.hdr.who"


def test_xml_schema_of_all_documents(spark):
    """What one document in 100 000 has is in the schema: an element, an attribute, a text among numbers; a broken one spoils none."""
    n = F.col("id")
    rare = F.when(n == 77_777, F.lit('<?xml version="1.0"?>\n<m><id>1</id><n>many</n><late k="v"><x>y</x></late></m>')).when(n == 5, F.lit("<m><id>2</id><n>"))
    docs = spark.range(0, 100_000, 1, 4).select(F.coalesce(rare, F.format_string("<m><id>%d</id><n>3</n></m>", n)).alias("doc"))
    flat = nested.flatten_xml(docs, "doc")
    assert set(flat.columns) == {"id", "n", "late.x", "late._k"}
    got = flat.where("n = 'many'").select("id", F.col("`late.x`"), F.col("`late._k`")).collect()
    assert [tuple(r) for r in got] == [(1, "y", "v")] and flat.where("n = '3'").count() == 99_998
