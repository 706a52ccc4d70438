"""Encounter, flowsheet and medication messages as tables.

Every parser takes a frame with one message per row and adds columns; nothing leaves the
JVM. The message text may come with other columns, which stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions import hl7, times

# The source name that all encounter rows carry.
SOURCE = "STL"


@dataclass(frozen=True)
class FieldRule:
    """Output column taken from one field, or one component of it."""

    column: str
    segment: str
    number: int
    component: int | None = None
    kind: str = "text"


# Where the encounter columns stand in a message.
ENCOUNTER_FIELDS = (
    FieldRule("msg_typ", "MSH", 9, 1),
    FieldRule("trigger_evnt", "MSH", 9, 2),
    FieldRule("msg_tm", "MSH", 7, kind="time"),
    FieldRule("bod_id", "MSH", 10),
    FieldRule("pat_mrn_id", "PID", 3, 1),
    FieldRule("pat_enc_csn_id", "PV1", 19, kind="number"),
    FieldRule("birth_dt", "PID", 7, kind="time"),
    FieldRule("death_dt", "PID", 29, kind="time"),
    FieldRule("pat_class_abbr", "PV1", 2),
    FieldRule("dept_abbr", "PV1", 3, 1),
    FieldRule("loc_abbr", "EVN", 5, 14),
    FieldRule("room_nm", "PV1", 3, 2),
    FieldRule("bed_label", "PV1", 3, 3),
    FieldRule("bed_stat", "PV1", 3, 5),
    FieldRule("sex_abbr", "PID", 8),
    FieldRule("means_of_arrv_abbr", "PV2", 38),
    FieldRule("ed_dsptn_abbr", "ZPV", 15),
    FieldRule("disch_dsptn_abbr", "PV1", 36),
    FieldRule("hsp_acct_id", "PV1", 50, kind="number"),
    FieldRule("accommodation_abbr", "PV2", 2),
    FieldRule("user_id", "EVN", 5, 1),
)
# Times that count only on certain triggers.
GATED_TIMES = {
    "adt_arvl_tm": (44, ("A04",)),
    "hosp_admsn_tm": (44, ("A01", "A11")),
    "hosp_disch_tm": (45, ("A03", "A13")),
}
# Observation codes and the markers around them.
CHIEF_COMPLAINT = "8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED"
VISIT_REASON = "8661-1^CHIEF COMPLAINT:FIND:PT:PATIENT:NOM:REPORTED:18100"
ACUITY = "11283-9^ACUITY ASSESSMENT AT FIRST ENCOUNTER"
ACUITY_DELIMITER = "|||"
TRIAGE_NOTE = "54094-8^TRIAGE NOTE:FIND:PT:EMERGENCY DEPARTMENT:DOC^LN"
TRIAGE_NOTE_TYPE = "ED"
ER_COMPLAINT_TYPES = ("10800;EPT", "E")
# Order of the encounter columns on the wire.
ENCOUNTER_COLUMNS = (
    "msg_typ msg_src trigger_evnt msg_tm msg_nm bod_id pat_mrn_id pat_enc_csn_id birth_dt death_dt "
    "pat_class_abbr hosp_admsn_tm hosp_disch_tm dept_abbr loc_abbr room_nm bed_label bed_stat "
    "sex_abbr means_of_arrv_abbr acuity_level_abbr ed_dsptn_abbr disch_dsptn_abbr adt_arvl_tm "
    "hsp_acct_id accommodation_abbr user_id insert_user_id msg_enqueued_tsp pregnancy_flg"
).split()
# Columns that come with the message and not from it.
CARRIED = ("msg_nm", "insert_user_id", "msg_enqueued_tsp")
PARTS = ("encounter", "dx", "complaint", "reasons", "note")
ENCOUNTER_SEGMENTS = ["MSH", "EVN", "PID", "ZPD", "PV1", "PV2", "ZPV", "DG1"]

# Where the medication columns stand in a message.
MEDICATION_FIELDS = (
    FieldRule("msg_tm", "MSH", 7, kind="shifted"),
    FieldRule("pat_mrn_id", "PID", 3, 1),
    FieldRule("pat_enc_csn_id", "PV1", 19, kind="number"),
    FieldRule("ord_id", "ORC", 2, 1, "number"),
    FieldRule("ord_stat", "ORC", 1),
    FieldRule("ord_admn", "ORC", 9),
    FieldRule("ord_qnt", "ORC", 7, 2),
    FieldRule("ord_strt_tm", "ORC", 7, 4, "shifted"),
    FieldRule("ord_end_tm", "ORC", 7, 5, "shifted"),
    FieldRule("typ", "ORC", 7, 6),
    FieldRule("ord_crtr", "ORC", 10, 1),
    FieldRule("ord_prvdr_id", "ORC", 12, 1, "number"),
    FieldRule("ord_typ", "ORC", 29),
    FieldRule("admn_tm", "RXA", 3, kind="shifted"),
    FieldRule("med_id", "RXA", 5, 1),
    FieldRule("med_nm", "RXA", 5, 2),
    FieldRule("med_brnd_nm", "RXA", 5, 3),
    FieldRule("med_disp_nm", "RXA", 5, 4),
    FieldRule("dose", "RXA", 6),
    FieldRule("units", "RXA", 7),
    FieldRule("admn_prvdr", "RXA", 10, 1),
    FieldRule("admn_dept", "RXA", 11),
    FieldRule("mar_actn", "RXA", 20),
    FieldRule("med_route", "RXR", 1),
)
MEDICATION_TYPE = "RAS"
MEDICATION_NOT_STORED = ("ord_admn", "med_disp_nm")
FLOWSHEET_TYPE = "ORU"


def _texts(rules: tuple[FieldRule, ...], unsplit: bool = False) -> dict[str, Column]:
    def segment(name: str) -> Column:
        found = F.col(f"_{name.lower()}")
        return hl7.fields(found) if unsplit else found

    return {r.column: hl7.part(segment(r.segment), r.number, r.component, r.segment) for r in rules}


def validate(df: DataFrame, msg: str = "msg", mode: str = "PERMISSIVE") -> DataFrame:
    """Mark (PERMISSIVE), leave out (DROP) or fail on (FAILFAST) texts that are no message.

    The message column comes out normalised; what is no message becomes NULL.
    """
    valid = hl7.is_message(F.col(msg))
    if mode == "FAILFAST":
        checked = F.when(valid, F.col(msg)).otherwise(F.raise_error(F.lit("Invalid message")))
        return df.withColumn(msg, hl7.normalise(checked.cast("string")))
    if mode == "DROP":
        return df.filter(valid).withColumn(msg, hl7.normalise(F.col(msg)))
    return df.withColumn("is_valid", valid).withColumn(msg, hl7.normalise(F.col(msg)))


def _encounter_columns(
    df: DataFrame, msg: str, segments: list[str], source: str, zone: str
) -> DataFrame:
    """The message taken apart: segment columns and all encounter columns side by side."""
    df = df.drop(*(c for c in ENCOUNTER_COLUMNS if c in df.columns and c not in CARRIED))
    apart = hl7.with_segments(df, msg, segments)
    values = hl7.observed_values(hl7.observations(F.col("_segs"), ACUITY))
    acuities = F.filter(F.transform(values, lambda v: F.get(v, F.lit(1))), lambda a: a != "")
    texts = apart.withColumns(
        {
            **_texts(ENCOUNTER_FIELDS),
            **{name: hl7.part(F.col("_pv1"), number) for name, (number, _) in GATED_TIMES.items()},
            "acuity_level_abbr": hl7.blank_to_null(F.array_join(acuities, ACUITY_DELIMITER)),
            "pregnancy_flg": hl7.part(F.col("_zpd"), 7),
            "msg_src": F.lit(source),
        }
    )
    typed = texts.withColumns(
        {
            **{r.column: F.col(r.column).try_cast("long") for r in ENCOUNTER_FIELDS if r.kind == "number"},
            **{n: F.when(F.col("trigger_evnt").isin(*on), F.col(n)) for n, (_, on) in GATED_TIMES.items()},
            "pregnancy_flg": F.when(F.upper("pregnancy_flg") == "Y", F.col("pregnancy_flg")),
        }
    )
    local = [r.column for r in ENCOUNTER_FIELDS if r.kind == "time"]
    return times.parse_local(typed, [*local, *GATED_TIMES], zone)


def _diagnoses(segs: Column) -> Column:
    def row(v: Column) -> Column:
        return F.struct(
            *(hl7.blank_to_null(F.get(v, F.lit(i))).alias(c) for i, c in enumerate(("dx_icd_cd", "dx_nm", "dx_cd_typ")))
        )

    rows = F.transform(hl7.observed_values(hl7.observations(segs, CHIEF_COMPLAINT)), row)
    return F.filter(
        rows, lambda r: F.coalesce(r["dx_icd_cd"], r["dx_nm"], r["dx_cd_typ"]).isNotNull()
    )


def _reasons(segs: Column) -> Column:
    values = hl7.observed_values(hl7.observations(segs, VISIT_REASON))
    reasons = F.filter(F.transform(values, lambda v: F.get(v, F.lit(8))), lambda r: r != "")
    return F.transform(reasons, lambda r: F.struct(r.alias("encntr_rsn")))


def _complaint(dg1: Column, types: Sequence[str]) -> Column:
    wanted = hl7.raw(dg1, 6).isin(*types) & (hl7.raw(dg1, 4) != "")
    return F.when(wanted, F.struct(hl7.raw(dg1, 4).alias("er_complnt")))


def _note(segs: Column) -> Column:
    last = F.try_element_at(hl7.observations(segs, TRIAGE_NOTE, whole=True), F.lit(-1))
    return hl7.part(hl7.fields(last), 5)


def fan_out(
    df: DataFrame,
    msg: str = "msg",
    source: str = SOURCE,
    zone: str = times.LOCAL_ZONE,
    carry: Sequence[str] = (),
    complaint_types: Sequence[str] = ER_COMPLAINT_TYPES,
) -> DataFrame:
    """One pass over each message: five nested columns, and the columns ``carry`` as they are.
    ``complaint_types`` are the diagnosis types that count as a complaint.

    ``encounter`` struct, ``dx`` and ``reasons`` arrays, ``complaint`` and ``note`` structs that
    are NULL when the message has none. ``msg_nm``, ``insert_user_id`` and
    ``msg_enqueued_tsp`` are taken over from the frame.
    """
    apart = _encounter_columns(df, msg, ENCOUNTER_SEGMENTS, source, zone)
    noted = apart.withColumn("_note", _note(F.col("_segs")))
    note = F.struct(F.col("_note").alias("nte_txt"), F.lit(TRIAGE_NOTE_TYPE).alias("nte_typ"))
    return noted.select(
        F.struct(*ENCOUNTER_COLUMNS).alias("encounter"),
        _diagnoses(F.col("_segs")).alias("dx"),
        _complaint(F.col("_dg1"), complaint_types).alias("complaint"),
        _reasons(F.col("_segs")).alias("reasons"),
        F.when(F.col("_note").isNotNull(), note).alias("note"),
        *carry,
    )


def staged_schema(spark: SparkSession, carry: Sequence[str]) -> T.StructType:
    """Schema of ``fan_out`` over validated batches, with ``carry`` and the insert time."""
    kinds = "msg string, msg_nm string, msg_enqueued_tsp timestamp, insert_user_id string, raw string, place long, name binary"
    empty = spark.createDataFrame([], kinds)
    return fan_out(validate(empty), carry=carry).withColumn("row_insert_tsp", F.current_timestamp()).schema


def parse_encounter(
    df: DataFrame, msg: str = "msg", source: str = SOURCE, zone: str = times.LOCAL_ZONE
) -> DataFrame:
    """Encounter rows alone, without taking apart what only the children need."""
    segments = [s for s in ENCOUNTER_SEGMENTS if s != "DG1"]
    return _encounter_columns(df, msg, segments, source, zone).select(*ENCOUNTER_COLUMNS)


def encounters(fanned: DataFrame) -> DataFrame:
    return fanned.select("encounter.*")


def children(fanned: DataFrame, kind: str) -> DataFrame:
    """The rows of one child table: ``dx``, ``reasons``, ``complaint`` or ``note``.

    Messages without such rows give none. Columns beside the five parts are repeated.
    """
    rest = [c for c in fanned.columns if c not in PARTS]
    head = [
        F.col(f"encounter.{c}").alias(c)
        for c in ("msg_src", "msg_tm", "pat_enc_csn_id", "insert_user_id", "msg_enqueued_tsp")
    ]
    if kind in ("dx", "reasons"):
        rows = fanned.select(*head, *rest, F.explode(kind).alias("_row"))
    else:
        rows = fanned.filter(F.col(kind).isNotNull()).select(*head, *rest, F.col(kind).alias("_row"))
    payload = rows.schema["_row"].dataType.fieldNames()
    return rows.select(
        "msg_src", "msg_tm", "pat_enc_csn_id", *(f"_row.{c}" for c in payload),
        "insert_user_id", "msg_enqueued_tsp", *rest,
    )


# Which part of the fan-out feeds which child table.
CHILD_PARTS = {
    "encntr_dx": "dx",
    "encntr_er_complnt": "complaint",
    "encntr_visit_rsn": "reasons",
    "encntr_nte": "note",
}


def to_envelope(fanned: DataFrame, name: str = "message_content") -> DataFrame:
    """All five parts as one JSON text, for queues that carry text."""
    return fanned.select(F.to_json(F.struct(*fanned.columns)).alias(name))


def from_envelope(df: DataFrame, schema, name: str = "message_content") -> DataFrame:
    """The five parts back from JSON; ``schema`` is the fan-out's."""
    return df.select(F.from_json(name, schema).alias("_e")).select("_e.*")


def open_envelope(df: DataFrame, name: str = "message_content") -> DataFrame:
    """``_envelope``: the envelope as a variant, whatever its shape; NULL if it is no JSON object."""
    read = F.try_parse_json(name)
    return df.withColumn("_envelope", F.when(F.startswith(F.schema_of_variant(read), F.lit("OBJECT")), read))


def envelope_parts(opened: DataFrame, paths: Mapping[str, tuple[str, str]], name: str = "message_content") -> DataFrame:
    """Named values of readable envelopes, as name -> (path, type); NULL where the path is missing or its value does not fit
    the type. The other columns stay, the envelope itself goes."""
    sound = opened.filter(F.col("_envelope").isNotNull())
    picked = {c: F.try_variant_get("_envelope", path, kind) for c, (path, kind) in paths.items()}
    return sound.select(*(c for c in opened.columns if c not in ("_envelope", name)), *(v.alias(c) for c, v in picked.items()))


def envelope_rejected(opened: DataFrame) -> DataFrame:
    """Envelopes that are no JSON object, for quarantine."""
    return opened.filter(F.col("_envelope").isNull()).drop("_envelope")


def parse_flowsheet(
    df: DataFrame, msg: str = "msg", strict: bool = False, zone: str = times.LOCAL_ZONE
) -> DataFrame:
    """One row per observation. Observations without a readable time are left out; with
    ``strict`` one of them discards its whole message."""
    rest = [c for c in df.columns if c != msg]
    apart = hl7.with_segments(df, msg, ["MSH", "PID", "PV1", "OBR"])
    heads = apart.select(
        F.lit(FLOWSHEET_TYPE).alias("msg_typ"),
        hl7.part(F.col("_msh"), 7, None, "MSH").alias("msg_tm"),
        hl7.part(F.col("_pid"), 3, 1).alias("pat_mrn_id"),
        hl7.part(F.col("_pv1"), 19).alias("pat_enc_csn_id"),
        hl7.part(F.col("_obr"), 3).alias("fsd_id"),
        F.transform(hl7.named(F.col("_segs"), "OBX"), hl7.fields).alias("_obx"),
        *rest,
    )
    if strict:
        recorded = heads.withColumn("_times", F.transform("_obx", lambda o: hl7.raw(o, 14)))
        heads = recorded.filter(f"forall(_times, t -> {times.instant_sql('t', zone)} IS NOT NULL)").drop("_times")
    rows = heads.withColumn("_obx", F.explode("_obx")).withColumns(
        {
            "pat_enc_csn_id": F.col("pat_enc_csn_id").try_cast("long"),
            # The order number ends with a 14-digit time.
            "fsd_id": F.expr("substring(fsd_id, 1, length(fsd_id) - 14)").try_cast("long"),
            "_code": hl7.raw(F.col("_obx"), 3, 1),
            "meas_val": hl7.part(F.col("_obx"), 5),
            "meas_typ": hl7.part(F.col("_obx"), 6),
            "rcrd_tm": hl7.part(F.col("_obx"), 14),
            "entry_user_id": hl7.part(F.col("_obx"), 16, 1),
        }
    )
    named = rows.withColumns(
        {
            "flwsht_nm": hl7.blank_to_null(F.substring_index("_code", hl7.SUBCOMPONENT, 1)),
            "flwsht_row_num": hl7.blank_to_null(F.regexp_extract("_code", "&(.*)$", 1)),
        }
    )
    timed = times.parse_local(named, ["msg_tm", "rcrd_tm"], zone).filter(F.col("rcrd_tm").isNotNull())
    return timed.select(
        "msg_typ", "msg_tm", "pat_mrn_id", "pat_enc_csn_id", "fsd_id", "flwsht_nm",
        "flwsht_row_num", "meas_val", "meas_typ", "rcrd_tm", "entry_user_id", *rest,
    )


def parse_medication(df: DataFrame, msg: str = "msg", stored: bool = True) -> DataFrame:
    """Medication administrations; with ``stored`` in the stored columns only."""
    rest = [c for c in df.columns if c != msg]
    apart = hl7.with_segments(df, msg, ["MSH", "PID", "PV1", "ORC", "RXA", "RXR"], unsplit=True)
    texts = apart.select(*(c.alias(n) for n, c in _texts(MEDICATION_FIELDS, unsplit=True).items()), *rest)
    convert = {"shifted": times.parse_shifted, "number": lambda c: F.col(c).try_cast("long")}
    columns = [convert.get(r.kind, F.col)(r.column).alias(r.column) for r in MEDICATION_FIELDS]
    columns.insert(1, F.lit(MEDICATION_TYPE).alias("msg_typ"))
    made = texts.select(*columns, *rest)
    return made.drop(*MEDICATION_NOT_STORED) if stored else made
