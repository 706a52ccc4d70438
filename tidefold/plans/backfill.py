"""Historical back-fill of the encounter tables from the source system's tables.

The frames are passed by role under the names of the source tables. Every job starts from the
encounters that survive its filters, cuts the large event and line tables down to these, reduces them
to one row per encounter, and joins lookups last. The encounter, event and status-time tables meet by encounter only, so tables that
``bucketed_sources`` has written meet without a shuffle.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.operators.asof import asof_join
from tidefold.operators.latest import latest_per_key, ordered_string_agg, row_number_latest
from tidefold.operators.skew import pieces_of
from tidefold.plans.messages import SOURCE, TRIAGE_NOTE_TYPE
from tidefold.session import scratch_path
from tidefold.sources.buckets import bucketed

Frames = Mapping[str, DataFrame]

# Codes of the source system.
SINCE = datetime.date(2021, 7, 1)
EVENT_TYPES = (1, 2, 3, 5, 6)
CANCELLED_EVENT = 2
CANCELLED_ADMISSION = 3
PREGNANT = 4
NOTE_TYPES = ("6", "8")
NOTE_STATUSES_LEFT_OUT = ("1", "4", "10")
ICD_TYPE = "ICD-10-CM"
LOADED_BY = "ETL"
DISCHARGED_DAYS = 2


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pregnant_encounters(encounters: DataFrame, statuses: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Encounters, of those in ``wanted``, whose latest status applied by their effective time means pregnancy."""
    effective = encounters.filter(F.col("obgyn_eff_dttm").isNotNull()).select(
        "pat_id", "pat_enc_csn_id", "obgyn_eff_dttm"
    )
    if wanted is not None:
        effective = effective.join(wanted, "pat_enc_csn_id", "left_semi")
        # The join reads both sides more than once; what is left of them is small.
        effective = _kept(effective, "effective")
        columns = ["pat_id", "app_inst_utc_dttm", "line", "obgyn_stat_c"]
        statuses = _kept(statuses.select(columns).join(effective.select("pat_id"), "pat_id", "left_semi"), "statuses")
    status = asof_join(
        effective, statuses, ["pat_id"], "obgyn_eff_dttm", "app_inst_utc_dttm",
        ["obgyn_stat_c"], tie_break=["line"],
    )
    return status.filter(F.col("obgyn_stat_c") == PREGNANT).select("pat_enc_csn_id").distinct()


# The large source tables and the key that each is joined by.
LARGE = {"pat_enc_hsp": "pat_enc_csn_id", "clarity_adt": "pat_enc_csn_id", "pat_enc_5": "pat_enc_csn_id"}
# What an event's places are looked up in, and the columns that are.
PLACES = {
    "mv_dep_loc_sa": ["department_id", "department_abbr", "loc_abbr", "loc_id", "sa_rpt_grp_six_name"],
    "clarity_rom": ["room_csn_id", "room_name"],
    "clarity_bed": ["bed_csn_id", "bed_label", "bed_status_c"],
}


def bucketed_sources(t: Frames, buckets: int) -> dict[str, DataFrame]:
    """The same frames, the large ones of them written as bucketed tables; each nightly load then reads these.

    The tables of places are written as they are, so that the planner knows their size and broadcasts those below its threshold; with a larger
    one the events are shuffled by place.
    """
    stored = {name: bucketed(t[name], key, buckets, name) for name, key in LARGE.items()}
    places = {name: _kept(t[name].select(columns), name) for name, columns in PLACES.items()}
    return {**t, **stored, **places}


def _lookup(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias(f"_{name}_key"), F.col(value).alias(name))


def encounter_detail(
    t: Frames,
    area: str,
    as_of: datetime.date,
    loaded_at: Column | None = None,
    since: datetime.date = SINCE,
    excluded_locations: Sequence[int] = (),
) -> DataFrame:
    """Current state of every encounter that is open or was discharged in the last days.

    ``area`` is part of the service-area name to load. The latest event of an encounter counts
    among its events with a known department, room and bed; one without a number counts if there is no other.
    """
    day = F.lit(as_of).cast("timestamp_ntz")
    first_day = F.lit(since).cast("timestamp_ntz")
    encounter = t["pat_enc_hsp"].filter(
        (F.col("hosp_admsn_time") >= first_day)
        & (
            F.col("hosp_disch_time").isNull()
            | (F.col("hosp_disch_time") >= F.date_sub(F.lit(as_of), DISCHARGED_DAYS).cast("timestamp_ntz"))
        )
        & (F.col("admit_conf_stat_c") != CANCELLED_ADMISSION)
    )
    department = t["mv_dep_loc_sa"].filter(
        F.col("sa_rpt_grp_six_name").contains(area) & ~F.col("loc_id").isin(*excluded_locations)
    ).select("department_id", "department_abbr", "loc_abbr")
    patient = (
        t["patient"]
        .filter(F.col("death_date").isNull())
        .select("pat_id", "pat_mrn_id", "birth_date", "death_date", "sex_c")
        .join(t["patient_3"].filter(F.col("is_test_pat_yn") != "Y").select("pat_id"), "pat_id", "left_semi")
    )
    # Encounters are cut by their own columns here, by patient when they are one row each: so nothing moves before that.
    wanted = encounter.select("pat_enc_csn_id")
    event = (
        t["clarity_adt"]
        .filter(
            (F.col("effective_time") >= first_day)
            & (F.col("effective_time") < day)
            & F.col("event_type_c").isin(*EVENT_TYPES)
            & (F.col("event_subtype_c") != CANCELLED_EVENT)
        )
        .select(
            "pat_enc_csn_id", "seq_num_in_enc", "department_id", "room_csn_id", "bed_csn_id",
            "accommodation_c", "user_id",
        )
        .join(wanted, "pat_enc_csn_id", "left_semi")
        .join(department, "department_id")
        .join(t["clarity_rom"].select("room_csn_id", "room_name"), "room_csn_id")
        .join(t["clarity_bed"].select("bed_csn_id", "bed_label", "bed_status_c"), "bed_csn_id")
    )
    last = latest_per_key(
        event.select(
            "pat_enc_csn_id", "seq_num_in_enc", "department_abbr", "loc_abbr", "room_name",
            "bed_label", "bed_status_c", "accommodation_c", "user_id",
        ),
        ["pat_enc_csn_id"],
        "seq_num_in_enc",
        unordered=True,
    )
    base = encounter.join(last, "pat_enc_csn_id").join(patient, "pat_id")
    # Lookup table, its key, its value, the key in the joined rows, output name.
    for table, key, value, of, name in (
        ("zc_pat_class", "adt_pat_class_c", "abbr", "adt_pat_class_c", "pat_class_abbr"),
        ("zc_disch_disp", "disch_disp_c", "abbr", "disch_disp_c", "disch_dsptn_abbr"),
        ("zc_acuity_level", "acuity_level_c", "abbr", "acuity_level_c", "acuity_level_abbr"),
        ("zc_sex", "rcpt_mem_sex_c", "abbr", "sex_c", "sex_abbr"),
        ("zc_arriv_means", "means_of_arrv_c", "name", "means_of_arrv_c", "means_of_arrv_abbr"),
        ("zc_ed_disposition", "ed_disposition_c", "abbr", "ed_disposition_c", "ed_dsptn_abbr"),
        ("zc_bed_status", "bed_status_c", "name", "bed_status_c", "bed_stat"),
        ("zc_accommodation", "accommodation_c", "abbr", "accommodation_c", "accommodation_abbr"),
    ):
        lookup = _lookup(t[table], key, value, name)
        base = base.join(lookup, F.col(of) == F.col(f"_{name}_key"), "left")
    pregnant = pregnant_encounters(t["pat_enc_5"], t["obgyn_stat"], wanted).withColumn("pregnancy_flg", F.lit("Y"))
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return (
        base.join(pregnant, "pat_enc_csn_id", "left")
        .select(
            *(F.lit(LOADED_BY).alias(c) for c in ("msg_typ", "trigger_evnt", "msg_nm", "bod_id")),
            F.lit(SOURCE).alias("msg_src"),
            *(now.alias(c) for c in ("msg_tm", "row_insert_tsp", "row_updt_tsp", "msg_enqueued_tsp")),
            *(F.current_user().alias(c) for c in ("insert_user_id", "updt_user_id")),
            "pat_mrn_id", "pat_enc_csn_id",
            F.col("birth_date").alias("birth_dt"), F.col("death_date").alias("death_dt"),
            F.upper("pat_class_abbr").alias("pat_class_abbr"),
            F.col("hosp_admsn_time").alias("hosp_admsn_tm"),
            F.col("hosp_disch_time").alias("hosp_disch_tm"),
            F.col("department_abbr").alias("dept_abbr"), "loc_abbr",
            F.col("room_name").alias("room_nm"), "bed_label", "bed_stat", "sex_abbr",
            "means_of_arrv_abbr",
            F.expr("substr(acuity_level_abbr, 3)").alias("acuity_level_abbr"),
            "ed_dsptn_abbr", "disch_dsptn_abbr",
            F.col("adt_arrival_time").alias("adt_arvl_tm"),
            F.col("hsp_account_id").alias("hsp_acct_id"),
            "accommodation_abbr", "user_id",
            F.lit(None).cast("string").alias("cncl_admsn_flg"), "pregnancy_flg",
        )
        .distinct()
    )


def _loaded(rows: DataFrame, payload: list[str | Column], loaded_at: Column | None) -> DataFrame:
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return rows.select(
        "msg_src", "msg_tm", "pat_enc_csn_id", *payload,
        now.alias("row_insert_tsp"), now.alias("row_updt_tsp"),
        F.current_user().alias("insert_user_id"), F.current_user().alias("updt_user_id"),
        now.alias("msg_enqueued_tsp"),
    )


def _heads(detail: DataFrame) -> DataFrame:
    return detail.select("msg_src", "msg_tm", "pat_enc_csn_id")


# Stored bytes of visit reasons that one task takes: two packed ids a row, which grow many times with their names.
BYTES_PER_TASK = 8 * 2**20


def visit_reasons(detail: DataFrame, t: Frames, loaded_at: Column | None = None) -> DataFrame:
    # Repeats are dropped on the two id columns, before the names make the rows wide. Ids shuffle to so little that adaptive
    # execution would give one task more of them than it can hold with their names, so the number of tasks follows the table; by
    # encounter, as the last distinct then needs no shuffle.
    given = t["pat_enc_rsn_visit"].select("pat_enc_csn_id", F.col("enc_reason_id").alias("reason_visit_id"))
    tasks = max(int(given.sparkSession.conf.get("spark.sql.shuffle.partitions")), pieces_of(given, BYTES_PER_TASK))
    named = (
        given.distinct()
        .repartition(tasks, "pat_enc_csn_id")
        .join(t["cl_rsn_for_visit"].select("reason_visit_id", "reason_visit_name"), "reason_visit_id")
        .select("pat_enc_csn_id", F.col("reason_visit_name").alias("encntr_rsn"))
    )
    rows = _heads(detail).join(named, "pat_enc_csn_id").distinct()
    return _loaded(rows, ["encntr_rsn"], loaded_at)


def complaints(detail: DataFrame, t: Frames, loaded_at: Column | None = None) -> DataFrame:
    given = t["pat_enc_er_complnt"].select("pat_enc_csn_id", F.col("er_complaint").alias("er_complnt"))
    rows = _heads(detail).join(given.distinct(), "pat_enc_csn_id").distinct()
    return _loaded(rows, ["er_complnt"], loaded_at)


def diagnoses(detail: DataFrame, t: Frames, loaded_at: Column | None = None) -> DataFrame:
    rows = (
        _heads(detail)
        .join(t["pat_enc_dx"].select("pat_enc_csn_id", "dx_id"), "pat_enc_csn_id")
        .join(t["edg_current_icd10"].select("dx_id", F.col("code").alias("dx_icd_cd")), "dx_id")
        .join(t["clarity_edg"].select("dx_id", F.col("dx_name").alias("dx_nm")), "dx_id")
    )
    return _loaded(rows, ["dx_icd_cd", "dx_nm", F.lit(ICD_TYPE).alias("dx_cd_typ")], loaded_at)


def notes(
    detail: DataFrame, t: Frames, loaded_at: Column | None = None, since: datetime.date = SINCE
) -> DataFrame:
    """The most recent emergency note of every encounter, its lines joined in order."""
    asked = _heads(detail).select("pat_enc_csn_id")
    wanted = t["hno_info"].filter(F.col("ip_note_type_c").isin(*NOTE_TYPES)).join(asked, "pat_enc_csn_id", "left_semi")
    contact = t["note_enc_info"].filter(
        (F.col("entry_instant_dttm") >= F.lit(since).cast("timestamp_ntz"))
        & (F.col("note_status_c").isNull() | ~F.col("note_status_c").isin(*NOTE_STATUSES_LEFT_OUT))
    )
    dated = wanted.select("note_id", "pat_enc_csn_id").join(
        contact.select("note_id", "contact_serial_num", "ent_inst_local_dttm"), "note_id"
    )
    recent = row_number_latest(
        dated,
        ["pat_enc_csn_id"],
        [F.desc("ent_inst_local_dttm"), F.desc("contact_serial_num")],
    ).select("pat_enc_csn_id", F.col("contact_serial_num").alias("note_csn_id"))
    lines = t["hno_note_text"].select("note_csn_id", "line", "note_text").join(recent, "note_csn_id")
    texts = ordered_string_agg(lines, ["pat_enc_csn_id"], "line", "note_text")
    rows = texts.withColumnRenamed("note_text", "nte_txt").join(_heads(detail), "pat_enc_csn_id")
    return _loaded(rows, ["nte_txt", F.lit(TRIAGE_NOTE_TYPE).alias("nte_typ")], loaded_at)
