"""Table definitions: column order, types, keys and change rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A column that changes only on certain triggers.

    Among the rows of a key whose trigger is in ``set_on`` or ``clear_on`` the latest
    decides: a ``set_on`` row gives the column its own value, a ``clear_on`` row gives it
    ``clear_value``. Other rows leave the column as it was.
    """

    column: str
    set_on: tuple[str, ...]
    clear_on: tuple[str, ...] = ()
    clear_value: str | None = None

    @property
    def flag(self) -> str:
        return f"{self.column}_modified"


# Which trigger events set or cancel which encounter column.
ENCOUNTER_RULES = (
    Rule("adt_arvl_tm", ("A04",)),
    Rule("hosp_admsn_tm", ("A01",)),
    Rule("hosp_disch_tm", ("A03",), ("A13",)),
    Rule("cncl_admsn_flg", ("A01",), ("A11",), "True"),
)
# The variant in which a cancelled admission also clears the admission time.
ENCOUNTER_RULES_CLEARING = tuple(
    Rule(r.column, r.set_on, ("A11",)) if r.column == "hosp_admsn_tm" else r
    for r in ENCOUNTER_RULES
)


@dataclass(frozen=True)
class TableSpec:
    """Name, schema and keys of one table.

    ``key`` finds the rows that a change replaces; ``natural_key`` finds a repeated row.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    order: str = "msg_tm"
    natural_key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


@dataclass(frozen=True)
class Cdc:
    """How a batch of messages turns into changes of a latest-state table."""

    key: tuple[str, ...] = ("pat_enc_csn_id",)
    order: str | Column = "msg_nm"
    trigger: str = "trigger_evnt"
    rules: tuple[Rule, ...] = ENCOUNTER_RULES
    inserted: str = "row_insert_tsp"
    updated: str = "row_updt_tsp"
    insert_user: str = "insert_user_id"
    update_user: str = "updt_user_id"
    ruled: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        object.__setattr__(self, "ruled", tuple(r.column for r in self.rules))


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "decimal(18,0)": T.DecimalType(18, 0),
    "decimal(38,0)": T.DecimalType(38, 0),
    "binary": T.BinaryType(),
}


def schema_of(columns: str) -> T.StructType:
    """``name type [not null], …`` as a schema, without needing a running session."""
    fields = []
    for column in columns.split(", "):
        name, kind, *required = column.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType(fields)


_KEY = "pat_enc_csn_id decimal(18,0) not null"
_AUDIT = (
    "row_insert_tsp timestamp, row_updt_tsp timestamp, insert_user_id string, "
    "updt_user_id string, msg_enqueued_tsp timestamp"
)
_ENCOUNTER = (
    "msg_typ string, msg_src string not null, trigger_evnt string, msg_tm timestamp, "
    f"msg_nm string, bod_id string, pat_mrn_id string, {_KEY}, birth_dt timestamp, "
    "death_dt timestamp, pat_class_abbr string, hosp_admsn_tm timestamp, "
    "hosp_disch_tm timestamp, dept_abbr string, loc_abbr string, room_nm string, "
    "bed_label string, bed_stat string, sex_abbr string, means_of_arrv_abbr string, "
    "acuity_level_abbr string, ed_dsptn_abbr string, disch_dsptn_abbr string, "
    "adt_arvl_tm timestamp, hsp_acct_id decimal(18,0), accommodation_abbr string, "
    f"user_id string, {_AUDIT}"
)
_FLOWSHEET = (
    f"msg_typ string, msg_tm timestamp, msg_nm string, pat_mrn_id string, {_KEY}, "
    "fsd_id decimal(18,0), flwsht_nm string, flwsht_row_num string, meas_val string, "
    f"meas_typ string, rcrd_tm timestamp, entry_user_id string, {_AUDIT}"
)
_MEDICATION = (
    "msg_tm timestamp, msg_typ string, pat_mrn_id string, pat_enc_csn_id long, ord_id long, "
    "ord_stat string, ord_qnt string, ord_strt_tm timestamp, ord_end_tm timestamp, typ string, "
    "ord_crtr string, ord_prvdr_id long, ord_typ string, admn_tm timestamp, med_id string, "
    "med_nm string, med_brnd_nm string, dose string, units string, admn_prvdr string, "
    "admn_dept string, mar_actn string, med_route string, msg_nm string, "
    "msg_enqueued_tsp timestamp"
)
# Payload columns of the four child tables, and whether the source is required.
_CHILD = {
    "encntr_dx": (("dx_icd_cd", "dx_nm", "dx_cd_typ"), True),
    "encntr_er_complnt": (("er_complnt",), True),
    "encntr_visit_rsn": (("encntr_rsn",), False),
    "encntr_nte": (("nte_txt", "nte_typ"), False),
}


def _child(name: str) -> TableSpec:
    payload, source_required = _CHILD[name.removesuffix("_hist")]
    ddl = ", ".join(
        [
            "msg_src string not null" if source_required else "msg_src string",
            "msg_tm timestamp",
            _KEY,
            *(f"{c} string" for c in payload),
            _AUDIT,
        ]
    )
    natural = ("pat_enc_csn_id", "msg_tm", *payload)
    return TableSpec(name, schema_of(ddl), ("pat_enc_csn_id",), "msg_tm", natural)


CHILDREN = tuple(_CHILD)
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "adt_hist",
            schema_of(f"{_ENCOUNTER}, pregnancy_flg string"),
            ("pat_enc_csn_id",),
            "msg_tm",
            ("msg_nm",),
        ),
        TableSpec(
            "adt_dtl",
            schema_of(f"{_ENCOUNTER}, cncl_admsn_flg string, pregnancy_flg string"),
            ("pat_enc_csn_id",),
            "msg_nm",
            ("pat_enc_csn_id",),
            ENCOUNTER_RULES,
        ),
        *(_child(name) for name in CHILDREN),
        *(_child(f"{name}_hist") for name in CHILDREN),
        TableSpec("flwsht", schema_of(_FLOWSHEET), ("pat_enc_csn_id",), "msg_tm", ("msg_nm", "flwsht_nm")),
        TableSpec("med_admn", schema_of(_MEDICATION), ("pat_enc_csn_id",), "msg_tm", ("msg_nm",)),
    )
}

# Column names of the earlier table generation and their present names.
RENAMED = {
    "birth_date": "birth_dt",
    "death_date": "death_dt",
    "hosp_admsn_time": "hosp_admsn_tm",
    "hosp_disch_time": "hosp_disch_tm",
    "department_abbr": "dept_abbr",
    "bed_status": "bed_stat",
    "ed_disposition_abbr": "ed_dsptn_abbr",
    "disch_disp_abbr": "disch_dsptn_abbr",
    "adt_arrival_time": "adt_arvl_tm",
    "hsp_account_id": "hsp_acct_id",
    "update_user_id": "updt_user_id",
}
