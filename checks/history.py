"""The events table in the role of an encounter message history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import table

TRIGGERS = {"signup": "A04", "purchase": "A01", "error": "A11", "view": "A03", "click": "A13"}
_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRIGGERS.items())
TRIGGER = f"CASE event_type {_CASE} END"

COLUMNS = (
    "pat_enc_csn_id, msg_nm, msg_tm, trigger_evnt, adt_arvl_tm, hosp_admsn_tm, hosp_disch_tm, "
    "value, props, row_insert_tsp, insert_user_id"
)
# One SQL text serves both engines.
SELECT = f"""
SELECT user_id AS pat_enc_csn_id, event_id AS msg_nm, ts AS msg_tm, {TRIGGER} AS trigger_evnt,
       ts + INTERVAL 1 MINUTE AS adt_arvl_tm, ts + INTERVAL 2 MINUTE AS hosp_admsn_tm,
       ts + INTERVAL 3 MINUTE AS hosp_disch_tm, value, props,
       ts + INTERVAL 5 SECOND AS row_insert_tsp, concat('u', CAST(user_id AS VARCHAR(20))) AS insert_user_id,
       CAST(CASE WHEN day(ts) < 11 THEN 1 WHEN day(ts) < 21 THEN 2 ELSE 3 END AS BIGINT) AS batch
FROM events
"""
H = f"h AS ({SELECT})"


def history(spark: SparkSession, sf: str) -> DataFrame:
    """All events as messages, with the number of the batch that delivers them."""
    events = table(spark, sf, "events")
    return spark.sql(SELECT.replace("FROM events", "FROM {events}"), events=events)


def batch(df: DataFrame, *numbers: int) -> DataFrame:
    return df.filter(F.col("batch").isin(*numbers)).drop("batch")


def rule_sql(name: str, on: tuple[str, ...], clear: tuple[str, ...] = (), value: str = "NULL", source: str = "h") -> str:
    """CTE with the deciding row of a rule per key."""
    listens = ", ".join(f"'{t}'" for t in (*on, *clear))
    column = "CAST(NULL AS VARCHAR)" if name == "cncl_admsn_flg" else name
    cleared = f"CASE WHEN trigger_evnt IN ({', '.join(repr(t) for t in clear)}) THEN {value} ELSE {column} END" if clear else column
    return f"""d_{name} AS (SELECT * FROM (
        SELECT pat_enc_csn_id, {cleared} AS v,
               row_number() OVER (PARTITION BY pat_enc_csn_id ORDER BY msg_nm DESC) AS rn
        FROM {source} WHERE trigger_evnt IN ({listens})) WHERE rn = 1)"""


FLAG_RULES = {
    "adt_arvl_tm": (("A04",), (), "NULL"),
    "hosp_admsn_tm": (("A01",), (), "NULL"),
    "hosp_disch_tm": (("A03",), ("A13",), "NULL"),
    "cncl_admsn_flg": (("A01",), ("A11",), "'True'"),
}
CLEAR_RULES = {**FLAG_RULES, "hosp_admsn_tm": (("A01",), ("A11",), "NULL")}


def rules_sql(rules: dict, source: str = "h") -> str:
    return ",\n".join(rule_sql(n, *r, source=source) for n, r in rules.items())


RULE_JOINS = " ".join(f"LEFT JOIN d_{n} USING (pat_enc_csn_id)" for n in FLAG_RULES)
RULE_VALUES = ", ".join(f"d_{n}.v AS {n}" for n in FLAG_RULES)
RULE_FLAGS = ", ".join(f"d_{n}.rn IS NOT NULL AS {n}_modified" for n in FLAG_RULES)
LATEST = """l AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pat_enc_csn_id ORDER BY msg_nm DESC) AS rn FROM h) WHERE rn = 1)"""
