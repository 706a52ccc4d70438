"""Change data capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import Checks, table
from checks.history import (
    CLEAR_RULES, FLAG_RULES, H, LATEST, RULE_FLAGS, RULE_JOINS, RULE_VALUES, batch, history, rule_sql, rules_sql,
)
from tidefold.operators import cdc as ops
from tidefold.operators.latest import latest_per_key
from tidefold.spec import ENCOUNTER_RULES, ENCOUNTER_RULES_CLEARING, Cdc

checks = Checks()
FLAGGED = Cdc()
CLEARING = Cdc(rules=ENCOUNTER_RULES_CLEARING)


@checks.add(
    "cdc_conditional_latest",
    f"""WITH {H}, {rule_sql("hosp_disch_tm", ("A03",), ("A13",))}
    SELECT k.pat_enc_csn_id, d.v AS hosp_disch_tm, d.rn IS NOT NULL AS hosp_disch_tm_modified
    FROM (SELECT DISTINCT pat_enc_csn_id FROM h) k LEFT JOIN d_hosp_disch_tm d USING (pat_enc_csn_id)""",
)
def conditional_latest(spark, sf):
    rule = next(r for r in ENCOUNTER_RULES if r.column == "hosp_disch_tm")
    return ops.conditional_latest(history(spark, sf), ["pat_enc_csn_id"], "msg_nm", "trigger_evnt", rule)


def _transform_sql(rules: dict) -> str:
    return f"""WITH {H}, {LATEST}, {rules_sql(rules)}
    SELECT pat_enc_csn_id, msg_nm, msg_tm, trigger_evnt, value, props, row_insert_tsp, insert_user_id,
           {RULE_VALUES}, {RULE_FLAGS} FROM l {RULE_JOINS}"""


@checks.add("cdc_transform", _transform_sql(FLAG_RULES))
def transform(spark, sf):
    return ops.transform(history(spark, sf).drop("batch"), FLAGGED)


@checks.add("cdc_transform_clear", _transform_sql(CLEAR_RULES))
def transform_clear(spark, sf):
    return ops.transform(history(spark, sf).drop("batch"), CLEARING)


# All batches merged one after the other; later batches hold later messages here, so the last
# decider over everything wins, and the first batch of a key gives its insert time.
_MERGED = f"""
first_row AS (SELECT * FROM (
    SELECT pat_enc_csn_id, row_insert_tsp AS inserted,
           row_number() OVER (PARTITION BY pat_enc_csn_id ORDER BY batch, msg_nm DESC) AS rn FROM h) WHERE rn = 1),
merged AS (
    SELECT l.pat_enc_csn_id, l.msg_nm, l.msg_tm, l.trigger_evnt, l.value, l.props, l.insert_user_id,
           first_row.inserted AS row_insert_tsp, l.row_insert_tsp AS row_updt_tsp,
           l.insert_user_id AS updt_user_id, l.batch, {RULE_VALUES}
    FROM l JOIN first_row USING (pat_enc_csn_id) {RULE_JOINS})"""
_STATE_COLUMNS = """pat_enc_csn_id, msg_nm, msg_tm, trigger_evnt, value, props, insert_user_id, row_insert_tsp,
    row_updt_tsp, updt_user_id, adt_arvl_tm, hosp_admsn_tm, hosp_disch_tm, cncl_admsn_flg"""
MERGE_SQL = f"WITH {H}, {LATEST}, {rules_sql(FLAG_RULES)}, {_MERGED} SELECT {_STATE_COLUMNS} FROM merged"


def numbered_changes(df: DataFrame, cdc: Cdc = FLAGGED) -> DataFrame:
    """Change rows of every batch, in one aggregation."""
    return ops.stamp_changes(ops.transform(df, cdc, per=["batch"]), cdc)


def _state(spark, sf, *numbers: int) -> DataFrame:
    changes = numbered_changes(history(spark, sf).filter(F.col("batch").isin(*numbers)))
    return ops.fold(changes, FLAGGED, "batch")


def _changes(spark, sf, number: int) -> DataFrame:
    return ops.stamp_changes(ops.transform(batch(history(spark, sf), number), FLAGGED), FLAGGED)


@checks.add("cdc_merge", MERGE_SQL)
def merge(spark, sf):
    return ops.merge(_state(spark, sf, 1, 2), _changes(spark, sf, 3), FLAGGED)


@checks.add("cdc_fold", MERGE_SQL)
def fold(spark, sf):
    return _state(spark, sf, 1, 2, 3)


@checks.add(
    "changed_rows",
    f"""WITH {H}, {LATEST}, {rules_sql(FLAG_RULES)}, {_MERGED}
    SELECT {_STATE_COLUMNS} FROM merged WHERE batch = 3""",
)
def changed_rows(spark, sf):
    return ops.changed_rows(_state(spark, sf, 1, 2), _changes(spark, sf, 3), FLAGGED)


@checks.add(
    "incremental_since",
    f"""WITH {H}, mark AS (SELECT max(row_insert_tsp) AS m FROM h WHERE batch = 2),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pat_enc_csn_id, batch ORDER BY msg_nm DESC) AS rn
          FROM h) WHERE rn = 1)
    SELECT pat_enc_csn_id, batch, msg_nm, row_insert_tsp FROM l WHERE row_insert_tsp >= (SELECT m FROM mark)""",
)
def incremental_since(spark, sf):
    """Redelivering all batches against the state of the first two keeps only what is newer."""
    changes = numbered_changes(history(spark, sf))
    kept = ops.incremental_since(changes, _state(spark, sf, 1, 2), FLAGGED)
    return kept.select("pat_enc_csn_id", "batch", "msg_nm", "row_insert_tsp")


def _orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    return orders.filter(early), orders.filter(~early)


_LATEST_ORDER = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
    o_orderkey DESC) AS rn FROM orders WHERE {where}) WHERE rn = 1)"""
_EARLY = _LATEST_ORDER.format(where="o_orderdate < TIMESTAMP '1996-01-01'")
_LATE = _LATEST_ORDER.format(where="o_orderdate >= TIMESTAMP '1996-01-01'")
_ORDER = "o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@checks.add(
    "split_insert_update",
    f"""SELECT {_ORDER}, CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
        THEN 'update' ELSE 'insert' END AS action FROM {_LATE}""",
)
def split_insert_update(spark, sf):
    early, late = _orders(spark, sf)
    changes = latest_per_key(late, ["o_custkey"], F.struct("o_orderdate", "o_orderkey"))
    inserts, updates = ops.split_insert_update(changes, early, ["o_custkey"])
    return inserts.withColumn("action", F.lit("insert")).unionByName(
        updates.withColumn("action", F.lit("update"))
    )


@checks.add(
    "upsert_latest",
    f"""SELECT {_ORDER} FROM {_LATE} UNION ALL
    SELECT {_ORDER} FROM {_EARLY} WHERE o_custkey NOT IN (SELECT o_custkey FROM {_LATE})""",
)
def upsert_latest(spark, sf):
    early, late = _orders(spark, sf)
    order = F.struct("o_orderdate", "o_orderkey")
    return ops.upsert_latest(latest_per_key(early, ["o_custkey"], order), late, ["o_custkey"], order)


CUT = "1999-01-01"
LINE = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, l_shipdate"""


def shipped(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before the cut, and the ones after."""
    lines = table(spark, sf, "lineitem")
    before = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    return lines.filter(before), lines.filter(~before)


_REPLACED = f"""
    SELECT {LINE} FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'
        AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')
    UNION ALL
    SELECT {LINE} FROM (SELECT DISTINCT *, max(l_shipdate) OVER (PARTITION BY l_orderkey) AS m
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}') WHERE l_shipdate = m"""


@checks.add("replace_by_key", _REPLACED)
def replace_by_key(spark, sf):
    target, late = shipped(spark, sf)
    return ops.replace_by_key(target, late, ["l_orderkey"], "l_shipdate")


@checks.add("replace_by_key_twice", _REPLACED)
def replace_by_key_twice(spark, sf):
    """Replacing with the same batch again changes nothing."""
    target, late = shipped(spark, sf)
    once = ops.replace_by_key(target, late, ["l_orderkey"], "l_shipdate")
    return ops.replace_by_key(once, late, ["l_orderkey"], "l_shipdate")


@checks.add(
    "append_new_only",
    f"""SELECT DISTINCT {LINE} FROM lineitem
    WHERE ({LINE}) NOT IN (SELECT ({LINE}) FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}')""",
)
def append_new_only(spark, sf):
    """The whole table is delivered while the early part is known already."""
    target, late = shipped(spark, sf)
    delivered = target.unionByName(late)
    return ops.append_new_only(delivered, target, delivered.columns, pruned_by="l_shipdate")


@checks.add(
    "delete_by_keys",
    f"""SELECT {LINE} FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def delete_by_keys(spark, sf):
    doomed = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    doomed = doomed.select(F.col("o_orderkey").alias("l_orderkey"))
    return ops.delete_by_keys(table(spark, sf, "lineitem"), doomed, ["l_orderkey"])


@checks.add("cdc_merge_stepwise", MERGE_SQL)
def merge_stepwise(spark, sf):
    """Three merges in a row from an empty state."""
    empty = _state(spark, sf, 1).filter(F.lit(False))
    return reduce(lambda state, n: ops.merge(state, _changes(spark, sf, n), FLAGGED), (1, 2, 3), empty)
