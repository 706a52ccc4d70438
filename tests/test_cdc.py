"""Rules, merges and batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidefold.operators import cdc
from tidefold.operators.latest import latest_per_key
from tidefold.spec import ENCOUNTER_RULES, ENCOUNTER_RULES_CLEARING, TABLES, Cdc

START = datetime.datetime(2020, 1, 1, 8)
TRIGGERS = ("A01", "A03", "A04", "A08", "A11", "A13")


def drawn(seed, count, keys, batches):
    """Messages in order of their minute: batch, key, trigger, message, arrival, admission, discharge (minutes past the start)."""
    rng = random.Random(seed)
    return [
        (1 + i * batches // count, rng.choice(keys), rng.choice(TRIGGERS), 3 * i, *(3 * i + rng.randrange(1, 40) for _ in range(3)))
        for i in range(count)
    ]


def replayed(lines, clearing):
    """State per key by plain replay: what each trigger sets or clears, message after message."""
    state = {}
    for _, key, trigger, _, arrival, admission, discharge in lines:
        row = state.setdefault(key, [None] * 4)
        if trigger == "A04":
            row[0] = arrival
        elif trigger == "A01":
            row[1], row[3] = admission, None
        elif trigger == "A11":
            row[1], row[3] = None if clearing else row[1], "True"
        elif trigger in ("A03", "A13"):
            row[2] = discharge if trigger == "A03" else None
    return {k: tuple(v) for k, v in state.items()}


MESSAGES = drawn(11, 36, (31, 52, 77, 90), 3)


def minute(m):
    return START + datetime.timedelta(minutes=m)


def messages(spark, lines=MESSAGES):
    data = [(b, k, t, m, minute(a), minute(d), minute(x), minute(m), "u") for b, k, t, m, a, d, x in lines]
    return spark.createDataFrame(
        data,
        "batch long, pat_enc_csn_id long, trigger_evnt string, msg_nm int, adt_arvl_tm timestamp, hosp_admsn_tm timestamp,"
        "hosp_disch_tm timestamp, row_insert_tsp timestamp, insert_user_id string",
    )


def ruled(state):
    def minutes(v):
        return None if v is None else int((v - START).total_seconds() // 60)

    return {
        r.pat_enc_csn_id: (minutes(r.adt_arvl_tm), minutes(r.hosp_admsn_tm), minutes(r.hosp_disch_tm), r.cncl_admsn_flg)
        for r in state.collect()
    }


def changes(df, spec):
    return cdc.stamp_changes(cdc.transform(df, spec), spec)


@pytest.mark.parametrize("rules", [ENCOUNTER_RULES, ENCOUNTER_RULES_CLEARING])
def test_three_batches(spark, rules):
    spec = Cdc(rules=rules)
    df = messages(spark)
    state = None
    for n in (1, 2, 3):
        batch = changes(df.filter(F.col("batch") == n).drop("batch"), spec)
        batch = cdc.incremental_since(batch, state, spec) if state is not None else batch
        state = cdc.merge(state, batch, spec) if state is not None else batch.drop(*(r.flag for r in rules))
        assert ruled(state) == replayed([m for m in MESSAGES if m[0] <= n], rules is ENCOUNTER_RULES_CLEARING)
        numbered = cdc.stamp_changes(cdc.transform(df.filter(F.col("batch") <= n), spec, ["batch"]), spec)
        folded = cdc.fold(numbered, spec, "batch")
        assert rows(folded, *sorted(folded.columns)) == rows(state, *sorted(folded.columns))
    times = {r.pat_enc_csn_id: (r.row_insert_tsp, r.row_updt_tsp) for r in state.collect()}
    for key, got in times.items():
        mine = [m for m in MESSAGES if m[1] == key]
        # Inserted with the last message of the key's first batch, updated with its last of all.
        assert got == (minute(max(m[3] for m in mine if m[0] == mine[0][0])), minute(mine[-1][3]))


def test_untouched_differs_from_set_to_null(spark):
    spec = Cdc()
    batch = cdc.transform(messages(spark, [(1, 1, "A13", 1, 1, 1, 1), (1, 2, "A08", 2, 1, 1, 1)]).drop("batch"), spec)
    flags = {r.pat_enc_csn_id: r.hosp_disch_tm_modified for r in batch.collect()}
    assert flags == {1: True, 2: False}


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_ordered_batches_gives_the_same_ruled_columns(spark, seed):
    rng = random.Random(seed)
    triggers = ["A01", "A03", "A04", "A08", "A11", "A13"]
    lines = [(0, rng.randrange(4), rng.choice(triggers), m, m + 1, m + 2, m + 3) for m in range(40)]
    cuts = sorted(rng.sample(range(40), 3))
    split = [(sum(m >= c for c in cuts), *rest) for _, *rest in lines for m in [rest[2]]]
    spec = Cdc()
    whole = ruled(cdc.transform(messages(spark, lines).drop("batch"), spec))
    folded = cdc.fold(changes_per_batch(messages(spark, split), spec), spec, "batch")
    assert ruled(folded) == whole


def changes_per_batch(df, spec):
    return cdc.stamp_changes(cdc.transform(df, spec, ["batch"]), spec)


def test_message_numbers_compare_as_numbers(spark):
    df = messages(spark, [(1, 1, "A04", 9, 1, 1, 1), (1, 1, "A04", 10, 2, 2, 2)]).drop("batch")
    text = df.withColumn("msg_nm", F.col("msg_nm").cast("string"))
    spec = Cdc(order=F.col("msg_nm").try_cast("decimal(38,0)"))
    assert cdc.transform(text, spec).first().msg_nm == "10"


def test_equal_message_numbers_give_one_row(spark):
    lines = [(1, 1, "A04", 5, 1, 1, 1), (1, 1, "A04", 5, 2, 2, 2)]
    df = messages(spark, lines).drop("batch")
    first = cdc.transform(df, Cdc()).collect()
    again = cdc.transform(df.orderBy(F.desc("adt_arvl_tm")), Cdc()).collect()
    assert len(first) == 1 and first == again


def test_rows_without_an_order_are_ignored(spark):
    df = messages(spark, [(1, 1, "A04", 5, 1, 1, 1)]).drop("batch").withColumn("msg_nm", F.lit(None).cast("int"))
    assert cdc.transform(df, Cdc()).count() == 0


def test_late_changes_are_left_out(spark):
    spec = Cdc()
    state = changes(messages(spark, [(1, 1, "A04", 10, 1, 1, 1)]).drop("batch"), spec)
    late = changes(messages(spark, [(1, 1, "A04", 9, 1, 1, 1), (1, 2, "A04", 10, 1, 1, 1)]).drop("batch"), spec)
    assert rows(cdc.incremental_since(late, state, spec), "pat_enc_csn_id") == [(2,)]
    assert cdc.incremental_since(late, state.filter(F.lit(False)), spec).count() == 2


def child(spark, *lines):
    return spark.createDataFrame([(k, minute(m), v) for k, m, v in lines], "k long, t timestamp, v string")


def test_children_are_replaced_as_a_set(spark):
    empty = child(spark, (0, 0, "")).filter(F.lit(False))
    one = cdc.replace_by_key(empty, child(spark, (31, 10, "cough"), (52, 20, "fall"), (31, 30, "fever")), ["k"], "t")
    assert rows(one, "k", "v") == [(31, "fever"), (52, "fall")]
    two = cdc.replace_by_key(one, child(spark, (31, 50, "burn"), (77, 40, "cut")), ["k"], "t")
    assert rows(two, "k", "v") == [(31, "burn"), (52, "fall"), (77, "cut")]
    tied = cdc.replace_by_key(two, child(spark, (31, 70, "a"), (31, 70, "b"), (31, 70, "b"), (31, 60, "c")), ["k"], "t")
    assert rows(tied.filter("k = 31"), "v") == [("a",), ("b",)]


def test_append_new_only_treats_nulls_as_equal(spark):
    have = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    come = spark.createDataFrame([(1, None), (1, "a"), (2, "b"), (3, None), (3, None)], "k int, v string")
    assert rows(cdc.append_new_only(come, have, ["k", "v"])) == [(1, "a"), (3, None)]


def test_append_new_only_reads_a_range_of_the_key(spark):
    have = child(spark, (1, 1, "a"), (2, 5, "b"))
    come = child(spark, (2, 9, "b"), (3, 6, "c"))
    assert rows(cdc.append_new_only(come, have, ["k", "v"], pruned_by="k"), "k") == [(3,)]
    nameless = come.withColumn("k", F.lit(None).cast("int"))
    known = have.unionByName(nameless)
    assert cdc.append_new_only(nameless, known, ["k", "v"], pruned_by="k").count() == 0
    with pytest.raises(ValueError):
        cdc.append_new_only(come, have, ["k", "v"], pruned_by="t")


def test_split_and_upsert(spark):
    state = child(spark, (1, 1, "a"), (2, 1, "b"))
    batch = child(spark, (2, 2, "x"), (2, 3, "y"), (3, 1, "z"))
    inserts, updates = cdc.split_insert_update(latest_per_key(batch, ["k"], "t"), state, ["k"])
    assert rows(inserts, "k", "v") == [(3, "z")] and rows(updates, "k", "v") == [(2, "y")]
    assert rows(cdc.upsert_latest(state, batch, ["k"], "t"), "k", "v") == [(1, "a"), (2, "y"), (3, "z")]


def test_table_definitions():
    assert len(TABLES["adt_hist"].columns) == 33
    assert len(TABLES["adt_dtl"].columns) == 34
    assert TABLES["adt_dtl"].required == ["msg_src", "pat_enc_csn_id"]
    assert TABLES["flwsht"].columns[:3] == ["msg_typ", "msg_tm", "msg_nm"] and len(TABLES["flwsht"].columns) == 17
    assert len(TABLES["med_admn"].columns) == 25
    assert len(TABLES["encntr_dx"].columns) == 11 and len(TABLES["encntr_nte_hist"].columns) == 10
