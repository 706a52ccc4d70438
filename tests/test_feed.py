"""Change feeds, reconciliation by digests, history by day."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidefold.operators import feed, observe, retention

STATE = "k int, a string, b string"


@pytest.fixture
def states(spark):
    old = spark.createDataFrame([(1, "x", None), (2, None, "y"), (3, "z", "z"), (None, "n", "n"), (5, "e", "e")], STATE)
    new = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (4, "w", "w"), (None, "n", "m"), (5, "e", "e")], STATE)
    return old, new


def test_feed_tells_where_nulls_are(states):
    got = rows(feed.change_feed(*states, ["k"]), "k", "op", "before.a", "before.b", "after.a", "after.b")
    assert got == [
        (1, "update", "x", None, None, "x"), (3, "delete", "z", "z", None, None), (4, "insert", None, None, "w", "w"), (None, "update", "n", "n", "n", "m"),
    ]


def test_feed_applied_gives_the_new_state(states):
    old, new = states
    assert rows(feed.apply_feed(old, feed.change_feed(old, new, ["k"]), ["k"])) == rows(new)
    assert feed.change_feed(old, old, ["k"]).count() == 0
    assert rows(feed.apply_feed(old.limit(0), feed.change_feed(old.limit(0), new, ["k"]), ["k"])) == rows(new)


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("ranges", [1, 8, 1 << 16])
def test_digests_say_what_rows_say(spark, states, null_safe, ranges):
    old, new = states
    twice = spark.createDataFrame([(7, "q", "q"), (7, "q", "q"), (8, "r", "r"), (8, "s", "s"), (9, "u", "u"), (9, "u", "u")], STATE)
    a = old.unionAll(twice)
    e = new.unionAll(twice.filter("k = 7")).unionAll(spark.createDataFrame([(8, "t", "t"), (8, "t", "t"), (9, "u", "u")], STATE))
    plain = observe.reconcile(a, e, ["k"], null_safe)
    assert rows(observe.reconcile_by_digest(a, e, ["k"], null_safe, ranges)) == rows(plain)


def test_one_row_in_a_million(spark):
    """Only the range of the differing row is compared; the rest shuffles its keys."""
    left = spark.range(1_000_000).select(F.col("id").alias("k"), F.repeat(F.lit("wide"), 20).alias("a"), (F.col("id") * 3).alias("b"))
    right = left.withColumn("b", F.when(F.col("k") == 123_456, -1).otherwise(F.col("b")))
    assert observe.differing_ranges(left, left, ["k"], ["a", "b"]).count() == 0
    assert observe.differing_ranges(left, right, ["k"], ["a", "b"]).count() == 1
    found = observe.reconcile_by_digest(left, right, ["k"])
    assert rows(found.filter("status <> 'match'"), "k", "status") == [(123_456, "mismatch")]
    assert found.count() == 1_000_000
    # What passes from scans to the wide comparison is behind the semi join with the differing ranges.
    text = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"BroadcastHashJoin \[_range[^\n]*LeftSemi", text)) >= 2


HISTORY = "pat_enc_csn_id int, note string, hosp_disch_tm timestamp"


def day(n, hour=8):
    return datetime.datetime(2024, 1, n, hour)


def test_a_night_touches_the_days_of_expired_keys_only(spark, scratch):
    store = retention.DayTable(spark, f"{scratch}/days", spark.createDataFrame([], HISTORY).schema)
    store.append(spark.createDataFrame([(1, "a", day(1)), (1, "open", None), (2, "b", day(1)), (3, "c", day(9)), (1, "later", day(9)), (4, "d", day(10))], HISTORY))
    store.append(spark.createDataFrame([(5, "e", None), (6, "f", day(10))], HISTORY))

    def files():
        found = store.read().select(F.col("day").cast("string"), F.input_file_name()).distinct().collect()
        return {d: {f for e, f in found if e == d} for d in {e for e, _ in found}}

    before = files()
    assert store.retire(as_of=datetime.date(2024, 1, 10)) == [None, datetime.date(2024, 1, 1), datetime.date(2024, 1, 9)]
    assert rows(store.read(), "pat_enc_csn_id", "note") == [(3, "c"), (4, "d"), (5, "e"), (6, "f")]
    after = files()
    assert "2024-01-01" not in after and after["2024-01-10"] == before["2024-01-10"] and after["2024-01-09"] != before["2024-01-09"]
    assert store.retire(as_of=datetime.date(2024, 1, 10)) == [] and files() == after
    assert store.retire(as_of=datetime.date(2024, 2, 1)) == [datetime.date(2024, 1, 9), datetime.date(2024, 1, 10)]
    assert rows(store.read(), "note") == [("e",)]


def test_expired_keys_are_read_from_expired_days(spark, scratch):
    store = retention.DayTable(spark, f"{scratch}/days", spark.createDataFrame([], HISTORY).schema)
    store.append(spark.createDataFrame([(k, "x", day(k)) for k in range(1, 20)], HISTORY))
    early = store.read().filter(F.col("day") < F.lit(datetime.date(2024, 1, 5)))
    assert "PartitionFilters: [isnotnull(day" in early._jdf.queryExecution().executedPlan().toString()
    assert early.count() == 4
