"""The physical plans: what is scanned, shuffled and broadcast."""

import re

import pytest

import __spark_entry__ as entry
from checks import cdc as cdc_checks
from checks import messages as message_checks
from tidefold.sources.buckets import bucketed

QUERIES = {name: query for group in entry.ALL for name, query in group.queries.items()}
# These run their work while the query is built; the plan that is left only reads the outcome.
RUN_FIRST = ("stream_", "mirror_", "compact_cluster", "table_lifecycle", "replay_idempotent")
DECLARED = [n for n in QUERIES if not n.startswith(RUN_FIRST)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DECLARED)
def test_no_python_and_no_pairs(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "MapPartitions"):
        assert bad not in text, bad


def shuffles(spark, data, name):
    """Shuffles when nothing is small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return len(re.findall(r"Exchange (?:hash|range|Round)", plan(QUERIES[name](spark, data))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, most", [
    ("cdc_transform", 1), ("cdc_merge", 3), ("cdc_fold", 2), ("cdc_conditional_latest", 1), ("last_non_null", 1),
    ("latest_per_key", 1), ("row_number_latest", 1), ("dedup_by_id", 1), ("retention_expired", 1), ("reconcile", 1),
    ("delete_by_keys", 2), ("batch_metrics", 1), ("latest_keep_ties", 3), ("ordered_string_agg", 2),
])
def test_shuffle_count(spark, data, name, most):
    assert shuffles(spark, data, name) <= most


def test_aggregations_combine_before_the_shuffle(spark, data):
    for name in ("cdc_transform", "last_non_null", "reconcile", "latest_per_key"):
        assert "partial_" in plan(QUERIES[name](spark, data)), name


def test_row_number_limits_before_the_shuffle(spark, data):
    text = plan(QUERIES["row_number_latest"](spark, data))
    assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", text)


def test_medication_times_are_written_once_and_read_without_patterns(spark, data):
    text = plan(QUERIES["hl7_medication"](spark, data))
    assert text.count("date_format(") == 1 and "RLIKE" not in text and "rpad" not in text


def test_medication_fields_are_split_once_and_times_read_without_zones(spark, data):
    text = plan(QUERIES["hl7_medication"](spark, data))
    assert "stringsplitsql" not in text and " UTC) as timestamp" not in text
    # No projection hands on a segment's fields as an array.
    assert not re.search(r"split\([^\n]*?-1\) AS _(msh|pid|pv1|orc|rxa|rxr)#", text)


def test_date_filter_reaches_the_scan(spark, data):
    text = plan(QUERIES["retention_expired"](spark, data))
    assert re.search(r"PushedFilters: \[.*LessThan\(l_shipdate", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {"l_orderkey", "l_shipdate", "l_returnflag"}


def test_key_side_reads_keys_only(spark, data):
    text = plan(QUERIES["delete_by_keys"](spark, data))
    assert "struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_time_span_reaches_the_history_scan(spark, data):
    target, late = cdc_checks.shipped(spark, data)
    from tidefold.operators.cdc import append_new_only

    df = append_new_only(late, target, ["l_orderkey", "l_shipdate"], pruned_by="l_shipdate")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,ScalarSubquery", text)
    assert re.search(r"PushedFilters: \[[^\]]*IsNull\(l_shipdate\)", text)


def test_messages_are_split_once(spark, data):
    """The split message is one column of one projection, however many segments use it."""
    from tidefold.plans.messages import fan_out

    df = fan_out(message_checks.clinical_messages(spark, data))
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"split\(replace\(", optimized)) == 1


@pytest.mark.parametrize("name", ["delete_by_keys", "replace_by_key", "retain_following"])
def test_the_rows_of_a_hot_key_are_split(spark, scratch, name):
    """Four fifths of the rows have one key: the join that drops or keeps them is dealt to several tasks."""
    from tidefold.operators import cdc, retention

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k", "spark.sql.shuffle.partitions": "8",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spark.range(400_000).selectExpr("if(id % 5 < 4, 7, id) AS k", "id AS t", "md5(cast(id AS string)) AS v").write.parquet(scratch)
        target = spark.read.parquet(scratch)
        other = spark.range(3000).selectExpr("id * 5 + 4 AS k", "id AS t", "'x' AS v")
        got = {
            "delete_by_keys": lambda: cdc.delete_by_keys(target, other, ["k"]),
            "replace_by_key": lambda: cdc.replace_by_key(target, other, ["k"], "t"),
            "retain_following": lambda: retention.retain_following(target, other.unionByName(target.limit(1)), ["k"]),
        }[name]()
        executed = got._jdf.queryExecution()
        executed.executedPlan().executeCollect()
        assert "skew=true" in executed.executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def below(text, line):
    """A line of a plan and what feeds it."""
    lines = text.split("\n")
    start = next(i for i, x in enumerate(lines) if re.search(line, x))
    depth = len(re.match(r"[ :+-]*", lines[start]).group())
    end = next((i for i in range(start + 1, len(lines)) if len(re.match(r"[ :+-]*", lines[i]).group()) <= depth), len(lines))
    return "\n".join(lines[start:end])


def test_bucketed_events_are_aggregated_where_they_lie(spark, data):
    """With large tables that are above the threshold for broadcasts, and tables of places that are below it."""
    at_last_event = r"Aggregate\(keys?=\[pat_enc_csn_id#\d+L?\], functions=\[max"
    moved = r"Exchange (?:hash|range|Round|Single)"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12KB")
    try:
        bucketed_plan, star_plan = (plan(QUERIES[n](spark, data)) for n in ("backfill_bucketed", "backfill_star"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fed = below(bucketed_plan, at_last_event)
    assert not re.search(moved, fed) and len(re.findall("Bucketed: true", fed)) == 2
    assert re.search(moved, below(star_plan, at_last_event))


def test_a_table_with_a_hot_key_is_not_bucketed(spark):
    df = spark.range(1000).selectExpr("id", "IF(id < 400, NULL, id) AS k")
    for most, kept in ((399, False), (400, True)):
        stored = bucketed(df, "k", 4, "hot_keys", most)
        assert ("Bucketed: " in plan(stored.groupBy("k").count())) == kept
        assert stored.count() == 1000 and stored.dtypes == df.dtypes
    empty = bucketed(df.where("id < 0"), "k", 4, "no_keys")
    assert empty.count() == 0 and empty.dtypes == df.dtypes
