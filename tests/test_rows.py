"""Latest rows, as-of joins, retention, reports: against brute force on small data."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidefold.functions import frames
from tidefold.operators import latest, observe, retention
from tidefold.operators.asof import asof_join
from tidefold.operators.skew import hot_ranges, piece_of, share_of, shares
from tidefold.spec import TABLES

T0 = datetime.datetime(2024, 1, 1)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


@pytest.mark.parametrize("pieces", [None, 20, 200])
@pytest.mark.parametrize("kind", ["long", "timestamp", "timestamp_ntz"])
def test_asof_join_with_a_hot_key(spark, pieces, kind):
    """One key holds most rows, with equal times and stretches without any right row."""
    rng = random.Random(7)
    keys = ["hot"] * 9 + ["a", "b", None]
    left = [(i, rng.choice(keys), rng.randrange(500)) for i in range(300)]
    right = [(rng.choice(keys), rng.choice([rng.randrange(60), rng.randrange(400, 460)]), n, f"v{n}") for n in range(120)]
    want = []
    for i, k, t in left:
        seen = [(rt, n, v) for rk, rt, n, v in right if k is not None and rk == k and rt <= t]
        want.append((i, k, max(seen)[2] if seen else None))

    def moment(df, c):
        if kind == "long":
            return df
        return df.withColumn(c, F.timestamp_seconds(c).cast(kind))

    ldf = moment(spark.createDataFrame(left, "i long, k string, t long"), "t")
    rdf = moment(spark.createDataFrame(right, "k string, rt long, n long, v string"), "rt")
    got = asof_join(ldf, rdf, ["k"], "t", "rt", ["v"], tie_break=["n"], piece_rows=pieces)
    assert rows(got, "i", "k", "v") == rows(spark.createDataFrame(want, "i long, k string, v string"))
    assert got.columns == ["i", "k", "t", "v"]


def test_pieces_of_a_bursty_key_hold_equal_numbers_of_rows(spark):
    """All but one row within a second, the other one decades earlier."""
    burst = spark.range(100_000).select(F.lit("k").alias("k"), (F.col("id") / 1e5 + 1.7e9).alias("t"))
    rows_ = burst.unionAll(spark.createDataFrame([("k", 0.0), ("cold", 1.0)], burst.schema))
    cuts = hot_ranges(rows_, ["k"], "t", 1000)
    sizes = rows_.join(cuts, "k").groupBy(piece_of(F.col("t")).alias("p")).count().collect()
    assert len(sizes) > 90 and max(r["count"] for r in sizes) < 2000


def test_a_time_that_fills_pieces_by_itself_is_dealt_out(spark):
    """A million rows of one key share one time, between rows before and after it."""
    n = 1_000_000
    tied = spark.range(n).select("id", F.lit("k").alias("k"), F.lit(5.0).alias("t"))
    rows_ = tied.unionAll(spark.range(n, n + 30_000).select("id", F.lit("k"), (F.col("id") % 11).cast("double")))
    cuts = hot_ranges(rows_, ["k"], "t", 50_000)
    dealt = rows_.join(cuts, "k").select(piece_of(F.col("t")).alias("p"), share_of(F.col("t"), F.struct("id")).alias("s"), shares(F.col("t")).alias("all"))
    sizes = dealt.groupBy("p", "s").agg(F.count("*").alias("n"), F.min(F.array_contains("all", F.col("s"))).alias("known")).collect()
    assert sum(r["n"] for r in sizes) == n + 30_000 and all(r["known"] for r in sizes)
    assert len(sizes) > 15 and max(r["n"] for r in sizes) <= 100_000


@pytest.mark.parametrize("kind", ["long", "timestamp"])
def test_asof_join_where_one_time_is_dealt_out(spark, kind):
    """Most rows of both sides have one time; longs so large that neighbours are one double, times a microsecond apart."""
    rng = random.Random(11)
    base = 2**60 if kind == "long" else 1_700_000_000_000_000
    moments = [base + d for d in (-5000, -4000, -1, 0, 0, 0, 0, 0, 0, 0, 1, 2, 4000)]
    left = [(i, rng.choice("kkkkkx"), rng.choice(moments), {"m": i}) for i in range(400)]
    right = [(rng.choice("kkkkkx"), rng.choice(moments), n, f"v{n}") for n in range(200)]
    right = [r for r in right if r[1] > base - 5000 or r[2] > 150]
    want = []
    for i, k, t, _ in left:
        seen = [(rt, n, v) for rk, rt, n, v in right if rk == k and rt <= t]
        want.append((i, k, max(seen)[2] if seen else None))
    moment = lambda df, c: df if kind == "long" else df.withColumn(c, F.timestamp_micros(c))
    ldf = moment(spark.createDataFrame(left, "i long, k string, t long, m map<string,int>"), "t")
    rdf = moment(spark.createDataFrame(right, "k string, rt long, n long, v string"), "rt")
    for pieces in (20, 60):
        got = asof_join(ldf, rdf, ["k"], "t", "rt", ["v"], tie_break=["n"], piece_rows=pieces)
        assert rows(got, "i", "k", "v") == rows(spark.createDataFrame(want, "i long, k string, v string"))


def test_latest_variants(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (3, 1, "e"), (3, None, "f")], "k int, o int, v string"
    )
    assert rows(latest.latest_per_key(df, ["k"], "o")) == [(1, 5, "b"), (3, 1, "e")]
    assert rows(latest.latest_keep_ties(df, ["k"], "o")) == [(1, 5, "a"), (1, 5, "b"), (3, 1, "e")]
    by = [F.desc_nulls_last("o"), F.asc("v")]
    assert rows(latest.row_number_latest(df, ["k"], by)) == [(1, 5, "a"), (2, None, "d"), (3, 1, "e")]
    assert latest.row_number_latest(df, ["k"], by, n=2).count() == 5


def test_last_non_null_keeps_every_key(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, None), (2, 1, None, "z")], "k int, o int, x string, y string")
    assert rows(latest.last_non_null(df, ["k"], "o", ["x", "y"])) == [(1, "a", None), (2, None, "z")]


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_ordered_string_agg(spark, block):
    df = spark.createDataFrame([(k, n, f"t{n}") for k in (1, 2) for n in range(20 * k, 0, -1)] + [(3, 1, None)], "k int, n int, t string")
    got = dict(rows(latest.ordered_string_agg(df, ["k"], "n", "t", block=block)))
    assert got == {k: "^".join(f"t{n}" for n in range(1, 20 * k + 1)) for k in (1, 2)}


def test_dedup_by_id_keeps_the_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "e")], "id int, o int, v string")
    assert rows(latest.dedup_by_id(df, ["id"], ["o"])) == [(1, 1, "a"), (2, 5, "e")]
    assert latest.dedup_by_id(df, ["id"]).count() == 2


def test_retention_rules(spark):
    """Discharged three days ago: every row of the key goes. Two days ago or not at all: stays."""
    day = datetime.date(2024, 3, 10)

    def ago(n):
        return datetime.datetime(2024, 3, 10, 12) - datetime.timedelta(days=n)

    history = spark.createDataFrame(
        [(1, ago(3)), (2, ago(2)), (3, None), (4, None), (4, ago(3))], "pat_enc_csn_id long, hosp_disch_tm timestamp"
    )
    child = spark.createDataFrame([(k,) for k in (1, 2, 2, 3, 4, 9)], "pat_enc_csn_id long")
    kept = retention.retire(history, {"c": child}, child.distinct(), {"d": child}, as_of=day)
    assert rows(kept["history"], "pat_enc_csn_id") == [(2,), (3,)]
    assert rows(kept["c"]) == [(2,), (2,), (3,)]
    assert rows(kept["detail"]) == [(2,), (3,)]
    assert rows(kept["d"]) == [(2,), (2,), (3,)]
    assert rows(retention.purge_keys(child, history)) == [(9,)]


def test_clustering_spreads_a_hot_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    laid_out = retention.clustered(df, ["k"], 8, ["id"]).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in laid_out.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 4
    spans = sorted((r.lo, r.hi) for r in laid_out.groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_freshness_limit(spark):
    now = datetime.datetime(2024, 1, 1, 12, tzinfo=datetime.timezone.utc)

    def table(minutes, seconds=0):
        t = datetime.datetime(2024, 1, 1, 12) - datetime.timedelta(minutes=minutes, seconds=seconds)
        return spark.createDataFrame([(t, t, t)], "row_updt_tsp timestamp, msg_tm timestamp, msg_enqueued_tsp timestamp")

    tables = {("lake", "a"): table(4, 59), ("lake", "b"): table(5, 59), ("lake", "c"): table(6), ("house", "b"): table(5, 59)}
    report = observe.freshness_report(tables, now, boundary_platforms=["house"]).collect()
    assert [(r.platform, r.table_name, r.diff_tms_msg) for r in report] == [("house", "b", 359), ("lake", "c", 360)]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, None, 1), (4, "x", 1), (6, "x", 1), (6, "x", 2)], "k int, v string, n int")
    e = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "x", 1), (5, "x", 1), (6, "x", 1)], "k int, v string, n int")
    strict = {r.k: (r.status, r.mismatched_cols) for r in observe.reconcile(a, e, ["k"]).collect()}
    assert strict == {
        1: ("match", []), 2: ("mismatch", ["v", "n"]), 3: ("mismatch", ["v"]), 4: ("only_actual", []),
        5: ("only_expected", []), 6: ("ambiguous", []),
    }
    loose = {r.k: r.status for r in observe.reconcile(a, e, ["k"], null_safe=False).collect()}
    assert loose[3] == "match" and loose[2] == "mismatch"
    report = dict(rows(observe.match_report(observe.reconcile(a, e, ["k"]))))
    assert report == {"match": 1, "mismatch": 2, "only_actual": 1, "only_expected": 1, "ambiguous": 1}


def test_conform_orders_types_and_enforces(spark):
    spec = TABLES["encntr_dx"]
    df = spark.createDataFrame([("A1", 7, "STL"), ("A2", 8, None)], "dx_icd_cd string, pat_enc_csn_id long, msg_src string")
    shaped = frames.conform(df, spec)
    assert shaped.columns == spec.columns and shaped.count() == 1
    assert frames.conform(df, spec, enforce=False).count() == 2
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in spec.schema]


def test_old_names(spark):
    df = spark.createDataFrame([(1, 2)], "birth_date int, department_abbr int")
    assert frames.rename_old(df).columns == ["birth_dt", "dept_abbr"]
    assert frames.add_null_column(df, "x", "timestamp").schema["x"].dataType.simpleString() == "timestamp"


def test_audit_stamp_defaults_to_now_and_the_current_user(spark):
    row = frames.audit_stamp(spark.range(1)).first()
    assert row.row_insert_tsp == row.row_updt_tsp and row.insert_user_id == row.updt_user_id != ""


def test_visit_reasons_are_spread_by_the_size_of_their_table(spark, scratch, monkeypatch):
    """More tasks for a larger table, and the same rows with repeated ids, encounters and names."""
    from tidefold.plans import backfill

    spark.range(6000).selectExpr("id % 500 AS pat_enc_csn_id", "id % 7 AS enc_reason_id").write.parquet(f"{scratch}/given")
    names = spark.createDataFrame([(0, "a"), (1, "a"), (1, "b"), (2, None), (3, "c")], "reason_visit_id long, reason_visit_name string")
    heads = spark.range(400).selectExpr("'S' AS msg_src", "current_date() AS msg_tm", "id AS pat_enc_csn_id")
    t = {"pat_enc_rsn_visit": spark.read.parquet(f"{scratch}/given"), "cl_rsn_for_visit": names}
    monkeypatch.setattr(backfill, "BYTES_PER_TASK", 200)
    got = backfill.visit_reasons(heads.unionAll(heads), t).select("pat_enc_csn_id", "encntr_rsn")
    plan = got._jdf.queryExecution().executedPlan().toString()
    spread = [int(n) for n in re.findall(r"Exchange hashpartitioning\(pat_enc_csn_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert spread and spread[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = {(i % 500, i % 7) for i in range(6000) if i % 500 < 400}
    expected = {(k, v) for k, r in met for i, v in ((0, "a"), (1, "a"), (1, "b"), (2, None), (3, "c")) if i == r}
    assert got.count() == len(expected) and {tuple(r) for r in got.collect()} == expected
