"""Latest rows, repeats, as-of joins, frames, retention and reports."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.base import Checks, comparable, digits, table, utc_sql
from checks.cdc import LINE
from checks.history import H, history
from tidefold.functions import frames, times
from tidefold.operators import latest as ops
from tidefold.operators import feed, observe, retention
from tidefold.operators.asof import asof_join
from tidefold.session import scratch_path
from tidefold.sources import bus
from tidefold.spec import TableSpec, schema_of

checks = Checks()
ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@checks.add(
    "latest_per_key",
    f"""SELECT {ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
        o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    return ops.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


@checks.add(
    "latest_keep_ties",
    f"""SELECT {LINE} FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate DESC) AS rk
        FROM lineitem) WHERE rk = 1""",
)
def latest_keep_ties(spark, sf):
    return ops.latest_keep_ties(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"], "l_shipdate")


@checks.add(
    "row_number_latest",
    f"""SELECT {ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
        o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def row_number_latest(spark, sf):
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return ops.row_number_latest(table(spark, sf, "orders"), ["o_custkey"], order)


def _last(column: str, when: str) -> str:
    return f"""(SELECT pat_enc_csn_id, {column}, row_number() OVER (PARTITION BY pat_enc_csn_id ORDER BY msg_nm DESC) AS rn
        FROM g WHERE {when}) {column}_last"""


_GAPS = f"""WITH {H}, g AS (SELECT pat_enc_csn_id, msg_nm, msg_tm,
    CASE WHEN trigger_evnt = 'A04' THEN adt_arvl_tm END AS adt_arvl_tm,
    CASE WHEN trigger_evnt = 'A03' THEN value END AS value,
    CASE WHEN trigger_evnt = 'A01' THEN props END AS props FROM h)"""


def _gaps(spark, sf):
    """Columns that only messages of one kind fill."""
    h = history(spark, sf)

    def only(trigger, column):
        return F.when(F.col("trigger_evnt") == trigger, F.col(column))

    return h.select(
        "pat_enc_csn_id", "msg_nm", "msg_tm", only("A04", "adt_arvl_tm").alias("adt_arvl_tm"),
        only("A03", "value").alias("value"), only("A01", "props").alias("props"),
    )


@checks.add(
    "last_non_null",
    f"""{_GAPS} SELECT k.pat_enc_csn_id, adt_arvl_tm, value, props FROM (SELECT DISTINCT pat_enc_csn_id FROM g) k
    LEFT JOIN {_last("adt_arvl_tm", "adt_arvl_tm IS NOT NULL")} ON adt_arvl_tm_last.pat_enc_csn_id = k.pat_enc_csn_id AND adt_arvl_tm_last.rn = 1
    LEFT JOIN {_last("value", "value IS NOT NULL")} ON value_last.pat_enc_csn_id = k.pat_enc_csn_id AND value_last.rn = 1
    LEFT JOIN {_last("props", "props IS NOT NULL")} ON props_last.pat_enc_csn_id = k.pat_enc_csn_id AND props_last.rn = 1""",
)
def last_non_null(spark, sf):
    return ops.last_non_null(_gaps(spark, sf), ["pat_enc_csn_id"], "msg_nm", ["adt_arvl_tm", "value", "props"])


@checks.add(
    "expected_state",
    f"""{_GAPS}, d AS (SELECT pat_enc_csn_id, msg_nm, msg_tm, row_number() OVER (PARTITION BY pat_enc_csn_id
        ORDER BY msg_nm DESC) AS rn FROM g WHERE CAST(msg_tm AS DATE) = DATE '2024-01-15')
    SELECT d.pat_enc_csn_id, d.msg_nm, d.msg_tm, value, props FROM d
    LEFT JOIN {_last("value", "value IS NOT NULL")} ON value_last.pat_enc_csn_id = d.pat_enc_csn_id AND value_last.rn = 1
    LEFT JOIN {_last("props", "props IS NOT NULL")} ON props_last.pat_enc_csn_id = d.pat_enc_csn_id AND props_last.rn = 1
    WHERE d.rn = 1""",
)
def expected_state(spark, sf):
    day = F.lit(datetime.date(2024, 1, 15))
    rows = _gaps(spark, sf).drop("adt_arvl_tm")
    return ops.expected_state(rows, ["pat_enc_csn_id"], "msg_tm", ["value", "props"], day)


@checks.add("dedup_exact", f"SELECT DISTINCT {LINE} FROM lineitem")
def dedup_exact(spark, sf):
    lines = table(spark, sf, "lineitem")
    return ops.dedup_exact(lines.unionByName(lines))


@checks.add(
    "dedup_by_id",
    """SELECT user_id, event_type, event_id, ts, value, props FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id, event_type ORDER BY ts) AS rn FROM events) WHERE rn = 1""",
)
def dedup_by_id(spark, sf):
    events = table(spark, sf, "events")
    return ops.dedup_by_id(events.unionByName(events), ["user_id", "event_type"], ["ts"])


@checks.add(
    "asof_join",
    """SELECT p.event_id, p.user_id, p.ts, CAST(e.event_id AS VARCHAR) AS error_id, e.value AS error_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
    ON p.user_id = e.user_id AND p.ts >= e.ts""",
)
def asof(spark, sf):
    events = table(spark, sf, "events")
    errors = events.filter("event_type = 'error'").select(
        "user_id", F.col("ts").alias("error_ts"), F.col("event_id").cast("string").alias("error_id"), F.col("value").alias("error_value")
    )
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof_join(purchases, errors, ["user_id"], "ts", "error_ts", ["error_id", "error_value"])


_SPARSE = "SELECT *, CASE WHEN event_id % 3 > 0 THEN user_id END AS k FROM events"


@checks.add(
    "asof_null_keys",
    f"""SELECT p.event_id, coalesce(p.k, -1) AS k, p.ts, e.value AS error_value FROM (SELECT * FROM ({_SPARSE}) WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM ({_SPARSE}) WHERE event_type = 'error') e ON p.k = e.k AND p.ts >= e.ts""",
)
def asof_null_keys(spark, sf):
    """Keys that are NULL on both sides match nothing; with small pieces, all other keys are cut."""
    events = table(spark, sf, "events").withColumn("k", F.expr("CASE WHEN event_id % 3 > 0 THEN user_id END"))
    errors = events.filter("event_type = 'error'").select("k", F.col("ts").alias("error_ts"), F.col("value").alias("error_value"))
    purchases = events.filter("event_type = 'purchase'").select("event_id", "k", "ts")
    joined = asof_join(purchases, errors, ["k"], "ts", "error_ts", ["error_value"], piece_rows=20)
    return joined.withColumn("k", F.coalesce("k", F.lit(-1)))


@checks.add(
    "latest_per_group",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (SELECT *, row_number() OVER
    (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_shipdate DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def latest_per_group(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return ops.latest_per_key(lines, ["l_orderkey"], "l_linenumber")


@checks.add(
    "ordered_string_agg",
    """SELECT l_orderkey, string_agg(t, '^' ORDER BY l_linenumber, t) AS note_text FROM (SELECT l_orderkey, l_linenumber,
    concat(l_returnflag, '-', CAST(l_partkey AS VARCHAR)) AS t FROM lineitem) GROUP BY l_orderkey""",
)
def ordered_string_agg(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat_ws("-", "l_returnflag", F.col("l_partkey").cast("string")).alias("note_text"),
    )
    return ops.ordered_string_agg(lines, ["l_orderkey"], "l_linenumber", "note_text")


@checks.add(
    "bus_project",
    """SELECT props AS text, concat_ws('-', event_type, CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR)) AS msg_nm
    FROM events""",
)
def bus_project(spark, sf):
    events = table(spark, sf, "events").select(
        F.encode("props", "UTF-8").alias("body"), F.col("event_type").alias("partition"),
        F.col("user_id").cast("string").alias("offset"), F.col("event_id").alias("sequenceNumber"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
    )
    return bus.with_read_time(events).select("text", "msg_nm")


@checks.add(
    "parse_local_ts",
    """SELECT event_id, date_trunc('second', ts) + INTERVAL 6 HOUR AS t14, date_trunc('minute', ts) + INTERVAL 6 HOUR AS t12,
    date_trunc('day', ts) + INTERVAL 6 HOUR AS t8, CAST(NULL AS TIMESTAMP) AS bad FROM events""",
)
def parse_local_ts(spark, sf):
    events = table(spark, sf, "events")
    texts = events.select(
        "event_id",
        *(digits(F.col("ts"), n).alias(f"t{n}") for n in (14, 12, 8)),
        F.col("event_type").alias("bad"),
    )
    return comparable(times.parse_local(texts, ["t14", "t12", "t8", "bad"]))


@checks.add("parse_local_dst", f"SELECT l_orderkey, l_linenumber, l_partkey, {utc_sql('l_shipdate')} AS shipped FROM lineitem")
def parse_local_dst(spark, sf):
    """Over years with and without daylight saving time."""
    lines = table(spark, sf, "lineitem")
    texts = lines.select("l_orderkey", "l_linenumber", "l_partkey", digits(F.col("l_shipdate")).alias("shipped"))
    return comparable(times.parse_local(texts, ["shipped"]))


@checks.add(
    "tz_shift",
    """SELECT event_id, ts - INTERVAL 6 HOUR AS msg_tm, ts AS msg_enqueued_tsp,
    strftime(date_trunc('second', ts) - INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') || '-06:00' AS local FROM events""",
)
def tz_shift(spark, sf):
    ts = F.col("ts").cast("timestamp")
    events = table(spark, sf, "events").select(
        "event_id", ts.alias("msg_tm"), ts.alias("msg_enqueued_tsp"),
        times.local_text(F.date_trunc("second", ts)).alias("local"),
    )
    return comparable(times.shift_timestamps(events, ignore=("msg_enqueued_tsp",)))


@checks.add(
    "type_columns",
    """SELECT event_id, ts AS msg_tm, CAST(NULL AS TIMESTAMP) AS birth_dt, user_id AS pat_enc_csn_id,
    CAST(NULL AS VARCHAR) AS hsp_acct_id FROM events""",
)
def type_columns(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("string").alias("msg_tm"), F.col("event_type").alias("birth_dt"),
        F.col("user_id").cast("string").alias("pat_enc_csn_id"), F.col("props").alias("hsp_acct_id"),
    )
    typed = frames.type_columns(events, ["msg_tm", "birth_dt", "death_dt"])
    return comparable(typed.withColumn("hsp_acct_id", F.col("hsp_acct_id").cast("string")))


def _holes(spark, sf):
    return table(spark, sf, "events").select(
        F.when(F.col("event_type") != "view", F.col("event_id").cast("string")).alias("msg_src"),
        F.when(~F.col("event_type").isin("view", "click"), F.col("user_id").cast("string")).alias("pat_enc_csn_id"),
        F.when(~F.col("event_type").isin("view", "error"), F.col("value")).alias("value"),
    )


_HOLES = """(SELECT CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) END AS msg_src,
    CASE WHEN event_type NOT IN ('view', 'click') THEN CAST(user_id AS VARCHAR) END AS pat_enc_csn_id,
    CASE WHEN event_type NOT IN ('view', 'error') THEN value END AS value FROM events)"""


@checks.add("require_keys", f"SELECT * FROM {_HOLES} WHERE msg_src IS NOT NULL AND pat_enc_csn_id IS NOT NULL")
def require_keys(spark, sf):
    return frames.require_keys(_holes(spark, sf), ["msg_src", "pat_enc_csn_id"])


@checks.add("rejected_rows", f"SELECT * FROM {_HOLES} WHERE msg_src IS NULL OR pat_enc_csn_id IS NULL")
def rejected_rows(spark, sf):
    return frames.rejected(_holes(spark, sf), ["msg_src", "pat_enc_csn_id"])


@checks.add(
    "drop_all_null",
    f"SELECT *, 'loader' AS insert_user_id FROM {_HOLES} WHERE msg_src IS NOT NULL OR pat_enc_csn_id IS NOT NULL OR value IS NOT NULL",
)
def drop_all_null(spark, sf):
    return frames.prepare_append(_holes(spark, sf).withColumn("row_updt_tsp", F.lit(None).cast("timestamp")), "loader")


CHILD = TableSpec(
    "child",
    schema_of("msg_src string not null, msg_tm timestamp, pat_enc_csn_id decimal(18,0) not null, note string, extra string"),
    ("pat_enc_csn_id",),
)


@checks.add(
    "conform_schema",
    f"""WITH {H} SELECT 'STL' AS msg_src, msg_tm, pat_enc_csn_id, props AS note, CAST(NULL AS VARCHAR) AS extra FROM h""",
)
def conform_schema(spark, sf):
    rows = history(spark, sf).withColumn("msg_src", F.lit("STL")).withColumnRenamed("props", "note")
    return comparable(frames.conform(rows, CHILD))


@checks.add(
    "audit_stamp",
    """SELECT event_id, ts + INTERVAL 1 HOUR AS row_insert_tsp, ts + INTERVAL 1 HOUR AS row_updt_tsp,
    'loader' AS insert_user_id, 'loader' AS updt_user_id, ts AS msg_enqueued_tsp FROM events""",
)
def audit_stamp(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    later = F.col("ts") + F.expr("INTERVAL 1 HOUR")
    return frames.audit_stamp(events, later, "loader", enqueued="ts").drop("ts")


AS_OF = datetime.date(1999, 1, 1)
_EXPIRED = "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-12-30')"
_KEPT = f"(SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN {_EXPIRED})"


def _retired(spark, sf):
    """Lines are the history, a returned line's ship date its discharge; orders follow it."""
    lines = table(spark, sf, "lineitem")
    discharged = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    history = lines.withColumn("hosp_disch_tm", discharged)
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return retention.retire(history, {"child": orders}, orders, {"detail_child": lines}, ["l_orderkey"], as_of=AS_OF)


@checks.add("retention_expired", f"SELECT DISTINCT l_orderkey FROM {_EXPIRED}")
def retention_expired(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return retention.expired_keys(lines, ["l_orderkey"], "l_shipdate", AS_OF)


@checks.add("retention_master", f"SELECT {LINE} FROM lineitem WHERE l_orderkey NOT IN {_EXPIRED}")
def retention_master(spark, sf):
    return _retired(spark, sf)["history"].drop("hosp_disch_tm")


_ORDER_BY_LINE = ORDER.replace("o_orderkey", "o_orderkey AS l_orderkey")


@checks.add("retention_child", f"SELECT {_ORDER_BY_LINE} FROM orders WHERE o_orderkey IN {_KEPT}")
def retention_child(spark, sf):
    return _retired(spark, sf)["child"]


@checks.add(
    "retention_detail",
    f"SELECT {LINE} FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey IN {_KEPT})",
)
def retention_detail(spark, sf):
    return _retired(spark, sf)["detail_child"]


@checks.add(
    "purge_keys",
    "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def purge_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return retention.purge_keys(table(spark, sf, "orders"), lines, ["o_orderkey"])


NOW = datetime.datetime(2024, 1, 31, tzinfo=datetime.timezone.utc)
KINDS = ("click", "error", "purchase", "signup", "view")


def _fresh_sql(platform: str, kind: str, diff: str, hours: int) -> str:
    def lag(unit, a, b):
        return f"{diff}('{unit}', {a}, {b})"

    pairs = list(observe.LAGS.items())
    lags = ", ".join(f"{lag('second', a, b)} AS {name}" for name, (a, b) in pairs)
    late = " OR ".join(f"{lag('minute', a, b)} > 5" for _, (a, b) in pairs)
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("row_updt_tsp", "msg_tm", "tmstmp", "msg_enqueued_tsp"))
    return f"""SELECT '{platform}' AS platform, '{kind}' AS table_name, {texts}, {lags} FROM (
        SELECT max(ts + INTERVAL 200 SECOND) - INTERVAL {hours} HOUR AS row_updt_tsp, max(ts) - INTERVAL {hours} HOUR AS msg_tm,
        max(ts + INTERVAL 90 SECOND) - INTERVAL {hours} HOUR AS msg_enqueued_tsp,
        TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {hours} HOUR AS tmstmp FROM events WHERE event_type = '{kind}') WHERE {late}"""


@checks.add(
    "freshness_report",
    " UNION ALL ".join(
        _fresh_sql(p, k, *how) for p, *how in (("lake", "date_sub", 0), ("warehouse", "date_diff", 6)) for k in KINDS
    ),
)
def freshness_report(spark, sf):
    events = table(spark, sf, "events")

    def rows(kind):
        return events.filter(F.col("event_type") == kind).select(
            (F.col("ts") + F.expr("INTERVAL 200 SECOND")).alias("row_updt_tsp"), F.col("ts").alias("msg_tm"),
            (F.col("ts") + F.expr("INTERVAL 90 SECOND")).alias("msg_enqueued_tsp"),
        )

    def mirrored(kind):
        """As the mirror holds them: shifted to its wall clock."""
        instants = rows(kind).select(*(F.col(c).cast("timestamp").alias(c) for c in rows(kind).columns))
        shifted = times.shift_timestamps(instants)
        return shifted.select(*(F.col(c).cast("timestamp_ntz").alias(c) for c in shifted.columns))

    tables = {("lake", k): rows(k) for k in KINDS} | {("warehouse", k): mirrored(k) for k in KINDS}
    return observe.freshness_report(tables, NOW, boundary_platforms=["warehouse"], zones={"warehouse": times.LOCAL_ZONE})


@checks.add(
    "batch_metrics",
    f"""WITH {H} SELECT batch, count(*) AS batch_rows, max(msg_tm) AS latest_msg_tm, min(row_insert_tsp) AS first_insert_tsp,
    max(row_insert_tsp) AS last_insert_tsp FROM h GROUP BY batch""",
)
def batch_metrics(spark, sf):
    return observe.batch_metrics(history(spark, sf), ["batch"])


@checks.add(
    "top_one",
    "SELECT max(ts) AS latest, (SELECT event_id FROM events ORDER BY ts DESC LIMIT 1) AS event_id FROM events",
)
def top_one(spark, sf):
    return ops.top_one(table(spark, sf, "events"), "ts", {"latest": F.col("ts"), "event_id": F.col("event_id")})


@checks.add(
    "reconcile",
    """WITH a AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
    b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
          FROM orders WHERE o_orderpriority <> '1-URGENT')
    SELECT o_orderkey, status, CASE WHEN status IN ('match', 'mismatch') THEN concat_ws(',', s, t) ELSE '' END AS mismatched_cols FROM (
      SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
      CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END AS s,
      CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END AS t,
      CASE WHEN b.o_orderkey IS NULL THEN 'only_actual' WHEN a.o_orderkey IS NULL THEN 'only_expected'
           WHEN s IS NOT NULL OR t IS NOT NULL THEN 'mismatch' ELSE 'match' END AS status
      FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)""",
)
def reconcile(spark, sf):
    orders = table(spark, sf, "orders")
    actual = orders.filter("o_orderpriority <> '5-LOW'")
    expected = orders.filter("o_orderpriority <> '1-URGENT'").select(
        "o_orderkey", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END").alias("o_orderstatus"),
        F.expr("CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END").alias("o_totalprice"),
    )
    return comparable(observe.reconcile(actual, expected, ["o_orderkey"]))


@checks.add(
    "match_report",
    """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'mismatch' ELSE 'match' END AS status, count(*) AS rows
    FROM orders GROUP BY ALL""",
)
def match_report(spark, sf):
    orders = table(spark, sf, "orders")
    changed = orders.withColumn("o_orderstatus", F.expr("if(o_orderpriority = '1-URGENT', 'X', o_orderstatus)"))
    return observe.match_report(observe.reconcile(orders, changed, ["o_orderkey"]))


_RECONCILE_SIDES = """WITH a AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
    b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 977 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice
          FROM orders WHERE o_orderkey % 1009 <> 0)"""


@checks.add(
    "reconcile_digest",
    f"""{_RECONCILE_SIDES} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
      CASE WHEN b.o_orderkey IS NULL THEN 'only_actual' WHEN a.o_orderkey IS NULL THEN 'only_expected'
           WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'mismatch' ELSE 'match' END AS status,
      CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AND a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' ELSE '' END AS mismatched_cols
      FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
)
def reconcile_digest(spark, sf):
    """Two copies of a table with few differences, compared by ranges first."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    actual = orders.filter("o_orderpriority <> '5-LOW'").drop("o_orderpriority")
    changed = F.expr("CASE WHEN o_orderkey % 977 <> 0 THEN o_orderstatus END")
    expected = orders.filter("o_orderkey % 1009 <> 0").withColumn("o_orderstatus", changed).drop("o_orderpriority")
    return comparable(observe.reconcile_by_digest(actual, expected, ["o_orderkey"]))


_FEED = """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 1),
    n AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderkey % 10 <> 2)"""


def _states(spark, sf):
    orders = table(spark, sf, "orders")
    new = orders.filter("o_orderkey % 10 <> 2").withColumns({
        "o_orderstatus": F.expr("CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END"),
        "o_totalprice": F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"),
    })
    return orders.filter("o_orderkey % 10 <> 1"), new


@checks.add(
    "change_feed",
    f"""{_FEED} SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
      CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS op,
      o.o_orderstatus AS status_before, n.o_orderstatus AS status_after, o.o_totalprice AS price_before, n.o_totalprice AS price_after
      FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey
      WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice <> n.o_totalprice""",
)
def change_feed(spark, sf):
    found = feed.change_feed(*_states(spark, sf), ["o_orderkey"])
    images = [
        F.col(f"{image}.{c}").alias(f"{name}_{image}") for c, name in (("o_orderstatus", "status"), ("o_totalprice", "price")) for image in ("before", "after")
    ]
    return found.select("o_orderkey", "op", *images)


@checks.add("change_feed_applied", f"{_FEED} SELECT * FROM n")
def change_feed_applied(spark, sf):
    """The old state, with the feed between it and the new one, is the new one."""
    old, new = _states(spark, sf)
    return feed.apply_feed(old, feed.change_feed(old, new, ["o_orderkey"]), ["o_orderkey"])


@checks.add(
    "retention_days",
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_orderkey NOT IN
    (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-06-01 00:00:00' AND l_linenumber % 4 <> 0)""",
)
def retention_days(spark, sf):
    """Lines in a folder per day, every fourth one open; the keys of early days go, from whatever day."""
    shipped = F.when(F.col("l_linenumber") % 4 != 0, F.col("l_shipdate").cast("timestamp"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", shipped.alias("closed"))
    # Quarters, cut at the threshold, so that there are fewer folders than days of seven years.
    cut = F.lit("1996-06-01").cast("timestamp")
    begin = F.date_trunc("quarter", "closed")
    quarterly = lines.withColumn("closed", F.when(F.col("closed") >= cut, F.greatest(begin, cut)).otherwise(begin))
    store = retention.DayTable(spark, scratch_path(spark, "days"), quarterly.schema, "closed")
    store.append(quarterly)
    store.retire(["l_orderkey"], datetime.date(1996, 6, 3))
    return store.read().select("l_orderkey", "l_linenumber", "l_shipdate")


