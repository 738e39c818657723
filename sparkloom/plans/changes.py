"""Dedup, change capture, upserts and incremental loads over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.operators import keyed, shape
from sparkloom.session import table

LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _lines(spark, sf_dir, descending):
    lines = table(spark, sf_dir, "lineitem")
    order = [F.desc(c) if descending else F.asc(c) for c in LINE_ORDER]
    return keyed.keep_one(lines, ["l_orderkey", "l_linenumber"], order).select(*LINE_COLUMNS)


def dedup_keep_first(spark, sf_dir):
    """The earliest line a key."""
    return _lines(spark, sf_dir, False)


def dedup_keep_last(spark, sf_dir):
    """The latest line a key."""
    return _lines(spark, sf_dir, True)


def _keep_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"SELECT {LINE_SQL} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"


def dedup_keep_max(spark, sf_dir):
    """Null-safe key, the largest id stays."""
    o = table(spark, sf_dir, "orders").withColumn("grp", F.nullif(F.col("o_custkey") % 50, F.lit(0)))
    return keyed.keep_one(o, ["grp", "o_orderpriority"], [F.desc("o_orderkey")]).select(F.coalesce("grp", F.lit(-1)).alias("grp"), "o_orderpriority", "o_orderkey")


DEDUP_KEEP_MAX = """SELECT coalesce(nullif(o_custkey % 50, 0), -1) AS grp, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL"""


def distinct_on_multi_key(spark, sf_dir):
    """A5: one line per part and flag, by price, then date, then key."""
    order = [F.desc("l_extendedprice"), F.desc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_suppkey"), F.asc("l_quantity")]
    return keyed.keep_one(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"], order).select("l_partkey", "l_returnflag", "l_orderkey", "l_extendedprice")


DISTINCT_ON = """SELECT l_partkey, l_returnflag, l_orderkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (
PARTITION BY l_partkey, l_returnflag ORDER BY l_extendedprice DESC, l_shipdate DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity) = 1"""


def max_version_per_key(spark, sf_dir):
    """Each user's newest event."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return keyed.keep_best(e, ["user_id"], F.struct("ts", "event_id")).select("user_id", "event_id", "event_type")


MAX_VERSION = "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


def cdc_apply(spark, sf_dir):
    """Additions, then changes, then deletions."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    base = o.where("o_orderkey % 3 <> 0")
    status = F.when(F.col("o_orderkey") % 3 == 0, "A").when(F.col("o_orderkey") % 5 == 0, "C").when(F.col("o_orderkey") % 7 == 0, "D")
    news = o.withColumn("status", status).where("status IS NOT NULL").withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("o_orderpriority", F.lit("new"))
    return keyed.apply_changes(base, news, ["o_orderkey"], "status", keep=("o_orderpriority",))


CDC_APPLY = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 <> 0"""


def _hashed(o):
    return o.withColumn("h", F.md5(F.concat_ws("|", "o_orderstatus", "o_orderpriority")))


def upsert_if_changed(spark, sf_dir):
    """Only rows whose digest differs are written, and only they get a new stamp."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    old = _hashed(o.where("o_orderkey % 4 <> 0")).withColumn("h", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("h"))).withColumn("stamp", F.lit("old"))
    new = _hashed(o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 6 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))).withColumn("stamp", F.lit("new"))
    return keyed.upsert_if_changed(old, new, ["o_orderkey"], "h")


UPSERT_IF_CHANGED = """WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_orderstatus AS old_s, o_orderpriority AS p FROM orders),
m AS (SELECT *, o_orderkey % 2 = 0 AND (o_orderkey % 4 = 0 OR o_orderkey % 10 = 0 OR s <> old_s) AS changed FROM n)
SELECT o_orderkey, CASE WHEN changed THEN s ELSE old_s END AS o_orderstatus, p AS o_orderpriority,
CASE WHEN changed THEN md5(s || '|' || p) WHEN o_orderkey % 10 = 0 THEN NULL ELSE md5(old_s || '|' || p) END AS h,
CASE WHEN changed THEN 'new' ELSE 'old' END AS stamp FROM m"""


def delete_missing_children(spark, sf_dir):
    """K5: lines that an order's new set lacks go; orders without a new set stay."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    new = lines.where("l_orderkey % 3 = 0 AND l_linenumber <= 3")
    return keyed.delete_missing(lines, new, ["l_orderkey"], ["l_linenumber"])


DELETE_MISSING = """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), n AS (SELECT * FROM l WHERE l_orderkey % 3 = 0 AND l_linenumber <= 3)
SELECT * FROM l WHERE l_orderkey NOT IN (SELECT l_orderkey FROM n) OR (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM n)"""


def insert_absent(spark, sf_dir):
    """customers' first orders that the target lacks."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keyed.insert_absent(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_orderkey"])


INSERT_ABSENT = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0"


def watermark_overlap(spark, sf_dir):
    """Per type the newest time, and what a re-read from 14 days before it covers."""
    e = table(spark, sf_dir, "events")
    mark = e.groupBy("event_type").agg(F.max("ts").alias("mark"))
    again = e.join(mark, "event_type").where(F.col("ts") >= F.col("mark") - F.expr("INTERVAL 14 DAYS"))
    return again.groupBy("event_type").agg(F.max("mark").alias("mark"), F.count("*").alias("n"))


WATERMARK = """WITH m AS (SELECT event_type, max(ts) AS mark FROM events GROUP BY 1)
SELECT event_type, max(mark) AS mark, count(*) AS n FROM events JOIN m USING (event_type) WHERE ts >= mark - INTERVAL 14 DAYS GROUP BY 1"""


def gap_detection(spark, sf_dir):
    """Hours without an event between a type's first and last."""
    e = table(spark, sf_dir, "events").select("event_type", F.date_trunc("HOUR", "ts").alias("h"))
    span = e.groupBy("event_type").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    grid = span.select("event_type", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("h"))
    return grid.join(e.distinct(), ["event_type", "h"], "left_anti").groupBy("event_type").agg(F.count("*").alias("missing_hours"))


GAP = """WITH e AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events),
s AS (SELECT event_type, min(h) AS a, max(h) AS b FROM e GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS h FROM s)
SELECT event_type, count(*) AS missing_hours FROM g ANTI JOIN e USING (event_type, h) GROUP BY 1"""


def stale_marking(spark, sf_dir):
    """Users not seen for three days before the newest event are offline."""
    events = table(spark, sf_dir, "events")
    now = F.lit(events.agg(F.max("ts")).first()[0])  # one value
    users = events.groupBy("user_id").agg(F.max("ts").alias("seen"))
    return users.select("user_id", F.when(F.col("seen") < now - F.expr("INTERVAL 3 DAYS"), "offline").otherwise("online").alias("state"))


STALE = """SELECT user_id, CASE WHEN max(ts) < (SELECT max(ts) FROM events) - INTERVAL 3 DAYS THEN 'offline' ELSE 'online' END AS state FROM events GROUP BY 1"""


def fail_streak(spark, sf_dir):
    """users' longest run of errors, and whether it is long enough to give up."""
    e = shape.streaks(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return e.groupBy("user_id").agg(F.max("streak").alias("worst"), (F.max("streak") >= 3).alias("dead"))


FAIL_STREAK = """WITH i AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
c AS (SELECT user_id, g, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n FROM i GROUP BY 1, 2)
SELECT user_id, CAST(max(n) AS BIGINT) AS worst, max(n) >= 3 AS dead FROM c GROUP BY 1"""


def transition_bounds(spark, sf_dir):
    """First change into and last change out of purchases, by user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("ok", F.col("event_type") == "purchase")
    e = e.withColumn("was", F.lag("ok").over(w)).withColumn("next", F.lead("ok").over(w))
    return e.groupBy("user_id").agg(
        F.min(F.when(F.col("ok") & ~F.coalesce("was", F.lit(False)), F.col("event_id"))).alias("first_in"),
        F.max(F.when(F.col("ok") & ~F.coalesce("next", F.lit(False)), F.col("event_id"))).alias("last_out"),
    )


TRANSITION = """WITH e AS (SELECT user_id, event_id, event_type = 'purchase' AS ok, lag(event_type = 'purchase') OVER w AS was, lead(event_type = 'purchase') OVER w AS next
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, min(event_id) FILTER (ok AND NOT coalesce(was, false)) AS first_in, max(event_id) FILTER (ok AND NOT coalesce(next, false)) AS last_out FROM e GROUP BY 1"""


def candles(spark, sf_dir):
    """Hourly bars with their derived columns."""
    e = table(spark, sf_dir, "events").withColumn("open_time", F.date_trunc("HOUR", "ts"))
    at = F.struct("ts", "event_id")
    bars = e.groupBy("event_type", "open_time").agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count("*").alias("n")
    )
    return bars.select(
        "*",
        F.hour("open_time").alias("hour_utc"),
        (F.dayofweek("open_time") - 1).alias("dow_utc"),
        (F.col("close") > F.col("open")).alias("is_green"),
        (F.col("high") - F.greatest("open", "close")).alias("upper_wick"),
        (F.least("open", "close") - F.col("low")).alias("lower_wick"),
    )


CANDLES = """WITH b AS (SELECT event_type, date_trunc('hour', ts) AS open_time, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS n FROM events GROUP BY 1, 2)
SELECT *, CAST(hour(open_time) AS INT) AS hour_utc, CAST(dayofweek(open_time) AS INT) AS dow_utc, close > open AS is_green, high - greatest(open, close) AS upper_wick, least(open, close) - low AS lower_wick FROM b"""


def promotion(spark, sf_dir):
    """Customers promoted, or skipped with the first reason, counted."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    reason = F.coalesce(F.when(F.col("c_acctbal") < 0, F.lit("negative")), F.when(F.col("n_name").rlike("^[A-C]"), F.lit("closed_nation")), F.lit("promoted"))
    return c.groupBy(reason.alias("outcome")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))


PROMOTION = """SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN regexp_matches(n_name, '^[A-C]') THEN 'closed_nation' ELSE 'promoted' END AS outcome, count(*) AS n, min(c_custkey) AS first_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""

QUERIES = {
    "dedup_keep_first": (dedup_keep_first, _keep_sql("ASC")),
    "dedup_keep_last": (dedup_keep_last, _keep_sql("DESC")),
    "dedup_keep_max": (dedup_keep_max, DEDUP_KEEP_MAX),
    "distinct_on_multi_key": (distinct_on_multi_key, DISTINCT_ON),
    "max_version_per_key": (max_version_per_key, MAX_VERSION),
    "cdc_apply": (cdc_apply, CDC_APPLY),
    "upsert_if_changed": (upsert_if_changed, UPSERT_IF_CHANGED),
    "delete_missing_children": (delete_missing_children, DELETE_MISSING),
    "insert_absent": (insert_absent, INSERT_ABSENT),
    "watermark_overlap": (watermark_overlap, WATERMARK),
    "gap_detection": (gap_detection, GAP),
    "stale_marking": (stale_marking, STALE),
    "fail_streak": (fail_streak, FAIL_STREAK),
    "transition_bounds": (transition_bounds, TRANSITION),
    "candles": (candles, CANDLES),
    "promotion": (promotion, PROMOTION),
}
