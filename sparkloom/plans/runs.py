"""Queries over runs, pending work and promotion, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import runs
from sparkloom.session import table


def run_lifecycle(spark, sf_dir):
    """users' events of a day as a run's log: a purchase completes it, an error fails it, eight hours of silence end it, else it runs at the newest event's time."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "purchase", "complete").when(F.col("event_type") == "error", "fail").otherwise(F.col("event_type"))
    lines = e.select(F.concat_ws(":", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("run"), "ts", kind.alias("kind"))
    return runs.run_states(lines, "run", "ts", "kind", e.agg(F.max("ts")).scalar(), "8 HOURS")


LIFECYCLE = """WITH l AS (SELECT user_id || ':' || strftime(ts, '%Y-%m-%d') AS run, ts, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS rank FROM events),
w AS (SELECT *, row_number() OVER r AS line, coalesce(lead(ts) OVER r, (SELECT max(ts) FROM events)) AS following FROM l WINDOW r AS (PARTITION BY run ORDER BY ts, rank)),
e AS (SELECT *, CASE WHEN rank = 0 THEN 'failed' WHEN rank = 1 THEN 'completed' WHEN following > ts + INTERVAL 8 HOURS THEN 'timed_out' END AS state FROM w),
f AS (SELECT run, min(line) FILTER (state IS NOT NULL) AS last, min(ts) AS begun, count(*) AS n FROM e GROUP BY 1)
SELECT f.run, coalesce(e.state, 'running') AS state, CASE WHEN e.state IS NULL THEN begun WHEN e.state = 'timed_out' THEN e.ts + INTERVAL 8 HOURS ELSE e.ts END AS since, coalesce(last, n) AS lines FROM f LEFT JOIN e ON e.run = f.run AND e.line = f.last"""


def promotion_backrefs(spark, sf_dir):
    """Customers that are pending get a target or the first reason why not; those promoted before keep theirs."""
    before = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), (F.col("s_suppkey") + 5_000_000).alias("promoted_id"), F.lit("2023-06-01").cast("timestamp").alias("promoted_at"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("bought")).distinct()
    source = table(spark, sf_dir, "customer").join(before, "c_custkey", "left").join(nations, "c_nationkey", "left").join(buyers, "c_custkey", "left")
    reasons = [("negative", F.col("c_acctbal") < 0), ("closed_nation", F.col("n_name").rlike("^[A-C]") | F.col("n_name").isNull()), ("no_orders", F.col("bought").isNull())]
    done = runs.promote(source, reasons, F.col("c_custkey") + 1_000_000, F.lit("2024-01-01").cast("timestamp"))
    return done.select("c_custkey", "promoted_id", "promoted_at", "skip_reason")


BACKREFS = """WITH s AS (SELECT c_custkey, s_suppkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN n_name IS NULL OR regexp_matches(n_name, '^[A-C]') THEN 'closed_nation'
WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'no_orders' END AS why FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_suppkey = c_custkey)
SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey + 5000000 WHEN why IS NULL THEN c_custkey + 1000000 END AS promoted_id,
CASE WHEN s_suppkey IS NOT NULL THEN TIMESTAMP '2023-06-01' WHEN why IS NULL THEN TIMESTAMP '2024-01-01' END AS promoted_at, CASE WHEN s_suppkey IS NULL THEN why END AS skip_reason FROM s"""


def pending_items(spark, sf_dir):
    """Parts whose latest shipment isn't through, or that have none."""
    state = F.when(F.col("l_returnflag") == "N", "completed").when(F.col("l_returnflag") == "R", "failed").otherwise("timed_out")
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_shipdate", state.alias("state"))
    return runs.pending(table(spark, sf_dir, "part").select("p_partkey"), shipped, "p_partkey", "l_shipdate")


PENDING = """WITH s AS (SELECT l_partkey, l_shipdate, CASE l_returnflag WHEN 'N' THEN 'completed' WHEN 'R' THEN 'failed' ELSE 'timed_out' END AS state FROM lineitem),
l AS (SELECT l_partkey, arg_max(state, (l_shipdate, CASE WHEN state = 'completed' THEN 1 ELSE 0 END, state)) AS last_state FROM s GROUP BY 1)
SELECT p_partkey, last_state FROM part LEFT JOIN l ON l_partkey = p_partkey WHERE last_state IS NULL OR last_state <> 'completed'"""

QUERIES = {
    "run_lifecycle": (run_lifecycle, LIFECYCLE),
    "promotion_backrefs": (promotion_backrefs, BACKREFS),
    "pending_items": (pending_items, PENDING),
}
