"""Run states against brute force, in one batch and as a stream in several, and promotion that a replay leaves alone."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sparkloom.operators import runs
from sparkloom.streaming.runs import STORE, run_transitions

BEGIN = dt.datetime(2024, 3, 1)
WAIT = dt.timedelta(hours=2)


def made(count):
    rng = random.Random(3)
    lines = []
    for run in range(count):
        at = BEGIN + dt.timedelta(minutes=rng.randint(0, 600))
        for _ in range(rng.randint(1, 6)):
            lines += [(run, at, rng.choices(["start", "page", "fail", "complete"], [4, 4, 1, 1])[0])] * rng.randint(1, 2)
            at += dt.timedelta(minutes=rng.choice([0, 10, 50, 119, 120, 121, 200]))
    rng.shuffle(lines)
    return lines


def brute(lines, now):
    out = {}
    for run in {r for r, _, _ in lines}:
        state, last, begun, n = "running", None, None, 0
        for _, at, kind in sorted((x for x in lines if x[0] == run), key=lambda x: (x[1], {"fail": 0, "complete": 1}.get(x[2], 2))):
            if last is not None and at > last + WAIT:
                state = "timed_out"
                break
            last, begun, n = at, begun or at, n + 1
            if kind in ("fail", "complete"):
                state = {"fail": "failed", "complete": "completed"}[kind]
                break
        if state == "running" and now > last + WAIT:
            state = "timed_out"
        out[run] = (state, {"running": begun, "timed_out": last + WAIT}.get(state, last), n)
    return out


def test_states_equal_brute_force(spark):
    lines = made(120)
    frame = spark.createDataFrame([*lines, (None, BEGIN, "start"), (500, None, "start")], "run int, at timestamp, kind string")
    for now in (BEGIN + dt.timedelta(hours=9), BEGIN + dt.timedelta(days=2)):
        got = runs.run_states(frame, "run", "at", "kind", F.lit(now), "2 HOURS").collect()
        want = brute(lines, now)
        assert {r.run: (r.state, r.since, r.lines) for r in got} == want and len(got) == 120
    assert {s for s, _, _ in want.values()} == {"completed", "failed", "timed_out"}
    assert runs.run_states(frame.where("false"), "run", "at", "kind", F.lit(now), "2 HOURS").count() == 0


def test_stream_ends_in_the_same_states(spark, tmp_path):
    lines = made(25)
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        shape = "run int, at timestamp, kind string"
        # lines in any order within the delay, then one far behind, so that the watermark passes all
        for i in range(3):
            spark.createDataFrame(lines[i::3], shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        spark.createDataFrame([(-1, BEGIN + dt.timedelta(days=9), "start")], shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for attempt in ("one", "two"):
            stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 2 if attempt == "one" else 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
            moved = run_transitions(stream, "run", "at", "kind", WAIT, "3 days")
            query = moved.writeStream.format("parquet").option("path", str(tmp_path / attempt)).option("checkpointLocation", str(tmp_path / f"ck-{attempt}")).trigger(availableNow=True).start()
            query.awaitTermination()
        for attempt in ("one", "two"):
            rows = spark.read.parquet(str(tmp_path / attempt)).collect()
            last = {r.run: (r.state, r.since, r.lines) for r in rows if r.state != "running"}
            assert last == brute(lines, BEGIN + dt.timedelta(days=5)) and sum(r.state == "running" for r in rows if r.run >= 0) == 25
    finally:
        for name in STORE:
            spark.conf.unset(name)


def test_pending_work(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d")], "item int, text string")
    log = spark.createDataFrame([(1, 1, "failed"), (1, 2, "completed"), (2, 1, "completed"), (2, 3, "timed_out"), (4, 1, "failed")], "item int, started int, state string")
    got = sorted((r.item or 0, r.text, r.last_state) for r in runs.pending(items, log, "item", "started").collect())
    assert got == [(0, "d", None), (2, "b", "timed_out"), (2, "b", "timed_out"), (3, "c", None)]


def test_promotion_is_idempotent(spark):
    rows = [(1, 5.0, "x"), (2, -1.0, "x"), (3, -1.0, None), (4, None, "y"), (5, 1.0, None)]
    source = spark.createDataFrame(rows, "id int, worth double, city string")
    stamp = F.lit("2024-01-01").cast("timestamp")
    rules = [("no_city", F.col("city").isNull()), ("no_worth", F.col("worth") < 0)]
    once = runs.promote(source, rules, F.col("id") + 100, stamp)
    assert [(r.id, r.promoted_id, r.skip_reason) for r in once.orderBy("id").collect()] == [(1, 101, None), (2, None, "no_worth"), (3, None, "no_city"), (4, 104, None), (5, None, "no_city")]
    again = runs.promote(once, rules, F.col("id") + 100, stamp)
    assert again.orderBy("id").collect() == once.orderBy("id").collect()
    later = F.lit("2024-02-01").cast("timestamp")
    mended = runs.promote(once.withColumn("city", F.lit("z")), rules, F.col("id") + 100, later)
    assert {r.outcome: r.n for r in runs.promotion_counts(mended, later).collect()} == {"promoted": 1, "promoted_before": 2, "no_worth": 2}
