"""Runs and what they leave behind: states from log lines, work still to do, promotion with reasons and back-references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Kinds of lines that end a run, and the state that it then has; of lines of one time the first here counts.
ENDINGS = {"fail": "failed", "complete": "completed"}


def run_states(lines: DataFrame, run: str, time: str, kind: str, now: Column, patience: str) -> DataFrame:
    """``(run, state, since, lines)`` of log lines: ``completed`` or ``failed`` by the first line that says so, ``timed_out`` where
    none follows within ``patience``, else ``running`` since its first line (I13).

    Lines behind a run's end count for nothing. A run is silent up to ``now``, one value or a column that is equal in all lines.
    Lines without a run or time are left out. :func:`sparkloom.streaming.runs.run_transitions` gives the same states of a stream.
    """
    at = F.col(time)
    rank = F.coalesce(*[F.when(F.col(kind) == k, i) for i, k in enumerate(ENDINGS)], F.lit(len(ENDINGS)))
    held = lines.where(F.col(run).isNotNull() & at.isNotNull()).select(F.col(run).alias("run"), at.alias("at"), rank.alias("rank"), now.alias("now"))
    spot = Window.partitionBy("run").orderBy("at", "rank")
    wait = F.expr(f"INTERVAL {patience}")
    each = held.select("*", F.coalesce(F.lead("at").over(spot), F.greatest("now", "at")).alias("following"), F.row_number().over(spot).alias("line"))
    state = F.coalesce(*[F.when(F.col("rank") == i, F.lit(s)) for i, s in enumerate(ENDINGS.values())], F.when(F.col("following") > F.col("at") + wait, F.lit("timed_out")))
    ends = F.when(F.col("rank") < len(ENDINGS), F.col("at")).otherwise(F.col("at") + wait)
    over = F.min(F.when(state.isNotNull(), F.struct(ends.alias("ends"), "rank", "line", state.alias("state"))))
    whole = each.groupBy("run").agg(over.alias("over"), F.min("at").alias("begun"), F.count("*").alias("lines"))
    return whole.select(F.col("run").alias(run), F.coalesce("over.state", F.lit("running")).alias("state"), F.coalesce("over.ends", "begun").alias("since"), F.coalesce("over.line", "lines").cast("bigint").alias("lines"))


def pending(items: DataFrame, runs: DataFrame, item: str, started: str, state: str = "state") -> DataFrame:
    """Items whose latest run isn't ``completed``, or that have none, with that run's ``last_state``.

    Of runs started at one time a completed one counts. Rows of ``items`` stay as they are, repeated ones too.
    """
    latest = runs.groupBy(F.col(item).alias("__item")).agg(F.max_by(state, F.struct(started, (F.col(state) == "completed").alias("done"), state)).alias("last_state"))
    joined = items.join(latest, F.col(item).eqNullSafe(F.col("__item")), "left").drop("__item")
    return joined.where("last_state IS NULL OR last_state <> 'completed'")


def promote(source: DataFrame, reasons: list[tuple[str, Column]], target_id: Column, stamp: Column) -> DataFrame:
    """``source`` with ``promoted_id``, ``promoted_at`` and ``skip_reason`` set on its pending rows, those not ``promoted_at`` yet.

    A pending row has the first reason whose condition is true, and no target then; the others name their target, which must come
    from the row alone, so that a repeated call changes nothing. Promoted rows stay and have no reason. One pass without a shuffle:
    the new targets are the rows whose ``promoted_at`` is ``stamp``, counters a :func:`promotion_counts` of the result.
    """
    given = {c: F.col(c) if c in source.columns else F.lit(None) for c in ("promoted_id", "promoted_at")}
    open_ = given["promoted_at"].isNull()
    why = F.when(open_, F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons], F.lit(None).cast("string")))
    known = [c for c in source.columns if c not in ("promoted_id", "promoted_at", "skip_reason")]
    judged = source.select(*known, F.struct(*[c.alias(n) for n, c in given.items()], why.alias("why"), open_.alias("open"), target_id.alias("new"), stamp.alias("stamp")).alias("__p"))
    takes = F.col("__p.open") & F.col("__p.why").isNull()
    return judged.select(
        *known, F.when(takes, F.col("__p.new")).otherwise(F.col("__p.promoted_id")).alias("promoted_id"),
        F.when(takes, F.col("__p.stamp")).otherwise(F.col("__p.promoted_at")).alias("promoted_at"), F.col("__p.why").alias("skip_reason"),
    )


def promotion_counts(promoted: DataFrame, stamp: Column) -> DataFrame:
    """``(outcome, n)``: rows promoted now, promoted before, and skipped by reason."""
    outcome = F.coalesce("skip_reason", F.when(F.col("promoted_at") == stamp, F.lit("promoted")), F.lit("promoted_before"))
    return promoted.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
