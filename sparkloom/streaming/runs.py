"""Run states as a stream: keyed state with event-time timers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from sparkloom.operators.runs import ENDINGS

#: Timers and stored lines need this state store.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Lifecycle(StatefulProcessor):
    """A run's lines wait in state until the watermark has passed them, and are then taken in the order of their times.

    So the transitions don't depend on how lines fall into batches. A timer stands at each waiting time, and one where patience ends.
    An ended run keeps its end alone for another ``patience``, in which late lines meet it.
    """

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at bigint, rank int", "n bigint")
        self.run = handle.getValueState("run", "state string, last bigint, lines bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timers = set()
        for batch in rows:
            for (at, rank), n in batch.groupby(["at", "rank"]).size().items():
                line = (int(at), int(rank))
                before = self.waiting.getValue(line)[0] if self.waiting.containsKey(line) else 0
                self.waiting.updateValue(line, (before + int(n),))
                timers.add(int(at))
        for at in timers:
            # timers are kept in milliseconds; one behind the line's own
            self.handle.registerTimer(at // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # up to the watermark at once: a timer set here that is due already would wait for the next batch
        now = timerValues.getCurrentWatermarkInMs() * 1000
        state, last, lines = self.run.get() if self.run.exists() else (None, None, 0)
        out = []

        def move(to: str, at: int) -> None:
            nonlocal state
            state = to
            out.append((key[0], to, at, lines))

        for line, held in sorted((tuple(k), v[0]) for k, v in self.waiting.iterator()):
            at, rank = line
            if at >= now:
                break
            self.waiting.removeKey(line)
            if state not in (None, "running"):
                continue
            if state and at > last + self.patience:
                move("timed_out", last + self.patience)
                continue
            ends = rank < len(ENDINGS)
            lines, last = lines + (1 if ends else held), at
            if state is None:
                move("running", at)
            if ends:
                move(list(ENDINGS.values())[rank], at)
        if state == "running" and now > last + self.patience:
            move("timed_out", last + self.patience)
        if state == "running":
            self.handle.registerTimer((last + self.patience) // 1000 + 1)
        self.run.update((state, last, lines)) if state else None
        if state not in (None, "running") and now > last + 2 * self.patience and not any(True for _ in self.waiting.iterator()):
            self.run.clear()
        elif state not in (None, "running"):
            self.handle.registerTimer(max(now // 1000, (last + 2 * self.patience) // 1000) + 1)
        if out:
            yield pd.DataFrame(out, columns=["run", "state", "since", "lines"])


def run_transitions(stream: DataFrame, run: str, time: str, kind: str, patience: dt.timedelta, delay: str = "1 hour") -> DataFrame:
    """``(run, state, since, lines)``: a row when a run begins, and one when it is completed, failed or timed out.

    The last row of a run is its state as :func:`sparkloom.operators.runs.run_states` gives it at the watermark. Lines later than
    ``delay`` are dropped; lines without a run or time too. The session needs :data:`STORE`.
    """
    at = F.col(time).cast("timestamp")
    rank = F.coalesce(*[F.when(F.col(kind) == k, i) for i, k in enumerate(ENDINGS)], F.lit(len(ENDINGS)))
    lines = stream.where(F.col(run).isNotNull() & at.isNotNull()).select(F.col(run).alias("run"), at.alias("time"), F.unix_micros(at).alias("at"), rank.alias("rank")).withWatermark("time", delay)
    kept = lines.groupBy("run").transformWithStateInPandas(Lifecycle(int(patience.total_seconds() * 1e6)), f"run {stream.schema[run].dataType.simpleString()}, state string, since bigint, lines bigint", "Append", "EventTime")
    return kept.select(F.col("run").alias(run), "state", F.timestamp_micros("since").alias("since"), "lines")
