"""A streaming face for keyed loads: watermark, dedup inside it, and an idempotent upsert for each batch.

An extension of I4, K1 and K20: a re-read overlap becomes the watermark's delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from sparkloom.operators.tables import ManifestTable


def deduplicated(stream: DataFrame, time: str, keys: list[str], delay: str = "14 days") -> DataFrame:
    """Each key once inside the watermark; later rows than ``delay`` are dropped with their state."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], length: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Counts a tumbling window and key, emitted once the watermark has passed it."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.groupBy(F.window(time, length), *by).agg(F.count("*").alias("n"))


def upsert_batches(stream: DataFrame, folder: str, keys: list[str], order: list[str], checkpoint: str, buckets: int = 64, keep: int = 2) -> StreamingQuery:
    """Upserts each micro-batch into the :class:`ManifestTable` below ``folder``: only buckets with changed keys are rewritten.

    The manifest names the last batch, so a replay after a failure changes nothing; versions before the newest ``keep`` are deleted.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = ManifestTable(batch.sparkSession, folder, keys, buckets)
        table.merge(batch, [F.desc(c) for c in order], number)
        table.vacuum(keep)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, key: str, time: str, gap_seconds: int) -> DataFrame:
    """Batch sessions: a gap of more than ``gap_seconds`` begins the next."""
    w = Window.partitionBy(key).orderBy(time)
    gap = F.unix_seconds(F.col(time).cast("timestamp")) - F.unix_seconds(F.lag(time).over(w).cast("timestamp"))
    return events.withColumn("session", F.sum(F.when(gap > gap_seconds, 1).otherwise(0)).over(w))
