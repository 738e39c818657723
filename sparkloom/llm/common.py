"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its counted rows times this many bytes stay below it.
BROADCAST_BYTES = 16_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a folder of this machine serves a local master only: on a cluster, each executor would
    write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sparkloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Workspace:
    """Intermediate Parquet tables of one call in the shared folder: each cuts its lineage, and is dropped once it is used."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, codec: str = "snappy", **options: object) -> DataFrame:
        """``df`` written as table ``name`` and read back."""
        df.write.options(compression=codec, **options).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` as one table of the shared folder that stays."""
    return Workspace(df.sparkSession, label).keep(df, "table")


def few(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted size is below ``limit``, else left to a shuffle join.

    ``df`` must be materialized, so that counting it is cheap.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def by_size(batches: Iterator[pa.RecordBatch], column: int, characters: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of texts of about so many bytes together."""
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + characters, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Smallest reachable id per node that has an edge: columns ``node`` and ``component``.

    Alternating large-star and small-star rounds over a shrinking edge table, each
    round written to the shared folder. A hub's edges are never gathered in one
    group: each round takes a minimum per node (combined map-side) and joins it back.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    pairs = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        pairs = materialize(small, "cc")
        state = pairs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if state == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state


def replace_column(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with ``name`` replaced in place, other columns kept as they are."""
    return df.select(*[value.alias(name) if c == name else F.col(f"`{c}`") for c in df.columns])
