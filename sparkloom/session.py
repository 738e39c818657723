"""Session settings shared by tests, bench and examples."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library counts on; a cluster's own submit configuration comes on top.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sparkloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; keys of ``extra`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """The session with a folder for checkpoints: the one it names, or, on a local master only, one below the temporary folder."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate files below ``spark.checkpoint.dir``; where that is unset, on a local master only, below the temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
