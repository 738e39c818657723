"""Keyed tables on storage: merges rewrite only the buckets that hold changed keys; loads are checked and counted in the pass that writes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.keyed import keep_one, upsert

BUCKET = "__bucket"


class ManifestTable:
    """A table below ``folder``: Parquet folders of hash buckets, and numbered manifests that say which folder holds which bucket.

    A merge reads and rewrites the buckets of its keys, then adds the next manifest in one step: readers see the old
    version or the new one. A manifest that exists is never replaced, so of two merges at once the later one fails. The number
    of buckets is fixed by the first merge.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int = 64):
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), keys, buckets
        self.jvm = spark.sparkContext._jvm
        self.files = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def versions(self) -> list[int]:
        """Numbers of the manifests, newest last."""
        place = self.path("_manifests")
        if not self.files.exists(place):
            return []
        return sorted(int(f.getPath().getName()[:-5]) for f in self.files.listStatus(place) if f.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """``{"version", "batch", "schema", "buckets": {bucket: folder}}``; an empty one before the first merge."""
        numbers = self.versions()
        if not numbers:
            return {"version": 0, "batch": None, "schema": None, "n": self.buckets, "buckets": {}}
        stream = self.files.open(self.path(f"_manifests/{version or numbers[-1]}.json"))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def commit(self, manifest: dict) -> None:
        """Adds a manifest: written aside, then renamed to a name that must be new."""
        place, aside = self.path(f"_manifests/{manifest['version']}.json"), self.path(f"_manifests/.{uuid.uuid4().hex}")
        self.files.mkdirs(self.path("_manifests"))
        out = self.files.create(aside, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self.files.exists(place) or not self.files.rename(aside, place):
            self.files.delete(aside, False)
            raise RuntimeError(f"version {manifest['version']} of {self.folder} was written by another merge")

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The newest or a given version; with ``only`` just these buckets."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.folder} holds no version yet")
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(m["schema"])
        places = [f"{self.folder}/{f}" for b, f in sorted(m["buckets"].items()) if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def merge(self, source: DataFrame, order: list[Column], batch: int | None = None) -> list[int]:
        """Upserts ``source``, of several rows of a key the first in ``order``; the buckets that were rewritten.

        A ``batch`` that isn't newer than the last one has been merged before and changes nothing.
        """
        m = self.manifest()
        if batch is not None and m["batch"] is not None and batch <= m["batch"]:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(m["n"])).cast("int")
        name = f"data/{m['version'] + 1}-{uuid.uuid4().hex}"
        staged = f"{self.folder}/{name}-source"
        keep_one(source, self.keys, order).withColumn(BUCKET, bucket).write.parquet(staged)  # the source is computed once
        news = self.spark.read.parquet(staged)
        touched = sorted(r[0] for r in news.select(BUCKET).distinct().collect())  # as many as there are buckets, at most
        if touched:
            merged = news.drop(BUCKET)
            if m["schema"] is not None:
                merged = upsert(self.read(only=touched), merged, self.keys)
            merged.withColumn(BUCKET, bucket).repartition(len(touched), BUCKET).write.partitionBy(BUCKET).parquet(f"{self.folder}/{name}")
            schema = json.loads(merged.schema.json())
        else:
            schema = m["schema"] or json.loads(news.drop(BUCKET).schema.json())
        self.files.delete(self.path(f"{name}-source"), True)
        moved = {str(b): f"{name}/{BUCKET}={b}" for b in touched}
        self.commit({"version": m["version"] + 1, "batch": m["batch"] if batch is None else batch, "schema": schema, "n": m["n"], "buckets": m["buckets"] | moved})
        return touched

    def vacuum(self, keep: int = 2) -> int:
        """Deletes manifests before the newest ``keep`` and the buckets that none of these name; how many folders went."""
        numbers = self.versions()
        named = {f for v in numbers[-keep:] for f in self.manifest(v)["buckets"].values()}
        newest = numbers[-1] if numbers else 0
        for v in numbers[:-keep]:
            self.files.delete(self.path(f"_manifests/{v}.json"), False)
        gone = 0
        for merge in self.files.listStatus(self.path("data")) if numbers else []:
            label = merge.getPath().getName()
            if int(label.partition("-")[0]) > newest:
                continue  # a merge under way
            inside = list(self.files.listStatus(merge.getPath()))
            unused = [f for f in inside if f"data/{label}/{f.getPath().getName()}" not in named]
            for f in unused:
                gone += f.getPath().getName().startswith(BUCKET)
                self.files.delete(f.getPath(), True)
            if len(unused) == len(inside):
                self.files.delete(merge.getPath(), True)
        return gone


def checked_load(df: DataFrame, rules: dict[str, Column], folder: str, destinations: dict[str, Callable[[DataFrame], None]] | None = None) -> tuple[dict, DataFrame, DataFrame]:
    """Writes ``df`` once below ``folder``, rows that break a rule apart, with counts from the same pass.

    As with CHECK constraints a rule that is null isn't broken. Returns the counts (``rows``, ``loaded``, one for each rule, and ``ok`` or the failure of each
    destination), the rows that passed, and the others with the names of the ``violations``. Destinations get what passed, as stored, so ``df``
    is computed once whatever their number; the first must succeed, the others' failures are reported.
    """
    broken = {name: ~F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    listed = F.filter(F.array(*[F.when(b, F.lit(name)) for name, b in broken.items()]).cast("array<string>"), lambda x: x.isNotNull())
    marked = df.withColumn("violations", listed).withColumn("__passed", F.size("violations") == 0)
    counts = Observation()
    one = lambda name: F.count_if(F.array_contains("violations", name)).alias(name)
    marked.observe(counts, F.count("*").alias("rows"), F.count_if("__passed").alias("loaded"), *map(one, rules)).write.partitionBy("__passed").parquet(folder)
    stored = df.sparkSession.read.schema(marked.schema).parquet(folder)
    passed, failed = stored.where("__passed").select(*df.columns), stored.where("NOT __passed").select(*df.columns, "violations")
    report = dict(counts.get)
    for i, (name, write) in enumerate((destinations or {}).items()):
        try:
            write(passed)
            report[name] = "ok"
        except Exception as error:  # noqa: BLE001 - mirrors are best effort
            if not i:
                raise
            report[name] = f"failed: {error}"[:200]
    return report, passed, failed
