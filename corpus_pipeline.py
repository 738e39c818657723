"""Documents to packed training sequences: five stages over the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import minhash, packing, pii, quality, repeats
from sparkloom.llm.catalogue import vocabulary_path
from sparkloom.llm.common import shared_dir
from sparkloom.session import table

#: Documents that score less are rejected.
LEAST_QUALITY = 0.3
#: Strings of so many words that start at two or more places are repeats: passages of over 50 words.
REPEATED_WORDS = 51


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model, LEAST_QUALITY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one that gives the group its id."""
    found = minhash.near_duplicates(docs, size=5, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    # documents that share one doc_id are all kept or all dropped with it
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of over 50 words that repeat; a document without any word left goes."""
    return repeats.without_repeats(docs, length=REPEATED_WORDS, first=17, unit=repeats.Words)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redacts personal data in the texts."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 4096 tokens."""
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json")).withColumnRenamed("queue", "source")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the trained stages; tests hold the operators, and the repeats stage as it runs here, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
