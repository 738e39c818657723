"""Sitemaps as tables: indexes and lists of pages are told apart file by file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.sources.files import read_xml

PAGE = "loc string, lastmod string, news struct<publication_date: string, title: string>"
PART = "loc string, lastmod string"


def stamp(text: Column) -> Column:
    """A date or a time with its zone; null for anything else."""
    return text.try_cast("timestamp")


def read_sitemaps(spark: SparkSession, path: str, cutoff: dt.datetime, pattern: str | None = None, most: int | None = None) -> DataFrame:
    """``(url, title, published)`` of the pages that the sitemaps below ``path`` list, at most ``most`` (a feature, not a guard).

    Of an index, parts that were changed before ``cutoff`` are passed over with all they list; a part is the file below ``path`` of the
    name at the end of its place. Parts don't judge their pages by date. A file that no index names is a list of its own: its pages
    dated before ``cutoff`` go. The date is the news date, else the last change; pages without one, or with one that can't be read, stay.
    ``pattern`` must be found in the URL. Pages without a place go. With ``most``, newest pages come first, ties by URL.
    """
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    found = lambda c: F.nullif(F.trim(c), F.lit(""))
    before = lambda text: F.coalesce(stamp(text) < F.lit(cutoff), F.lit(False))
    parts = read_xml(spark, path, "sitemap", PART).select(F.element_at(F.split(found(F.col("loc")), "/"), -1).alias("file"), found(F.col("lastmod")).alias("changed"))
    # a part that two indexes name is taken if either takes it
    parts = parts.where("file IS NOT NULL").groupBy("file").agg(F.max(~before(F.col("changed"))).alias("taken"))
    pages = read_xml(spark, path, "url", PAGE).select(file.alias("file"), found(F.col("loc")).alias("url"), found(F.col("news.title")).alias("title"), found(F.col("news.publication_date")).alias("dated"), found(F.col("lastmod")).alias("changed"))
    pages = pages.where("url IS NOT NULL")
    if pattern:
        pages = pages.where(F.col("url").rlike(pattern))
    joined = pages.join(parts, "file", "left")
    own = F.col("taken").isNull()
    published = F.when(own, F.coalesce("dated", "changed")).otherwise(F.col("changed"))
    kept = joined.where(F.coalesce("taken", ~before(F.coalesce("dated", "changed"))))
    kept = kept.select("url", F.when(own, F.coalesce("title", F.lit(""))).otherwise("").alias("title"), published.alias("published"))
    return kept if most is None else kept.orderBy(F.desc_nulls_last(stamp(F.col("published"))), "url").limit(most)
