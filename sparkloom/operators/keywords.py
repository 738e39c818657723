"""Keyword dimensions: the longest keyword that a text contains (J16, C3), and names that begin alike."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Characters of keywords that one automaton holds; a larger table is matched in as many passes as it needs.
AUTOMATON = 4_000_000


def longest_keyword(df: DataFrame, text: str, keywords: DataFrame, keyword: str, order: str, most: int = AUTOMATON) -> DataFrame:
    """``df`` with ``keyword`` and ``keyword_order``: the longest keyword that ``text`` contains, ties by the table's ``order``.

    One pass of an automaton over each text finds all keywords at once. The table is dealt into parts of at most ``most``
    characters by their sum; parts are matched one behind the other in the same tasks, each keeping the better find, so
    nothing is shuffled. Empty keywords match nothing; of equal keywords the first in order counts. Texts that are null keep null.
    """
    distinct = keywords.where(F.length(keyword) > 0).groupBy(F.col(keyword).alias("word")).agg(F.min(order).cast("bigint").alias("at"))
    size = distinct.agg(F.sum(F.length("word"))).first()[0] or 0
    parts = max(1, -(-int(size * 1.2) // most)) if size > most else 1
    out = df.withColumns({"keyword": F.lit(None).cast("string"), "keyword_order": F.lit(None).cast("bigint")})
    at_text, columns = df.columns.index(text), len(df.columns)
    for part in range(parts):
        held = [(r.word, r["at"]) for r in distinct.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).toLocalIterator()]
        out = out.mapInArrow(matcher(df.sparkSession.sparkContext.broadcast(held), at_text, columns), out.schema)
    return out


def matcher(held, at_text: int, columns: int):
    """Takes the better of a row's keyword so far and the longest of ``held`` in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, at in held.value:
            automaton.add_word(word, (len(word), -at, word))
        filled = len(automaton) > 0
        if filled:
            automaton.make_automaton()
        for batch in batches:
            words, places = batch.column(columns).to_pylist(), batch.column(columns + 1).to_pylist()
            for i, text in enumerate(batch.column(at_text).to_pylist()):
                if text and filled:
                    best = max((value for _, value in automaton.iter(text)), default=None)
                    if best and (words[i] is None or best[:2] > (len(words[i]), -places[i])):
                        words[i], places[i] = best[2], -best[1]
            arrays = [*batch.columns[:columns], pa.array(words, batch.schema.field(columns).type), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return run


def prefix_matches(names: DataFrame, name: str, dimension: DataFrame, key: str, least: int = 3) -> DataFrame:
    """``(name, key)`` of distinct values where one begins with the other, both of at least ``least`` characters: an equi join on beginnings."""
    beginnings = lambda c: F.explode(F.transform(F.sequence(F.lit(least), F.length(c)), lambda n: F.substring(F.col(c), F.lit(1), n)))
    a = names.select(F.col(name).alias("a")).where(F.length(name) >= least).distinct()
    b = dimension.select(F.col(key).alias("b")).where(F.length(key) >= least).distinct()
    inside = a.withColumn("k", beginnings("a")).join(b.withColumn("k", F.col("b")), "k").select("a", "b")
    around = b.withColumn("k", beginnings("b")).join(a.withColumn("k", F.col("a")), "k").where("a <> b").select("a", "b")
    return inside.union(around).toDF(name, key)


def cascade(df: DataFrame, name: str, dimension: DataFrame, key: str, aliases: DataFrame, alias: str, suffix: str, least: int = 3) -> DataFrame:
    """``df`` with ``key`` and ``tier``: exact name, alias, name without a suffix (a pattern at its end), then a beginning either way.

    Among beginnings the one that shares most characters wins, then the smaller key. ``aliases`` holds ``alias`` and the key it
    stands for; of several the smallest counts. Names that are null, or that no tier finds, keep null.
    """
    known = dimension.select(F.col(key).alias("__key")).where(F.col(key).isNotNull()).distinct()
    stood = aliases.groupBy(F.col(alias).alias("__alias")).agg(F.min(key).alias("__stood"))
    stripped = F.regexp_replace(name, f"(?:{suffix})$", "")
    values = df.select(name).where(F.col(name).isNotNull()).distinct().withColumn("__strip", stripped)
    exact = values.join(known.select(F.col("__key").alias(name), F.col("__key").alias("__exact")), name, "left")
    named = exact.join(stood.withColumnRenamed("__alias", name), name, "left")
    bare = named.join(known.select(F.col("__key").alias("__strip"), F.col("__key").alias("__bare")), "__strip", "left")
    rest = bare.where(F.coalesce("__exact", "__stood", "__bare").isNull())
    begun = prefix_matches(rest, name, known.withColumnRenamed("__key", key), key, least)
    order = Window.partitionBy(name).orderBy(F.desc(F.least(F.length(name), F.length(key))), key)
    begun = begun.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").select(name, F.col(key).alias("__begun"))
    found = bare.join(begun, name, "left")
    tiers: list[tuple[str, str]] = [("__exact", "exact"), ("__stood", "alias"), ("__bare", "suffix"), ("__begun", "prefix")]
    tier: Column = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(label)) for c, label in tiers])
    return df.join(found.select(name, F.coalesce(*[c for c, _ in tiers]).alias(key), tier.alias("tier")), name, "left")
