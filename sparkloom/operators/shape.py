"""Conformance, reshaping and ordered-sequence operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def resolve(df: DataFrame, *names: str) -> Column:
    """The first column that exists: exact names in order, then without regard to case; null if none."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    lower = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in lower:
            return F.col(lower[name.lower()])
    return F.lit(None)


def conform(df: DataFrame, schema: StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, drop unknown columns, pad absent ones with null, and cast."""
    df = df.withColumnsRenamed(renames or {})
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def nulls_for_empty(df: DataFrame) -> DataFrame:
    """Empty strings become null in every string column."""
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def fold_triples(triples: DataFrame, s: str = "s", p: str = "p", o: str = "o") -> DataFrame:
    """One row a subject with a map of predicate to its sorted objects."""
    folded = triples.groupBy(s, p).agg(F.array_sort(F.collect_list(o)).alias("__o"))
    return folded.groupBy(s).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(p, "__o")))).alias("attributes"))


def majority(df: DataFrame, keys: list[str], label: str, order: Column) -> DataFrame:
    """The most frequent label a key; ties go to the one seen first."""
    counted = df.groupBy(*keys, label).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "__first", label))
    return counted.withColumn("__rank", rank).where("__rank = 1").select(*keys, label, "n")


def unpivot_pairs(df: DataFrame, ids: list[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Pairs of (value, companion) columns as rows; rows without a numeric value go."""
    rows = [F.struct(F.lit(k).alias("name"), F.col(v).try_cast("double").alias("value"), F.col(c).try_cast("double").alias("companion")) for k, (v, c) in pairs.items()]
    return df.select(*ids, F.explode(F.array(*rows)).alias("x")).select(*ids, "x.*").where("value IS NOT NULL")


def forward_fill(df: DataFrame, keys: list[str], order: list[str | Column], header: Column, value: Column, name: str) -> DataFrame:
    """Carries the last header's value on; a header whose value is null resets it."""
    seen = F.last(F.when(header, F.struct(value.alias("v"))), ignorenulls=True)
    return df.withColumn(name, seen.over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))["v"])


def streaks(df: DataFrame, keys: list[str], order: list[str | Column], failed: Column, name: str = "streak") -> DataFrame:
    """Failures in a row up to and with each row; a success sets it back to zero."""
    w = Window.partitionBy(*keys).orderBy(*order)
    island = F.sum(F.when(failed, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    with_island = df.withColumn("__island", island).withColumn("__bad", failed.cast("int"))
    count = F.sum("__bad").over(Window.partitionBy(*keys, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return with_island.withColumn(name, count).drop("__island", "__bad")


def first_children(df: DataFrame, parent: str, order: Column, value: str) -> DataFrame:
    """The value of the first child of each parent, combined map-side."""
    return df.groupBy(parent).agg(F.min_by(value, order).alias(value))


def writable(df: DataFrame, known: list[str], excluded: tuple[str, ...] = (), **constants: object) -> DataFrame:
    """The columns that a target knows, in its order, but for the ``excluded`` ones; ``constants`` fill theirs in every row.

    What the target doesn't know goes; known columns that the rows lack aren't made up.
    """
    wanted = [c for c in known if c not in excluded]
    unknown = [c for c in constants if c not in wanted]
    if unknown:
        raise ValueError(f"not writable: {', '.join(unknown)}")
    return df.select(*[F.lit(constants[c]).alias(c) if c in constants else F.col(f"`{c}`") for c in wanted if c in constants or c in df.columns])
