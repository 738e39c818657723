"""Keyed deduplication, upserts and change data capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_one(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """One row a key: the first in ``order``, which must be total for a defined winner. Null keys form a group.

    One shuffle on the keys; a window needs no self join.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def keep_best(df: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """One row a key by the largest ``by``, combined map-side, so that hot keys stay cheap."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("__best"))
    return best.select(*keys, "__best.*").select(*df.columns)


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased sides."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``source`` replace those of equal keys; the others stay.

    Null keys are keys like any other, so a replay changes nothing. Of several source rows of one key the last in
    ``order`` wins, which must be total; without ``order`` the source must hold one row a key.
    """
    if order:
        source = keep_one(source, keys, order)
    new = source.select(*keys).distinct().alias("new")
    kept = target.alias("old").join(new, same_keys("old", "new", keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def one_a_key(df: DataFrame, keys: list[str], order: list[Column] | None) -> DataFrame:
    """One row a key: the first in ``order``, or without one the last by the values of the other columns, so that any run keeps the same."""
    return keep_one(df, keys, order or [F.desc(c) for c in df.columns if c not in keys] or [F.lit(0)])


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``source`` whose keys aren't there yet, one a key as :func:`one_a_key` says (K3, K6, J7). Null keys are keys like any other."""
    known = target.select(*keys).distinct().alias("old")
    return one_a_key(source.alias("new").join(known, same_keys("new", "old", keys), "left_anti"), keys, order)


def upsert_if_changed(target: DataFrame, source: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """As :func:`upsert`, but a row of an equal digest stays as it is; a null digest counts as changed."""
    known = target.select(*keys, F.col(digest).alias("__old")).alias("old")
    joined = source.alias("new").join(known, same_keys("new", "old", keys), "left")
    changed = joined.where(F.col("__old").isNull() | ~F.col("__old").eqNullSafe(F.col(f"new.{digest}"))).select("new.*")
    return upsert(target, changed, keys)


def delete_missing(target: DataFrame, source: DataFrame, parent: list[str], keys: list[str]) -> DataFrame:
    """Drops rows that a parent's new set lacks. Parents without a new set stay untouched; null keys are keys like any other (K5).

    The target is read once and meets the new parents and the new sets.
    """
    news = source.select(*parent, *keys).distinct()
    touched = target.alias("old").join(news.select(*parent).distinct().withColumn("__touched", F.lit(True)).alias("p"), same_keys("old", "p", parent), "left")
    known = touched.select("old.*", "__touched").alias("old").join(news.withColumn("__known", F.lit(True)).alias("n"), same_keys("old", "n", [*parent, *keys]), "left")
    return known.where("__touched IS NULL OR __known").select(*[F.col(f"old.{c}") for c in target.columns])


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], status: str, keep: tuple[str, ...] = (), order: list[Column] | None = None) -> DataFrame:
    """Additions if absent, then changes of what is there, then deletions.

    ``status`` holds A, C or D; columns in ``keep`` aren't overwritten by changes. Of several additions or changes of one key
    the first in ``order`` counts (see :func:`one_a_key`), so no row is doubled. Null keys are keys like any other.
    """
    part = lambda s: changes.where(F.col(status) == s).drop(status)
    grown = target.unionByName(insert_absent(target, part("A"), keys, order))
    rest = [c for c in target.columns if c not in keys and c not in keep]
    news = one_a_key(part("C"), keys, order).select(*keys, F.struct(*rest).alias("__new")).alias("new")
    joined = grown.alias("old").join(news, same_keys("old", "new", keys), "left")
    changed = joined.select(*[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) if c in rest else F.col(f"old.{c}").alias(c) for c in target.columns])
    return changed.alias("old").join(part("D").select(*keys).distinct().alias("gone"), same_keys("old", "gone", keys), "left_anti")


def mark_stale(df: DataFrame, seen: Column, now: Column, days: int, fetched: int, least: int, state: str = "state") -> DataFrame:
    """Online rows not seen for ``days`` go offline, but only after a run that fetched enough."""
    if fetched < least:
        return df
    stale = (F.col(state) == "online") & (seen < F.date_sub(now, days))
    return df.withColumn(state, F.when(stale, "offline").otherwise(F.col(state)))


def work_list(df: DataFrame, known: DataFrame, keys: list[str], mode: str, share: float = 0.1) -> DataFrame:
    """Rows to fetch: all of them to seed; daily, those whose keys aren't known yet and a fixed ``share`` of the known.

    The share goes by a digest of the keys, so a replay takes the same rows. Adds ``is_new``. Null keys are keys like any other.
    """
    if mode not in ("seed", "daily"):
        raise ValueError(f"unknown mode: {mode}")
    had = known.select(*keys).distinct().withColumn("__had", F.lit(True)).alias("old")
    marked = df.alias("new").join(had, same_keys("new", "old", keys), "left").select("new.*", F.col("__had").isNull().alias("is_new"))
    if mode == "seed":
        return marked
    named = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys])
    drawn = F.conv(F.substring(F.md5(named), 1, 4), 16, 10).cast("int")
    return marked.where(F.col("is_new") | (drawn < int(share * 65536)))
