"""Joins that go beyond a plain equi join (J3-J6, J11-J16, J22) and grid helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one class that travel as one list.
LIST = 1000


def cells(low: Column, high: Column, size: float) -> Column:
    """Grid cells that an interval touches; the interval's length over ``size`` bounds their number."""
    return F.sequence(F.floor(low / size), F.floor(high / size))


def interval_join(left: DataFrame, right: DataFrame, l_low: str, l_high: str, r_low: str, r_high: str, size: float, keys: list[str] = ()) -> DataFrame:
    """Rows whose intervals overlap, as an equi join on grid cells.

    A pair is emitted only in the first cell that both touch, so there is no dedup shuffle
    and no nested loop; pick ``size`` near the typical interval length.
    """
    a = left.withColumn("__cell", F.explode(cells(F.col(l_low), F.col(l_high), size)))
    b = right.withColumn("__cell", F.explode(cells(F.col(r_low), F.col(r_high), size)))
    joined = a.join(b, ["__cell", *keys])
    first = F.greatest(F.floor(F.col(l_low) / size), F.floor(F.col(r_low) / size))
    return joined.where((F.col("__cell") == first) & (F.col(l_low) <= F.col(r_high)) & (F.col(r_low) <= F.col(l_high))).drop("__cell")


def box_join(left: DataFrame, right: DataFrame, l: tuple[str, str, str, str], r: tuple[str, str, str, str], size: float, keys: list[str] = ()) -> DataFrame:  # noqa: E741
    """Rows whose boxes ``(x0, y0, x1, y1)`` overlap, on two-dimensional cells."""
    spread = lambda df, b: df.withColumn("__cx", F.explode(cells(F.col(b[0]), F.col(b[2]), size))).withColumn("__cy", F.explode(cells(F.col(b[1]), F.col(b[3]), size)))
    joined = spread(left, l).join(spread(right, r), ["__cx", "__cy", *keys])
    first_x = F.greatest(F.floor(F.col(l[0]) / size), F.floor(F.col(r[0]) / size))
    first_y = F.greatest(F.floor(F.col(l[1]) / size), F.floor(F.col(r[1]) / size))
    meets = (F.col(l[0]) <= F.col(r[2])) & (F.col(r[0]) <= F.col(l[2])) & (F.col(l[1]) <= F.col(r[3])) & (F.col(r[1]) <= F.col(l[3]))
    return joined.where((F.col("__cx") == first_x) & (F.col("__cy") == first_y) & meets).drop("__cx", "__cy")


def tasks(spark: SparkSession) -> int:
    """Tasks for rows whose number and size say little about the work that they make: a few for each core."""
    return 4 * spark.sparkContext.defaultParallelism


def expand(pairs: DataFrame, left: DataFrame, right: DataFrame, l_key: list[str], r_key: list[str]) -> DataFrame:
    """Pairs of classes as pairs of rows: each row of ``left`` of the one with each row of ``right`` of the other.

    ``pairs`` holds the keys of both classes and what holds for all of their rows. Rows travel in lists of about ``LIST``, so that
    what is shuffled is a small part of the result, and a class of many rows is dealt to as many tasks as it has pairs of lists.
    """
    lists = []
    for side, rows, key in (("l", left, l_key), ("r", right, r_key)):
        rest = [c for c in rows.columns if c not in key]
        crowded = rows.groupBy(*key).count().where(F.col("count") > LIST).select(*key, F.ceil(F.col("count") / LIST).alias("__parts"))
        part = F.coalesce(F.pmod(F.xxhash64(*rest), F.col("__parts")), F.lit(0)).alias(f"__{side}part")
        lists.append(rows.join(crowded, key, "left").groupBy(*key, part).agg(F.collect_list(F.struct(*rest)).alias(f"__{side}rows")))
        parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("__parts", F.lit(1)) - 1)
        pairs = pairs.join(crowded, key, "left").withColumn(f"__{side}part", F.explode(parts)).drop("__parts")
    ends = [*l_key, "__lpart", *r_key, "__rpart"]
    # few short rows here stand for many in the result, so their number says nothing about how many tasks they need
    pairs = pairs.repartition(tasks(pairs.sparkSession), *ends)
    pairs = pairs.join(lists[0], [*l_key, "__lpart"]).join(lists[1], [*r_key, "__rpart"])
    kept = [c for c in pairs.columns if not c.startswith("__")]
    pairs = pairs.select(*kept, F.inline("__lrows"), "__rrows")
    return pairs.select(*[c for c in pairs.columns if c != "__rrows"], F.inline("__rrows"))


def overlap_area(l: tuple[str, str, str, str], r: tuple[str, str, str, str]) -> Column:  # noqa: E741
    """Area that two boxes share."""
    w = F.least(F.col(l[2]), F.col(r[2])) - F.greatest(F.col(l[0]), F.col(r[0]))
    h = F.least(F.col(l[3]), F.col(r[3])) - F.greatest(F.col(l[1]), F.col(r[1]))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def first_of_tiers(df: DataFrame, tiers: list[tuple[Column, DataFrame, str, str]], name: str) -> DataFrame:
    """Lookup by tier: for each ``(key, dimension, key column, value column)`` a left join; the first hit wins."""
    found = []
    for i, (key, dim, dim_key, dim_value) in enumerate(tiers):
        side = dim.groupBy(F.col(dim_key).alias(f"__k{i}")).agg(F.min(dim_value).alias(f"__v{i}"))
        df = df.withColumn(f"__q{i}", key).join(side, F.col(f"__q{i}") == F.col(f"__k{i}"), "left")
        found.append(f"__v{i}")
    helpers = [f"__{c}{i}" for i in range(len(tiers)) for c in "qkv"]
    return df.withColumn(name, F.coalesce(*[F.col(f) for f in found])).drop(*helpers)
