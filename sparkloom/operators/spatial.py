"""Geometry as built-in expressions over arrays of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.session import with_checkpoints


def ring_area(ring: Column) -> Column:
    """Signed area of a ring of ``(x, y)`` structs: positive if counter-clockwise."""
    behind = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, behind, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, v: s + v) / 2


def counter_clockwise(ring: Column) -> Column:
    """The ring with a positive area."""
    return F.when(ring_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def contains_point(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting: an odd number of crossings to the right."""
    behind = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    crossed = F.zip_with(ring, behind, lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]), 1).otherwise(0))
    return F.aggregate(crossed, F.lit(0), lambda s, v: s + v) % 2 == 1


def bounds(ring: Column) -> list[Column]:
    """x0, y0, x1, y1 of a ring."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return [F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")]


def fit_confidence(width: Column, height: Column, to_width: Column, to_height: Column) -> Column:
    """Confidence of an affine fit by how alike both scales are."""
    sx, sy = to_width / F.nullif(width, F.lit(0.0)), to_height / F.nullif(height, F.lit(0.0))
    return 0.85 + 0.15 * F.least(sx, sy) / F.greatest(sx, sy)


def box_iou(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> Column:
    """Shared over joint area of two boxes."""
    from sparkloom.operators.joins import overlap_area

    area = lambda r: (F.col(r[2]) - F.col(r[0])) * (F.col(r[3]) - F.col(r[1]))
    shared = overlap_area(a, b)
    return shared / F.nullif(area(a) + area(b) - shared, F.lit(0.0))


def clusters(edges: DataFrame, src: str, dst: str, rounds: int = 50) -> DataFrame:
    """Smallest reachable id a node: labels spread and are halved along themselves until none changes."""
    with_checkpoints(edges.sparkSession)
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).union(edges.select(F.col(dst).alias("u"), F.col(src).alias("v"))).distinct().checkpoint()
    labels = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("label")).checkpoint()
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        spread = labels.join(near, "u").select("u", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("u").alias("next"), F.col("label").alias("far"))
        news = spread.join(jump, "next", "left").select("u", F.least("next", F.coalesce("far", "next")).alias("next"), "label").checkpoint()
        labels = news.select("u", F.col("next").alias("label"))
        if news.where("next <> label").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")
