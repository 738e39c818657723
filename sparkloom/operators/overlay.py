"""Exact overlay of polygons with holes and concave rings behind the grid-cell join.

A polygon is an array of rings of ``(x, y)`` structs; a point is inside if it lies in an odd number of rings, so holes and several
parts need no flag, and neither does the rings' direction. Shared area: vertical lines through all corners and crossings cut both polygons
into slabs in which no edges cross; there both are stacks of trapezoids whose overlaps add up. Pairs of a few edges are measured
many at once. Polygons of the same rings are measured once, as what they share with others is the same for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.joins import box_join, expand, tasks

#: Semi-axis and eccentricity of the reference ellipsoid (fixed values).
AXIS, ECCENTRICITY = 6378137.0, 0.0818191908426215
RINGS = "array<array<struct<x: double, y: double>>>"
SHAPE = "struct<h: bigint, k: bigint>"
#: Edges of a pair up to which it is measured beside others, and numbers in one array then.
EDGES, ROOM = 64, 1_000_000


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    """``(x0, y0, x1, y1)`` of all edges that aren't vertical, from left to right."""
    rings = [r for r in rings if len(r) >= 3]
    if not rings:
        return np.empty((0, 4))
    edges = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
    edges = edges[edges[:, 0] != edges[:, 2]]
    turned = edges[:, 0] > edges[:, 2]
    edges[turned] = edges[turned][:, [2, 3, 0, 1]]
    return edges


def crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x of the places where edges of ``a`` and ``b`` cross, a few edges of ``a`` at a time."""
    found = [np.empty(0)]
    step = max(1, 200_000 // max(1, len(b)))
    for at in range(0, len(a), step):
        p = a[at : at + step, None, :]
        d, e = p[..., 2:] - p[..., :2], (b[:, 2:] - b[:, :2])[None]
        across = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
        gap = b[None, :, :2] - p[..., :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[..., 0] * e[..., 1] - gap[..., 1] * e[..., 0]) / across
            u = (gap[..., 0] * d[..., 1] - gap[..., 1] * d[..., 0]) / across
        hit = (across != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        found.append((p[..., 0] + t * d[..., 0])[hit])
    return np.concatenate(found)


def stacks(edges: np.ndarray, left: float, right: float) -> np.ndarray:
    """Heights of a polygon's edges at both borders of a slab, from below; rows 2i and 2i + 1 bound an inside part."""
    over = edges[(edges[:, 0] <= left) & (edges[:, 2] >= right)]
    slope = (over[:, 3] - over[:, 1]) / (over[:, 2] - over[:, 0])
    heights = np.stack([over[:, 1] + slope * (left - over[:, 0]), over[:, 1] + slope * (right - over[:, 0])], 1)
    return heights[np.argsort(heights.sum(1), kind="stable")]


def shared_area(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Area that two polygons share; with ``a`` alone twice, its own area."""
    return area_between(edges_of(a), edges_of(b))


def area_between(p: np.ndarray, q: np.ndarray) -> float:
    """Area that two polygons share, of the edges of both."""
    if not len(p) or not len(q):
        return 0.0
    low, high = max(p[:, 0].min(), q[:, 0].min()), min(p[:, 2].max(), q[:, 2].max())
    if low >= high:
        return 0.0
    xs = [p[:, 0], p[:, 2], q[:, 0], q[:, 2], crossings(p, q), crossings(p, p), crossings(q, q), np.array([low, high])]
    xs = np.unique(np.concatenate(xs))
    xs = xs[(xs >= low) & (xs <= high)]
    total = 0.0
    for left, right in zip(xs[:-1].tolist(), xs[1:].tolist(), strict=True):
        one, two = stacks(p, left, right), stacks(q, left, right)
        n, m = len(one) // 2, len(two) // 2
        if not n or not m:
            continue
        bottom = np.maximum(one[0 : 2 * n : 2, None], two[None, 0 : 2 * m : 2])
        top = np.minimum(one[1 : 2 * n : 2, None], two[None, 1 : 2 * m : 2])
        total += float(np.clip(top - bottom, 0, None).sum()) * (right - left) / 2
    return total


def columns_of(rings: pa.ListArray, geodesic: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a column's polygons, as :func:`edges_of` gives them one by one, and where each polygon's begin."""
    ring_at, inner = rings.offsets.to_numpy(), rings.values
    corner_at = inner.offsets.to_numpy()[ring_at[0] : ring_at[-1] + 1]
    first, corners = corner_at[0], inner.values
    points = np.stack([corners.field(axis).to_numpy(zero_copy_only=False).astype(float)[first : corner_at[-1]] for axis in "xy"], 1)
    if geodesic:
        points = equal_area([points])[0]
    begin, many = corner_at[:-1] - first, np.diff(corner_at)
    behind = np.arange(1, len(points) + 1)
    behind[(begin + many - 1)[many > 0]] = begin[many > 0]
    polygon = np.repeat(np.repeat(np.arange(len(rings)), np.diff(ring_at)), many)
    edges = np.hstack([points, points[behind]]) if len(points) else np.empty((0, 4))
    fine = np.repeat(many >= 3, many) & (edges[:, 0] != edges[:, 2])
    edges, polygon = edges[fine], polygon[fine]
    turned = edges[:, 0] > edges[:, 2]
    edges[turned] = edges[turned][:, [2, 3, 0, 1]]
    return edges, np.concatenate([[0], np.cumsum(np.bincount(polygon, minlength=len(rings)))]).astype(np.int64)


def padded(edges: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The edges of some polygons as one array; edges that end before they begin fill it up."""
    many = begin[rows + 1] - begin[rows]
    at = np.arange(many.max())
    out = np.tile(np.array([np.inf, 0, -np.inf, 0]), (len(rows), len(at), 1))
    filled = at < many[:, None]
    out[filled] = edges[(begin[rows][:, None] + at)[filled]]
    return out


def stacks_of(e: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bottoms and tops of the inside parts of many polygons at both borders of each of their slabs, last axis; parts that aren't there have a top of minus infinity."""
    x0, y0, x1, y1 = (e[:, None, :, i] for i in range(4))
    over = (x0 <= left) & (x1 >= right) & (left < right)
    slope = (y1 - y0) / (x1 - x0)
    heights = np.stack([y0 + slope * (left - x0), y0 + slope * (right - x0)], -1)
    order = np.argsort(np.where(over, heights.sum(-1), np.inf), axis=2, kind="stable")
    heights, over = np.take_along_axis(heights, order[..., None], 2), np.take_along_axis(over, order, 2)
    pairs = 2 * (e.shape[1] // 2)
    there = over[:, :, 1:pairs:2, None]
    return np.where(there, heights[:, :, 0:pairs:2], np.inf), np.where(there, heights[:, :, 1:pairs:2], -np.inf)


def areas_between(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """:func:`area_between` of many pairs of polygons that share a stretch of x, as :func:`padded` gives them."""
    e = np.concatenate([p, q], 1)
    low, high = np.maximum(p[..., 0].min(1), q[..., 0].min(1))[:, None], np.minimum(p[..., 2].max(1), q[..., 2].max(1))[:, None]
    i, j = np.triu_indices(e.shape[1], 1)
    d = e[..., 2:] - e[..., :2]
    gap = e[:, j, :2] - e[:, i, :2]
    across = d[:, i, 0] * d[:, j, 1] - d[:, i, 1] * d[:, j, 0]
    t = (gap[..., 0] * d[:, j, 1] - gap[..., 1] * d[:, j, 0]) / across
    u = (gap[..., 0] * d[:, i, 1] - gap[..., 1] * d[:, i, 0]) / across
    hit = (across != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    xs = np.concatenate([e[..., 0], e[..., 2], np.where(hit, e[:, i, 0] + t * d[:, i, 0], low), low, high], 1)
    xs = np.sort(np.where((xs >= low) & (xs <= high), xs, high), 1)
    xs[:, 1:] = np.where(np.diff(xs, axis=1) > 0, xs[:, 1:], high)
    xs = np.sort(xs, 1)[:, : 1 + int((xs < high).sum(1).max())]
    out = np.empty(len(e))
    step = max(1, ROOM // (xs.shape[1] * max(e.shape[1], p.shape[1] * q.shape[1] // 4)))
    for at in range(0, len(e), step):
        some = slice(at, at + step)
        left, right = xs[some, :-1, None], xs[some, 1:, None]
        (p_low, p_top), (q_low, q_top) = stacks_of(p[some], left, right), stacks_of(q[some], left, right)
        shared = np.minimum(p_top[:, :, :, None], q_top[:, :, None]) - np.maximum(p_low[:, :, :, None], q_low[:, :, None])
        out[some] = (np.clip(shared, 0, None).sum((2, 3, 4)) * (right - left)[..., 0] / 2).sum(1)
    return out


def shared_areas(p: np.ndarray, p_at: np.ndarray, q: np.ndarray, q_at: np.ndarray) -> np.ndarray:
    """Area that the polygons of two columns share, row by row; edges as :func:`columns_of` gives them."""
    n, m = np.diff(p_at), np.diff(q_at)
    out = np.zeros(len(n))
    rows = np.flatnonzero((n > 0) & (m > 0))
    ends = lambda e, at: (np.minimum.reduceat(e[:, 0], at), np.maximum.reduceat(e[:, 2], at))
    if len(rows):
        (p0, p1), (q0, q1) = ends(p, p_at[:-1][n > 0]), ends(q, q_at[:-1][m > 0])
        i, j = (np.cumsum(x > 0)[rows] - 1 for x in (n, m))
        rows = rows[np.maximum(p0[i], q0[j]) < np.minimum(p1[i], q1[j])]
    rows = rows[np.lexsort([m[rows], (n + m)[rows]])]
    small = int(np.searchsorted((n + m)[rows], EDGES, "right"))
    at = 0
    with np.errstate(divide="ignore", invalid="ignore"):
        while at < small:
            stop = min(small, at + max(1, ROOM // EDGES**2))
            many = int((n + m)[rows[stop - 1]])
            stop = min(stop, at + max(1, ROOM // many**2))
            out[rows[at:stop]] = areas_between(padded(p, p_at, rows[at:stop]), padded(q, q_at, rows[at:stop]))
            at = stop
    for k in rows[small:].tolist():
        out[k] = area_between(p[p_at[k] : p_at[k + 1]], q[q_at[k] : q_at[k + 1]])
    return out


def equal_area(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Degrees of longitude and latitude to metres of the ellipsoid's cylindrical equal-area plane, where areas are geodesic ones."""
    out = []
    for ring in rings:
        s = np.sin(np.radians(ring[:, 1]))
        e = ECCENTRICITY
        q = (1 - e * e) * (s / (1 - (e * s) ** 2) + np.arctanh(e * s) / e)
        out.append(np.stack([AXIS * np.radians(ring[:, 0]), AXIS * q / 2], 1))
    return out


def corners(rings: Column, axis: str) -> Column:
    return F.transform(F.flatten(rings), lambda p: p[axis])


def overlay(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rings: str, size: float, geodesic: bool = False, least_area: float = 0.0, most_share: float = 1.0) -> DataFrame:
    """``(left id, right id, area, left_share, right_share)`` of all pairs that share more than ``least_area``, and at most ``most_share`` of the left polygon.

    Boxes meet on grid cells of ``size`` without their rings, one for all polygons of the same rings; these are fetched and measured once a
    pair, whose rows follow in the end. ``geodesic`` takes coordinates as degrees and gives square metres. Polygons that are null or have no
    ring of three corners share nothing. Ids are expected to be unique on either side.
    """

    def side(df: DataFrame, key: str, p: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        # 128 bits name a shape
        shape = F.struct(F.xxhash64(rings).alias("h"), F.xxhash64(F.lit(1), rings).alias("k")).alias(f"{p}shape")
        named = df.where(F.col(key).isNotNull() & F.col(rings).isNotNull()).select(shape, F.col(key).alias(f"{p}id"), F.col(rings).alias(f"{p}rings"))
        shapes = named.groupBy(f"{p}shape").agg(F.any_value(f"{p}rings").alias(f"{p}rings")).where(F.array_min(corners(F.col(f"{p}rings"), "x")).isNotNull())
        box = [f(corners(F.col(f"{p}rings"), axis)).alias(f"{p}{axis}{i}") for axis in "xy" for i, f in enumerate((F.array_min, F.array_max))]
        measured = shapes.mapInArrow(own, f"{p}shape {SHAPE}, {p}rings {RINGS}, whole_{p} double")
        return named.select(f"{p}shape", f"{p}id"), shapes.select(f"{p}shape", *box), measured

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = columns_of(batch.column(1), geodesic)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared_areas(*edges, *edges))], names=["shape", "rings", "whole"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            area = shared_areas(*(x for i in (2, 3) for x in columns_of(batch.column(i), geodesic)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(area), batch.column(4), batch.column(5)], names=["ashape", "bshape", "area", "whole_a", "whole_b"])

    (l_rows, l_boxes, l_rings), (r_rows, r_boxes, r_rings) = side(left, left_id, "a"), side(right, right_id, "b")
    names = [tuple(f"{p}{k}" for k in ("x0", "y0", "x1", "y1")) for p in "ab"]
    pairs = box_join(l_boxes, r_boxes, *names, size=size).select("ashape", "bshape").repartition(tasks(left.sparkSession), "ashape", "bshape")
    placed = pairs.join(l_rings, "ashape").join(r_rings, "bshape").select("ashape", "bshape", "arings", "brings", "whole_a", "whole_b")
    measured = placed.mapInArrow(measure, f"ashape {SHAPE}, bshape {SHAPE}, area double, whole_a double, whole_b double")
    # no polygon shares more than it has; the last digits of sums over other slabs may say so
    shares = measured.withColumn("area", F.least("area", "whole_a", "whole_b")).where(F.col("area") > least_area).select(
        "ashape", "bshape", "area",
        (F.col("area") / F.nullif("whole_a", F.lit(0.0))).alias("left_share"), (F.col("area") / F.nullif("whole_b", F.lit(0.0))).alias("right_share"),
    )
    met = expand(shares.where(F.col("left_share") <= most_share), l_rows, r_rows, ["ashape"], ["bshape"])
    return met.select(F.col("aid").alias(left_id), F.col("bid").alias(right_id), "area", "left_share", "right_share")
