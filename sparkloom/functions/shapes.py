"""Geometries of feature services as GeoJSON text, row by row (G1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def closed(ring: Column) -> Column:
    """A ring that ends where it starts."""
    first, last = F.try_element_at(ring, F.lit(1)), F.try_element_at(ring, F.lit(-1))
    return F.when(first == last, ring).otherwise(F.concat(ring, F.array(first)))


def signed_area(ring: Column) -> Column:
    """Area of a closed ring, positive where it runs counter-clockwise."""
    step = lambda p, q: p[0] * q[1] - q[0] * p[1]
    ahead = F.slice(ring, F.lit(2), F.size(ring) - 1)
    return F.aggregate(F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), ahead, step), F.lit(0.0), lambda a, b: a + b) / 2


def oriented(rings: Column) -> Column:
    """Closed rings, the outer one counter-clockwise and the holes behind it clockwise; rings of fewer than three corners go."""
    kept = F.filter(F.transform(rings, closed), lambda r: F.size(r) >= 4)
    return F.transform(kept, lambda r, i: F.when((signed_area(r) >= 0) == (i == 0), r).otherwise(F.reverse(r)))


def geojson(document: Column) -> Column:
    """``{x, y}``, ``{rings}`` or ``{paths}`` as a GeoJSON point, polygon or set of lines (G1).

    Null for null, empty and broken texts, other objects, and polygons without a ring of three corners; numbers may be texts.
    The first ring is the outer one. Rings that cross themselves aren't mended.
    """
    parsed = F.try_parse_json(document)
    number = lambda path: F.try_variant_get(parsed, path, "double")
    lists = lambda path: F.try_variant_get(parsed, path, "array<array<array<double>>>")
    shape = lambda kind, coordinates: F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))
    point = F.when(number("$.x").isNotNull() & number("$.y").isNotNull(), shape("Point", F.array(number("$.x"), number("$.y"))))
    whole = F.transform(F.array(oriented(lists("$.rings"))), lambda rings: F.when(F.size(rings) > 0, shape("Polygon", rings)))[0]
    paths = lists("$.paths")
    return F.coalesce(point, whole, F.when(paths.isNotNull(), shape("MultiLineString", paths)))
