"""Ring assembly against brute force on shuffled ways, and elements' ids, places and classes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import elements
from sparkloom.operators.overlay import shared_area


def around(nodes, closed):
    """The same for every direction, and for every beginning of a closed ring."""
    nodes = list(nodes)
    if not closed:
        return min(tuple(nodes), tuple(nodes[::-1]))
    body = nodes[:-1]
    return min(tuple(b[i:] + b[:i]) for b in (body, body[::-1]) for i in range(len(b)))


def test_shuffled_ways_become_their_rings(spark):
    rng = random.Random(11)
    members, ways, want, fresh = [], [], set(), iter(rng.sample(range(1, 100_000), 20_000))
    for relation in range(25):
        for role in ("outer", "inner", None):
            for _ in range(rng.randint(0, 3)):
                count, closed = rng.randint(1, 40), rng.random() < 0.7
                tracks = [[next(fresh) for _ in range(rng.randint(1, 4))] for _ in range(count)]
                starts = [t[0] for t in tracks] + [tracks[0][0] if closed else next(fresh)]
                parts = [[*t, starts[i + 1]] for i, t in enumerate(tracks)]
                if closed and count == 1 and len(parts[0]) < 3:
                    continue
                lost = rng.randrange(count) if count > 2 and rng.random() < 0.3 else None
                runs = [list(range(count))]
                if lost is not None:
                    runs = [[*range(lost + 1, count), *range(lost)]] if closed else [list(range(lost)), list(range(lost + 1, count))]
                for run in filter(None, runs):
                    nodes = [parts[run[0]][0], *(n for i in run for n in parts[i][1:])]
                    want.add((relation, role or "", closed and lost is None, len(run), around(nodes, closed and lost is None)))
                for i, part in enumerate(parts):
                    way = next(fresh)
                    members += [(relation, role, way)] * rng.randint(1, 2)
                    if i != lost:
                        ways.append((way, part if rng.random() < 0.5 else part[::-1]))
    ways += [(-1, []), (-2, [5]), (-3, None)]
    members += [(0, "outer", -1), (0, "outer", -2), (0, "outer", -3), (0, "outer", -4)]
    rng.shuffle(members), rng.shuffle(ways)
    found = elements.rings(spark.createDataFrame(members, "relation int, role string, way bigint"), spark.createDataFrame(ways, "way bigint, nodes array<bigint>")).collect()
    assert {(r.relation, r.role, r.closed, r.ways, around(r.nodes, r.closed)) for r in found} == want and len(found) == len(want) > 60
    assert len({(r.relation, r.role, r.ring) for r in found}) == len(found)


def test_touching_rings_keep_their_area(spark):
    # two squares that share one corner, each of two ways; a hole as a closed way
    places = {1: (0, 0), 2: (4, 0), 3: (4, 4), 4: (0, 4), 5: (8, 4), 6: (8, 8), 7: (4, 8), 8: (1, 1), 9: (2, 1), 10: (2, 2)}
    ways = [(20, [3, 2, 1]), (21, [1, 4, 3]), (22, [3, 5, 6]), (23, [3, 7, 6]), (24, [8, 9, 10, 8])]
    members = [(1, "outer", w) for w in range(20, 24)] + [(1, "inner", 24)]
    found = elements.rings(spark.createDataFrame(members, "relation int, role string, way bigint"), spark.createDataFrame(ways, "way bigint, nodes array<bigint>"))
    nodes = spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in places.items()], "node bigint, x double, y double")
    placed = elements.outlines(found, nodes)
    assert {r.missing for r in placed.collect()} == {0} and elements.outlines(found, nodes.where("node <> 6")).agg(F.sum("missing")).first()[0] == 1
    import numpy as np

    (row,) = elements.polygons(placed).collect()
    shape = [np.array([(p.x, p.y) for p in ring]) for ring in row.rings]
    assert shared_area(shape, shape) == pytest.approx(32 - 0.5)


def test_no_members(spark):
    members, ways = spark.createDataFrame([], "relation int, role string, way bigint"), spark.createDataFrame([], "way bigint, nodes array<bigint>")
    assert elements.rings(members, ways).collect() == []


def test_elements_from_pages(spark, tmp_path):
    page = {"version": 0.6, "elements": [
        {"type": "node", "id": 1, "lat": 46.2, "lon": 6.1, "tags": {"amenity": "fast_food", "building": "yes", "name": ""}},
        {"type": "way", "id": 2, "center": {"lat": 46.3, "lon": 6.2}, "nodes": [1, 5], "tags": {"building": "drive-in", "name": "B"}},
        {"type": "relation", "id": 3, "center": {"lat": 1, "lon": 2}, "members": [{"type": "way", "ref": 2, "role": "outer"}], "tags": {"shop": "", "landuse": "residential"}},
        {"type": "node", "id": 4, "tags": {"shop": "kiosk"}}, {"type": "way", "id": 5, "lat": 1, "lon": 1, "tags": {"shop": "kiosk"}},
        {"type": "node", "id": 6, "lat": 1, "lon": 1}, {"type": "node", "id": 7, "lat": 1, "lon": 1, "tags": {"odd": "x"}}]}
    (tmp_path / "a.json").write_text(json.dumps(page))
    (tmp_path / "b.json").write_text('{"elements": []}')
    read = elements.read_elements(spark, str(tmp_path))
    assert read.count() == 7
    codes = spark.createDataFrame([("amenity", "fast_food", 2302, None), ("landuse", "residential", 7203, "Housing")], "key string, value string, code int, description string")
    found = {r.osm_id: r for r in elements.features(read, codes).collect()}
    assert found.keys() == {"1", "-2", "-3"}
    assert (found["1"].code, found["1"].fclass, found["1"].name, found["1"].description) == (2302, "fast_food", None, "Fast Food")
    assert (found["-2"].code, found["-2"].name, found["-2"].description, found["-2"].lat) == (1500, "B", "Drive-In", 46.3)
    assert (found["-3"].fclass, found["-3"].description, json.loads(found["-3"].geometry)) == ("residential", "Housing", {"type": "Point", "coordinates": [2.0, 1.0]})
