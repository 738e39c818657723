"""Overlay, similar names, keywords and prefix lookups against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import fuzzy, joins, keywords, overlay
from tests.conftest import canonical


def signed(p):
    return float(np.sum(p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]) / 2)


def clipped(subject, clip):
    """A convex polygon inside a convex one, half plane by half plane."""
    out = list(subject)
    for c, d in zip(clip, np.roll(clip, -1, axis=0), strict=True):
        inside = lambda p: (d[0] - c[0]) * (p[1] - c[1]) - (d[1] - c[1]) * (p[0] - c[0])  # noqa: E731, B023
        new = []
        for p, q in zip(out, out[1:] + out[:1], strict=True):
            s, t = inside(p), inside(q)
            if s >= 0:
                new.append(p)
            if (s > 0 > t) or (s < 0 < t):
                new.append(p + (q - p) * s / (s - t))
        out = new
        if not out:
            break
    return np.array(out).reshape(-1, 2)


def fan_area(a, b):
    """Shared area as the sum over signed triangles from the origin: right for any simple rings, with holes turned the other way."""
    total = 0.0
    for r in a:
        for s in b:
            for p, q in zip(r, np.roll(r, -1, axis=0), strict=True):
                for u, v in zip(s, np.roll(s, -1, axis=0), strict=True):
                    x, y = np.array([[0, 0], p, q]), np.array([[0, 0], u, v])
                    i, j = np.sign(signed(x)), np.sign(signed(y))
                    if i and j:
                        part = clipped(x if i > 0 else x[::-1], y if j > 0 else y[::-1])
                        total += i * j * (signed(part) if len(part) > 2 else 0)
    return total



def ring_star(rng, cx, cy, reach, n, turned=False):
    angles = np.linspace(0, 2 * np.pi, n, endpoint=False)[:: -1 if turned else 1]
    far = reach * rng.uniform(0.5, 1, n)
    return np.stack([cx + far * np.cos(angles), cy + far * np.sin(angles)], 1)


def random_polygon(rng):
    x, y = rng.uniform(3, 17, 2)
    return [ring_star(rng, x, y, rng.uniform(2, 6), rng.integers(5, 12)), ring_star(rng, x, y, 0.5, 5, turned=True)]


def test_shared_area_of_concave_rings_with_holes():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = random_polygon(rng), random_polygon(rng)
        assert overlay.shared_area(a, b) == pytest.approx(fan_area(a, b), abs=1e-6)
        assert overlay.shared_area(a, a) == pytest.approx(sum(map(signed, a)), abs=1e-9)
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2.0]])
    assert overlay.shared_area([square], [square + 2]) == 0
    assert overlay.shared_area([square, square + 1], [square]) == pytest.approx(3)  # where rings overlap is outside
    assert overlay.shared_area([square[:2]], [square]) == 0


def test_overlay_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    shapes = [[random_polygon(rng) for _ in range(n)] for n in (25, 20)]
    as_rows = lambda side: [(i, [[(float(x), float(y)) for x, y in r] for r in p]) for i, p in enumerate(side)]
    left = spark.createDataFrame(as_rows(shapes[0]) + [(98, []), (99, None)], f"a bigint, rings {overlay.RINGS}")
    right = spark.createDataFrame(as_rows(shapes[1]), f"b bigint, rings {overlay.RINGS}")
    got = {(r.a, r.b): r for r in overlay.overlay(left, right, "a", "b", "rings", size=4.0, least_area=1.0, most_share=0.6).collect()}
    wanted = {}
    for i, p in enumerate(shapes[0]):
        for j, q in enumerate(shapes[1]):
            area = fan_area(p, q)
            if area > 1 and area / sum(map(signed, p)) <= 0.6:
                wanted[i, j] = (area, area / sum(map(signed, p)), area / sum(map(signed, q)))
    assert got.keys() == wanted.keys() and wanted
    for key, row in got.items():
        assert (row.area, row.left_share, row.right_share) == pytest.approx(wanted[key], rel=1e-6)


def test_areas_of_many_pairs_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    a, b = ([random_polygon(rng) for _ in range(60)] for _ in range(2))
    a[1], a[2], b[3], b[4] = [], [a[2][0][:2]], [ring_star(rng, 10, 10, 9, 80)], [b[4][0], b[4][0] + 1]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    column = lambda side: pa.array([[[{"x": x, "y": y} for x, y in r.tolist()] for r in p] for p in side], kind)
    for room in (overlay.ROOM, 500):
        monkeypatch.setattr(overlay, "ROOM", room)
        for skip in (0, 7):
            sides = [overlay.columns_of(column(side)[skip:], False) for side in (a, b)]
            wanted = [overlay.shared_area(p, q) for p, q in zip(a[skip:], b[skip:], strict=True)]
            assert overlay.shared_areas(*sides[0], *sides[1]) == pytest.approx(wanted, abs=1e-9) and sum(wanted) > 0
    none = overlay.columns_of(column([]), False)
    assert len(overlay.shared_areas(*none, *none)) == 0


def test_overlay_of_copies_and_of_polygons_inside_others(spark, monkeypatch):
    monkeypatch.setattr(joins, "LIST", 3)  # the rows of a shape travel in many lists
    rng = np.random.default_rng(7)
    inner = [[ring_star(rng, *rng.uniform(5, 15, 2), 2, 9)] for _ in range(30)]
    as_rings = lambda p: [[(float(x), float(y)) for x, y in r] for r in p]
    left = spark.createDataFrame([(10 * i + k, as_rings(p)) for i, p in enumerate(inner) for k in range(10)] + [(None, as_rings(inner[0]))], f"a bigint, rings {overlay.RINGS}")
    outer = [ring_star(rng, 10, 10, 60, 23)]
    right = spark.createDataFrame([(k, as_rings(outer)) for k in range(8)], f"b bigint, rings {overlay.RINGS}")
    got = overlay.overlay(left, right, "a", "b", "rings", size=20.0).collect()
    assert sorted((r.a, r.b) for r in got) == [(a, b) for a in range(300) for b in range(8)]
    for r in got:
        assert r.left_share <= 1 and (r.area, r.left_share, r.right_share) == pytest.approx((signed(inner[r.a // 10][0]), 1, signed(inner[r.a // 10][0]) / signed(outer[0])))


def test_geodesic_area_of_a_degree(spark):
    square = [[(7.0, 46.0), (8.0, 46.0), (8.0, 47.0), (7.0, 47.0)]]
    df = spark.createDataFrame([(1, square)], f"a bigint, rings {overlay.RINGS}")
    row = overlay.overlay(df, df.withColumnRenamed("a", "b"), "a", "b", "rings", size=1.0, geodesic=True).first()
    # the zone between two parallels of the ellipsoid, by numeric integration of its surface element
    lat = np.radians(np.linspace(46, 47, 20001))
    e2 = overlay.ECCENTRICITY**2
    element = overlay.AXIS**2 * (1 - e2) * np.cos(lat) / (1 - e2 * np.sin(lat) ** 2) ** 2
    assert row.area == pytest.approx(float(np.trapezoid(element, lat) * np.radians(1)), rel=1e-9)
    assert row.left_share == 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def weighted(a, b):
    best = 0
    for make, weight in ((str, 100), (lambda s: " ".join(sorted(s.split())), 95), (lambda s: " ".join(sorted(set(s.split()))), 95)):
        x, y = make(a.lower()), make(b.lower())
        best = max(best, weight * (max(len(x), len(y)) - distance(x, y)) // max(len(x), len(y)))
    return best


def test_near_pairs_lose_none_and_compare_few(spark):
    rng = random.Random(6)
    tokens = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(40)]
    names = [" ".join(rng.choices(tokens, k=rng.randrange(1, 5))) for _ in range(150)]
    given = [None, "", " ", "a"]
    for name in names[:90]:
        i = rng.randrange(len(name))
        given.append(rng.choice([name[:i] + name[i + 1 :], name[:i] + "x" + name[i:], " ".join(reversed(name.split())), name.upper()]) or "q")
    left, right = (spark.createDataFrame([(x,) for x in side], "name string") for side in (given, names))
    for threshold in (70, 85):
        got = {(r.value, r.other): r.score for r in fuzzy.near_pairs(left, right, "name", "name", threshold).collect()}
        wanted = {(a, b): weighted(a.strip(), b) for a in set(given) if a and a.strip() for b in set(names) if weighted(a.strip(), b) >= threshold}
        assert got == wanted
    compared = fuzzy.candidates(fuzzy.forms(left, "name"), fuzzy.forms(right, "name"), 85).count()
    assert compared < 0.25 * 3 * len(set(given)) * len(set(names))


def test_best_match_keeps_rows_without_a_partner(spark):
    left = spark.createDataFrame([(1, "grande rue"), (2, "grande rue"), (3, "nothing like it"), (4, None)], "id int, name string")
    right = spark.createDataFrame([("rue grande",), ("grande ruee",), ("GRANDE RUE",)], "other string")
    found = {r.id: (r.other, r.score, r.candidates, r.status) for r in fuzzy.best_match(left, "name", fuzzy.near_pairs(left, right, "name", "other")).collect()}
    assert found == {1: ("GRANDE RUE", 100, 3, "matched"), 2: ("GRANDE RUE", 100, 3, "matched"), 3: (None, None, 0, "unmatched"), 4: (None, None, 0, "unmatched")}


@pytest.mark.parametrize("most", [4_000_000, 200])
def test_longest_keyword_equals_contains(spark, most):
    rng = random.Random(8)
    words = [("".join(rng.choices("abcé", k=rng.randrange(1, 7))), i) for i in range(300)] + [("", 1), (None, 2), ("ab", 999)]
    texts = [(i, "".join(rng.choices("abcé -", k=rng.randrange(0, 40)))) for i in range(200)] + [(500, None), (501, "zzz")]
    table = spark.createDataFrame(words, "word string, place int")
    docs = spark.createDataFrame(texts, "id int, text string").withColumn("best", F.lit(1))
    got = {r.id: (r.keyword, r.keyword_order) for r in keywords.longest_keyword(docs, "text", table, "word", "place", most).collect()}
    first = {}
    for w, i in words:
        if w:
            first[w] = min(i, first.get(w, i))
    for i, text in texts:
        best = max(((len(w), -p, w) for w, p in first.items() if text and w in text), default=None)
        assert got[i] == ((best[2], -best[1]) if best else (None, None))


def test_cascade_takes_the_first_tier(spark):
    names = ["Nyon", "Nyon-Ville", "Old", "Gen", "Genevas", "Bernex", "Ber", "Berne (BE)", None, "Zz", "Lau"]
    keys = ["Nyon", "Geneva", "Bern", "Berne", "Lausanne", "Lau-x", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    aliases = spark.createDataFrame([("Old", "Nyon"), ("Old", "Bern")], "alias string, entry string")
    out = keywords.cascade(df, "name", spark.createDataFrame([(k,) for k in keys], "entry string"), "entry", aliases, "alias", suffix=r" \(BE\)|s", least=3)
    got = {r.name: (r.entry, r.tier) for r in out.collect()}

    def plainly(name):
        known = sorted(k for k in keys if k)
        if name in known:
            return name, "exact"
        if name == "Old":
            return "Bern", "alias"
        bare = re.sub(r"( \(BE\)|s)$", "", name or "")
        if bare in known:
            return bare, "suffix"
        begun = [(-min(len(name), len(k)), k) for k in known if name and min(len(name), len(k)) >= 3 and (name.startswith(k) or k.startswith(name))]
        return (min(begun)[1], "prefix") if begun else (None, None)

    assert got == {n: plainly(n) for n in names}
    assert len(canonical(out.collect())) == len(names)
