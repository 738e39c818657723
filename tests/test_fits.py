"""Known transforms are found again, with anchors that lie off."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import fits


def test_known_transforms_are_recovered(spark):
    rng = random.Random(5)
    true = {p: (rng.uniform(0.5, 3), rng.uniform(-50, 50), -rng.uniform(0.5, 3), rng.uniform(-50, 50)) for p in range(12)}
    rows = []
    for p, (sx, tx, sy, ty) in true.items():
        for i in range(40):
            x, y = rng.uniform(0, 100), rng.uniform(0, 100)
            off = (rng.uniform(100, 400), rng.uniform(-400, -100)) if i % 10 == 3 else (0, 0)
            rows.append((p, x, y, sx * x + tx + off[0], sy * y + ty + off[1]))
    rows += [(98, 1.0, 2.0, 3.0, 4.0), (98, 1.0, 5.0, 3.0, 9.0), (99, None, 1.0, 1.0, 1.0)]
    anchors = spark.createDataFrame(rows, "page int, x double, y double, to_x double, to_y double")
    found = {r.page: r for r in fits.fit_pages(anchors, "page", rounds=4).collect()}
    assert found.keys() == true.keys()
    for p, (sx, tx, sy, ty) in true.items():
        r = found[p]
        assert (r.sx, r.tx, r.sy, r.ty) == pytest.approx((sx, tx, sy, ty), abs=1e-6) and r.anchors <= 36
        assert r.confidence == pytest.approx(0.85 + 0.15 * min(sx, -sy) / max(sx, -sy))
    features = spark.createDataFrame([(0, 10.0, 20.0), (77, 1.0, 1.0)], "page int, x double, y double").withColumn("sx_", F.lit(1))
    placed = {r.page: r for r in fits.place_features(features, fits.fit_pages(anchors, "page", rounds=4), "page").collect()}
    sx, tx, sy, ty = true[0]
    assert (placed[0].to_x, placed[0].to_y) == pytest.approx((10 * sx + tx, 20 * sy + ty), abs=1e-6) and placed[77].to_x is None
