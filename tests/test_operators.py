"""Properties of the operators: idempotent, order-free, null-safe."""

import zipfile

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import joins, keyed, shape, spatial
from sparkloom.plans import lookups
from sparkloom.sources import files
from sparkloom.operators import tables
from sparkloom.streaming import upserts


def test_upsert_twice_is_once_and_the_last_wins(spark):
    target = spark.createDataFrame([(1, "a", 0), (None, "n", 0), (3, "c", 0)], "k int, v string, at int")
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "m", 1), (4, "d", 1)], "k int, v string, at int")
    once = keyed.upsert(target, source, ["k"], [F.desc("at"), F.col("v")])
    found = {r.k: r.v for r in once.collect()}
    assert found == {1: "y", None: "m", 3: "c", 4: "d"} and once.count() == 4
    again = keyed.upsert(once, source.orderBy("at"), ["k"], [F.desc("at"), F.col("v")])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in once.collect()} and again.count() == 4


@pytest.fixture
def changes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    news = spark.createDataFrame([(1, "A!", "A"), (4, "d", "A"), (4, "d", "A"), (2, "B", "C"), (9, "x", "C"), (3, "", "D"), (8, "", "D"), (5, "e", "A"), (5, "e", "D")], "k int, v string, s string")
    return base, news


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_changes_apply_and_twice_is_once(changes):
    base, news = changes
    once = keyed.apply_changes(base, news, ["k"], "s")
    assert rows(once) == [(1, "a"), (2, "B"), (4, "d")]
    assert rows(keyed.apply_changes(once, news, ["k"], "s")) == rows(once)


def test_upsert_if_changed(spark):
    old = spark.createDataFrame([(1, "h1", "old"), (2, None, "old"), (3, "h3", "old")], "k int, h string, v string")
    new = spark.createDataFrame([(1, "h1", "new"), (2, "h2", "new"), (3, "hx", "new"), (4, "h4", "new")], "k int, h string, v string")
    got = keyed.upsert_if_changed(old, new, ["k"], "h")
    assert [(r[0], r[2]) for r in rows(got)] == [(1, "old"), (2, "new"), (3, "new"), (4, "new")]


def test_empty_child_set_deletes_nothing(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "p int, c int")
    assert rows(keyed.delete_missing(df, df.limit(0), ["p"], ["c"])) == rows(df)


def test_keep_one_with_null_keys_in_any_order(spark):
    data = [(None, 1), (None, 2), (1, 3), (1, 1)]
    for order in (data, data[::-1]):
        got = keyed.keep_one(spark.createDataFrame(order, "k int, v int"), ["k"], [F.desc("v")])
        assert {(r.k, r.v) for r in got.collect()} == {(None, 2), (1, 3)}


def test_forward_fill_resets_at_null_header(spark):
    df = spark.createDataFrame([(1, 1, "h", "x"), (1, 2, "r", None), (1, 3, "h", None), (1, 4, "r", None)], "g int, o int, t string, v string")
    got = shape.forward_fill(df, ["g"], ["o"], F.col("t") == "h", F.col("v"), "c")
    assert [r.c for r in got.orderBy("o").collect()] == ["x", "x", None, None]


def test_box_join_finds_each_pair_once(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 25.0, 25.0)], "i int, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(7, 5.0, 5.0, 30.0, 30.0), (8, 26.0, 0.0, 27.0, 1.0)], "j int, u0 double, v0 double, u1 double, v1 double")
    l, r = ("x0", "y0", "x1", "y1"), ("u0", "v0", "u1", "v1")  # noqa: E741
    got = joins.box_join(a, b, l, r, 10.0).select("i", "j", joins.overlap_area(l, r).alias("area"))
    assert rows(got) == [(1, 7, 400.0)]


def test_rows_of_one_box_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "LIST", 100, raising=False)
    spark.range(2000).selectExpr("id * 100 AS s_suppkey", "3 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1000).selectExpr("id * 100 AS c_custkey", "3 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    met = lookups.theta_bbox_join(spark, str(tmp_path))
    parts = met.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.sum("skey").alias("s"), F.sum("nkey").alias("k"), F.min("overlap_pct").alias("p")).collect()
    assert [sum(r[c] for r in parts) for c in ("n", "s", "k")] == [2_000_000, 1000 * 100 * 1999 * 1000, 2000 * 100 * 999 * 500] and {r.p for r in parts} == {100.0}
    assert max(r.n for r in parts) < 1_000_000


def test_expand_keeps_repeated_and_null_rows(spark):
    left = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, 6), (None, 7)], "a int, l int")
    right = spark.createDataFrame([(9, "x"), (9, None)], "b int, r string")
    pairs = spark.createDataFrame([(1, 9, 0.5), (3, 9, 0.1), (2, 8, 0.2)], "a int, b int, share double")
    got = joins.expand(pairs, left, right, ["a"], ["b"])
    assert rows(got.select("l", "r", "share").na.fill("~").na.fill(0)) == [(0, "x", 0.5), (0, "~", 0.5), (5, "x", 0.5), (5, "x", 0.5), (5, "~", 0.5), (5, "~", 0.5)]


def test_polygon_expressions(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (0, 2), (2, 2), (2, 0))])
    r = spark.range(1).select(spatial.ring_area(ring).alias("a"), spatial.contains_point(ring, F.lit(1.0), F.lit(1.0)).alias("i"), spatial.contains_point(ring, F.lit(3.0), F.lit(1.0)).alias("o")).first()
    assert (r.a, r.i, r.o) == (-4.0, True, False)


def test_clusters(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 9)] + [(20, 21)], "a int, b int")
    assert {r.u: r.label for r in spatial.clusters(edges, "a", "b").collect()} == {**{i: 1 for i in range(1, 10)}, 20: 20, 21: 20}


def test_csv_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Nom Du Lieu;statutDA\n x ;1\ny\n", encoding="utf-8")
    df = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["nom_du_lieu", "statut_da"] and rows(df.na.fill("~")) == [("x", "1"), ("y", "~")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "﻿a;b\n1;2\n")
    assert [r.line for r in files.read_zipped_csv(spark, str(tmp_path / "z.zip")).orderBy("place").collect()] == ["a;b", "1;2"]


def test_xml_and_features(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r xmlns:n='u'><n:job><n:id>1</n:id></n:job><n:job><n:id>2</n:id></n:job></r>")
    assert files.read_xml(spark, str(tmp_path / "a.xml"), "job").count() == 2
    (tmp_path / "f.json").write_text('{"features":[{"attributes":{"id":1},"geometry":{"x":1,"y":2}}]}')
    assert files.read_features(spark, str(tmp_path / "f.json")).first().asDict() == {"id": 1, "geometry": '{"x":1,"y":2}'}


def test_streamed_upserts(spark, tmp_path):
    for i, part in enumerate(([(1, 1, "a"), (1, 2, "b")], [(1, 3, "c"), (2, 1, "d")])):
        spark.createDataFrame(part, "k int, t int, v string").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    stream = spark.readStream.schema("k int, t int, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    query = upserts.upsert_batches(stream, str(tmp_path / "out"), ["k"], ["t"], str(tmp_path / "ck"))
    query.awaitTermination(60)
    assert rows(tables.ManifestTable(spark, str(tmp_path / "out"), ["k"]).read()) == [(1, 3, "c"), (2, 1, "d")]
