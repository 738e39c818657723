"""JSON slices, snake case, places, grids and legends at their edges."""

from pyspark.sql import functions as F

from sparkloom.functions import records
from sparkloom.operators import layout, spatial


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_balanced_json(spark):
    cut = lambda text: one(spark, text, lambda t: records.balanced_json(t, "S ="))
    assert cut('x S = {"a": {"b": "}"}} rest }') == '{"a": {"b": "}"}}'
    assert cut('S = {"a": "\\"{"}; {') == '{"a": "\\"{"}'
    assert cut('S = {} {"a": 1}') == "{}"
    assert cut('S = {"a": {') is None
    assert cut('S = {"a": "never') is None
    assert cut("S = 1") is None
    assert cut('{"a": 1}') is None
    assert cut("") is None
    assert cut(None) is None
    deep = "{" * 5000 + "}" * 5000
    assert cut(f"S = {deep}}}") == deep


def test_snake_keys(spark):
    cut = lambda text: one(spark, text, records.snake_keys)
    assert cut('{"aB": {"cDe1F": ["xY: zW", "q\\"rS"]}, "n" : 1}') == '{"a_b": {"c_de1_f": ["xY: zW", "q\\"rS"]}, "n" : 1}'
    assert cut("") == ""
    assert cut(None) is None


def test_swiss_place(spark):
    place = lambda text: one(spark, text, records.swiss_place)
    assert [place(t) for t in ("8001 somewhere", "Sion (VS)", "x, ZH", "near Lausanne", "La Suisse")] == [True] * 5
    assert [place(t) for t in ("0999", "9659 x", "123456", "Lyon", "vs", "", None)] == [False] * 7


def test_known(spark):
    assert [one(spark, t, lambda c: records.known(c, "-", "unknown")) for t in ("a", " - ", "unknown", None)] == ["a", None, None, None]


def test_grid_rows(spark):
    cells = [("a", 0, 0, "Title"), ("a", 2, 0, "name"), ("a", 2, 1, "n"), ("a", 2, 2, "n"), ("a", 3, 0, "x"), ("a", 3, 1, "1"), ("a", 3, 2, "2"), ("a", 3, 3, "no header")]
    cells += [("b", 0, 0, "Nom"), ("b", 1, 0, "5"), ("c", 0, 0, "only text"), ("d", 1, 0, None)]
    found = layout.grid_rows(spark.createDataFrame(cells, "s string, r int, c int, v string"), "s", "r", "c", "v", "name").collect()
    assert sorted((x.s, x.r, x.fields) for x in found) == [("a", 3, {"name": "x", "n": "1"}), ("b", 1, {"Nom": "5"})]
    empty = spark.createDataFrame([], "s string, r int, c int, v string")
    assert layout.grid_rows(empty, "s", "r", "c", "v", "name").count() == 0


def test_nearest_labels(spark):
    marks = spark.createDataFrame([(1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0)], "page int, id int, x int, y int")
    labels = [(1, 1, 5, 0, "near"), (1, 2, 6, 9, "third"), (1, 3, 6, 3, "second"), (1, 4, 6, 20, "fourth"), (1, 5, -1, 0, "left"), (2, 1, 1, 0, "a")]
    labels += [(3, i, 1, 0, "crowd") for i in range(9)]
    found = layout.nearest_labels(marks, spark.createDataFrame(labels, "page int, id int, x int, y int, text string"), "page", reach=10, aside=2, most=8)
    assert sorted((r.page, r.score, r.label) for r in found.where("label IS NOT NULL").collect()) == [(1, 5, "near second third"), (2, 1, "a")]
    assert found.count() == 3


def test_clusters_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 19], "a long, b long")
    assert {(r.u, r.label) for r in spatial.clusters(edges, "a", "b").collect()} == {(i, 0 if i <= 19 else 20) for i in range(41)}
