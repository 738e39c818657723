"""Keyed loads with null and repeated keys, tables on storage and checked loads."""

import os

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import keyed, tables
from tests.conftest import canonical


def frame(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


def test_changes_of_one_key_leave_one_row(spark):
    base = frame(spark, [(1, "a"), (2, "b"), (None, "n"), (5, "e")])
    changes = frame(spark, [(1, "x", "C"), (1, "y", "C"), (3, "p", "A"), (3, "q", "A"), (None, "m", "C"), (None, "z", "A"), (2, None, "D"), (7, "no", "C"), (9, "no", "D")], "k int, v string, s string")
    once = keyed.apply_changes(base, changes, ["k"], "s")
    assert canonical(once.collect()) == canonical([(1, "y"), (None, "m"), (5, "e"), (3, "q")])
    assert canonical(keyed.apply_changes(once, changes.where("s <> 'D'"), ["k"], "s").collect()) == canonical(once.collect())
    first = keyed.apply_changes(base, changes, ["k"], "s", order=[F.col("v")])
    assert {r.k: r.v for r in first.collect()} == {1: "x", None: "m", 5: "e", 3: "p"}


def test_null_keys_are_inserted_once(spark):
    base, source = frame(spark, [(1, "a")]), frame(spark, [(None, "x"), (None, "y"), (1, "z"), (2, "b")])
    grown = base.union(keyed.insert_absent(base, source, ["k"]))
    assert canonical(grown.collect()) == canonical([(1, "a"), (None, "y"), (2, "b")])
    assert keyed.insert_absent(grown, source, ["k"]).count() == 0


def test_delete_missing_with_null_parents_and_children(spark):
    schema = "p int, c int, v string"
    target = frame(spark, [(1, 1, "a"), (1, 2, "b"), (1, None, "c"), (None, 1, "d"), (None, 2, "e"), (3, 1, "f")], schema)
    source = frame(spark, [(1, None, "-"), (1, 1, "-"), (1, 1, "-"), (None, 2, "-")], schema)
    assert canonical(keyed.delete_missing(target, source, ["p"], ["c"]).collect()) == canonical([(1, 1, "a"), (1, None, "c"), (None, 2, "e"), (3, 1, "f")])
    assert keyed.delete_missing(target, source.limit(0), ["p"], ["c"]).count() == 6


def files_of(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_merges_rewrite_changed_buckets_alone(spark, tmp_path):
    folder = str(tmp_path / "t")
    table = tables.ManifestTable(spark, folder, ["k"], buckets=8)
    with pytest.raises(ValueError):
        table.read()
    rows = [(i, f"v{i}") for i in range(100)] + [(None, "null")]
    assert len(table.merge(frame(spark, rows), [F.col("v")], batch=0)) == 8
    before, old = files_of(folder), table.read()
    touched = table.merge(frame(spark, [(7, "new"), (7, "newer"), (None, "again")]), [F.desc("v")], batch=1)
    assert 1 <= len(touched) <= 2 and before <= files_of(folder)
    assert len(files_of(folder) - before) == len(touched)
    wanted = {**dict(rows), 7: "newer", None: "again"}
    assert {r.k: r.v for r in table.read().collect()} == wanted and table.read().count() == 101
    assert {r.k: r.v for r in old.collect()} == dict(rows) and table.read(1).count() == 101  # readers of the old version go on
    assert table.merge(frame(spark, [(7, "replayed")]), [F.desc("v")], batch=1) == []
    assert table.merge(frame(spark, []), [F.desc("v")], batch=2) == [] and table.versions() == [1, 2, 3]
    assert table.vacuum(keep=1) == len(touched) and table.versions() == [3]
    assert {r.k: r.v for r in table.read().collect()} == wanted
    with pytest.raises(RuntimeError):
        table.commit(table.manifest())


def test_checked_load_counts_in_the_writing_pass(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = frame(spark, [(1, "a"), (2, None), (None, "c"), (-1, "c"), (-2, "d")]).mapInArrow(count, "k int, v string")
    got = {}

    def fail(_):
        raise OSError("mirror is down")

    rules = {"positive": F.col("k") > 0, "not_c": F.col("v") != "c"}
    report, passed, failed = tables.checked_load(df, rules, str(tmp_path / "load"), {"main": lambda x: got.update(main=x.count()), "mirror": fail, "copy": lambda x: got.update(copy=x.count())})
    assert report == {"rows": 5, "loaded": 2, "positive": 2, "not_c": 2, "main": "ok", "mirror": "failed: mirror is down", "copy": "ok"}
    assert runs.value == 5 and got == {"main": 2, "copy": 2}
    assert canonical(passed.collect()) == canonical([(1, "a"), (2, None)])
    assert {(r.k, tuple(r.violations)) for r in failed.collect()} == {(None, ("not_c",)), (-1, ("positive", "not_c")), (-2, ("positive",))}
    with pytest.raises(OSError):
        tables.checked_load(df, rules, str(tmp_path / "again"), {"main": fail})
    assert tables.checked_load(df.limit(0), rules, str(tmp_path / "empty"))[0]["rows"] == 0
