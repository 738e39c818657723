"""Sources and sinks that need a folder: logs, partitions, fan-out, features."""

import pytest

from sparkloom.sources import files


def test_log_skips_broken_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"kind":"a","n":1}\nbroken\n{"kind":"b","n":2}\n')
    assert files.read_jsonl_log(spark, str(tmp_path / "log.jsonl")).count() == 2


def test_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    files.overwrite_partitions(spark.createDataFrame([(9, "a")], "v int, p string"), path, "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(2, "b"), (9, "a")]


def test_first_destination_must_succeed(spark):
    def fail(_):
        raise OSError("down")

    df = spark.range(1)
    assert files.write_to_all(df, {"main": lambda d: d.count(), "mirror": fail})["mirror"].startswith("failed")
    with pytest.raises(OSError):
        files.write_to_all(df, {"main": fail})


def test_first_filled(spark):
    empty = lambda: spark.range(0)
    assert files.first_filled(empty, lambda: spark.range(3)).count() == 3
    with pytest.raises(ValueError):
        files.first_filled(empty)


def test_feature_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"type":"Point","coordinates":[1,2]}')], "id int, geometry string")
    files.write_feature_lines(df, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).select("properties.id", "geometry.type").first().asDict() == {"id": 1, "type": "Point"}
