"""File sources (R1-R9, R13-R16, R20-R24, R28-R31, R33) and file sinks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def snake(name: str) -> str:
    """Header to snake case: camel humps and anything that isn't a word become underscores."""
    name = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name.replace("﻿", ""))
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"_+", "_", re.sub(r"[^\w]+|\s+", "_", name)).strip("_").lower()


def sniff_delimiter(spark: SparkSession, path: str, candidates: str = "|,;\t") -> str:
    """The candidate that the first line holds most often; earlier ones win ties."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    return max(candidates, key=lambda c: (line.count(c), -candidates.index(c)))


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None, separator: str | None = None, encoding: str = "UTF-8", header: bool = True, multiline: bool = False) -> DataFrame:
    """CSV with a sniffed delimiter, all columns as text unless a schema is given.

    Ragged rows are read; missing cells are null. Headers become snake case.
    """
    separator = separator or sniff_delimiter(spark, path if isinstance(path, str) else path[0])
    reader = spark.read.options(sep=separator, header=header, encoding=encoding, quote='"', escape='"', multiLine=multiline, mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.toDF(*[snake(c) for c in df.columns]) if header and not schema else df


def read_zipped_csv(spark: SparkSession, path: str, separator: str = ";", encoding: str = "utf-8") -> DataFrame:
    """Members of ZIP archives as text rows ``(archive, member, line)`` (R1): archives are read whole, one a task."""
    import io
    import zipfile

    def run(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as f:
                            lines = [x.decode(encoding).lstrip("﻿").rstrip("\r\n") for x in f]
                        yield pd.DataFrame({"archive": name, "member": member, "place": range(len(lines)), "line": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, place bigint, line string")


def read_partitioned_csv(spark: SparkSession, paths: list[str], pattern: str, name: str) -> DataFrame:
    """One file a partition value; the value comes from the file name."""
    return read_csv(spark, paths).withColumn(name, F.regexp_extract(F.input_file_name(), pattern, 1))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Paged feature JSON: attributes as columns, geometry as JSON text."""
    pages = spark.read.option("multiLine", True).json(path)
    each = pages.select(F.explode("features").alias("f"))
    shape = each.schema["f"].dataType.fieldNames()
    attributes = "attributes" if "attributes" in shape else "properties"
    geometry = [F.to_json("f.geometry").alias("geometry")] if "geometry" in shape else []
    return each.select(f"f.{attributes}.*", *geometry)


def read_json_pages(spark: SparkSession, path: str, records: str | None = None) -> DataFrame:
    """A folder of JSON pages, one record a row."""
    pages = spark.read.option("multiLine", True).json(path)
    return pages.select(F.explode(records).alias("r")).select("r.*") if records else pages


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """XML rows without name spaces."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
    return (reader.schema(schema) if schema else reader).load(path)


def read_jsonl_log(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A run log; broken lines are left out (K14). With a ``schema`` the log is read once, else once more to infer it."""
    lines = spark.read.text(path).where(F.try_parse_json("value").isNotNull())
    fields = (schema or spark.read.json(path).schema).fields
    return lines.select(F.from_json("value", StructType([f for f in fields if f.name != "_corrupt_record"])).alias("row")).select("row.*")


def append_jsonl_log(df: DataFrame, path: str) -> None:
    """Adds rows to a run log, a JSON object a line; what is there stays."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def routed(frames: dict[str, DataFrame], routes: dict[str, dict], field: str = "table") -> dict[str, DataFrame]:
    """Target table to what goes there, for one destination: ``field`` picks the table's name in each set's route, ``renames`` the columns' (I18).

    Sets whose route names no table for this destination are left out; two that name the same one, or a set without a route, are an error.
    """
    found: dict[str, DataFrame] = {}
    for name, df in frames.items():
        route = routes[name]
        target = route.get(field)
        if not target:
            continue
        if target in found:
            raise ValueError(f"two sets go to {target}")
        found[target] = df.withColumnsRenamed(route.get("renames", {}))
    return found


def read_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A database table; predicates and columns are pushed down by Spark."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def first_filled(*readers: Callable[[], DataFrame]) -> DataFrame:
    """The first source that can be read and has rows."""
    failure: Exception | None = None
    for reader in readers:
        try:
            df = reader()
            if not df.isEmpty():
                return df
        except Exception as error:  # noqa: BLE001 - any failing source gives way to the next
            failure = error
    raise ValueError("no source has rows") from failure


def write_to_all(df: DataFrame, writers: dict[str, Callable[[DataFrame], None]]) -> dict[str, str]:
    """Writes to every destination; the first must succeed, the others' failures are reported (K8, K9)."""
    done = {}
    for i, (name, write) in enumerate(writers.items()):
        try:
            write(df)
            done[name] = "ok"
        except Exception as error:  # noqa: BLE001 - mirrors are best effort
            if i == 0:
                raise
            done[name] = f"failed: {error}"[:200]
    return done


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replaces only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def write_feature_lines(df: DataFrame, path: str, geometry: str = "geometry") -> None:
    """One GeoJSON feature a line; a collection of any size stays distributed."""
    rest = [c for c in df.columns if c != geometry]
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.parse_json(geometry).alias("geometry"), F.struct(*rest).alias("properties")))
    df.select(feature.alias("value")).write.text(path)
