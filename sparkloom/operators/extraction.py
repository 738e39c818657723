"""Fields in running text by a table of rules, all in one pass.

Each rule has a field, a pattern and a priority. All matches of all rules are found at once; where spans overlap, the smaller priority wins, then the
earlier, then the longer one. What is found keeps its place and rule, so a field's value can be traced to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """The value is the group ``value`` if the pattern has one, else the whole match; upper and lower case alike unless ``exact``."""

    field: str
    pattern: str
    priority: int = 0
    exact: bool = False


FOUND = "array<struct<field: string, value: string, start: int, stop: int, rule: int>>"
NAME = r"[^\W\d_][\w.'’-]*"
NUMBER = r"\d[\d'’  ]*"
STREETS = "rue|route|chemin|avenue|boulevard|place|quai|impasse|sentier|ruelle|strasse|gasse|weg"
#: Notices of land transactions and building permits in French and German.
NOTICES = (
    Rule("permit", r"\bNo CAMAC\s*(?P<value>\d+)", 0),
    Rule("permit_type", r"\b(?P<value>avis d['’]enqu[êe]te|permis de (?:construire|d[ée]molir)|permis d[ée]livr[ée])", 0),
    Rule("seller", r"\b(?:ali[ée]nat(?:eur|rice)s?|ver[äa]usserer(?:in)?)\s*:\s*(?P<value>[^;]+?)\s*(?=;|\Z)", 0),
    Rule("buyer", r"\b(?:acqu[ée]reu(?:rs?|ses?)|erwerber(?:in)?)\s*:\s*(?P<value>[^;]+?)\s*(?=;|\Z)", 0),
    Rule("acquired", r"\((?:acquis le|erworben am)\s+(?P<value>\d{1,2}\.\d{1,2}\.(?:\d{4}|\d{2}))\)", 0),
    Rule("parcel", r"\bNo\s+(?P<value>\d[\d/-]*)", 1, exact=True),
    Rule("parcel", r"\bparcelle(?:\(s\)|s)?\s*(?:no?s?\.?\s*)?(?P<value>\d+(?:\s*,\s*\d+)*)", 1),
    Rule("share", r"\bart\.\s*(?P<value>[\d-]*\d)\s*PPE\b", 1),
    Rule("surface", rf"(?P<value>{NUMBER})\s*m[2²]", 2),
    Rule("address", rf"\b(?P<value>(?:{STREETS})\s+[^;,\n]*?\d+[a-z]?)\b(?![\d'’]*\s*m[2²])", 3),
    Rule("address", r"\b(?P<value>[^\W\d_]+(?:strasse|gasse|weg)\s+\d+[a-z]?)\b", 3),
)
#: Numbers of cases, tried in this order where no named field has one.
CASES = tuple(
    Rule("case", rf"{word}\s*[:-]?\s*(?P<value>[A-Z0-9][A-Z0-9/.-]+)", i)
    for i, word in enumerate((r"\baffaire\s", r"\brequête\s*n[°o]", r"\bdossier\s*(?:n[°o])?", r"\bréférence", r"\br[ée]f\."))
)
CASE_NAMES = r"^(?:affaire|requête n|dossier|référence$|réf)"


def extract(df: DataFrame, text: str, rules: tuple[Rule, ...], name: str = "found") -> DataFrame:
    """``df`` with ``name``: what the rules find, in the order of the text. Null and empty texts have nothing; blank values don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(i, r, re.compile(r.pattern, 0 if r.exact else re.IGNORECASE)) for i, r in enumerate(rules)]
        for batch in batches:
            column = [settled(t, compiled) if t else [] for t in batch.column(place).to_pylist()]
            kind = pa.list_(pa.struct([("field", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("rule", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(column, kind)], names=[*batch.schema.names, name])

    place = df.columns.index(text)
    return df.mapInArrow(run, df.withColumn(name, F.lit(None).cast(FOUND)).schema)


def settled(text: str, compiled: list) -> list[dict]:
    """Matches of all rules without those that overlap a better one."""
    spans = []
    for i, rule, pattern in compiled:
        for m in pattern.finditer(text):
            value = m["value"] if "value" in pattern.groupindex else m[0]
            if value and value.strip():
                spans.append((rule.priority, m.start(), -m.end(), i, value.strip()))
    kept: list[tuple[int, int, int, str]] = []
    taken = bytearray(len(text)) if spans else b""
    for _, start, minus, i, value in sorted(spans):
        if not any(taken[start:-minus]):
            taken[start:-minus] = b"\x01" * (-minus - start)
            kept.append((start, -minus, i, value))
    return [{"field": compiled[i][1].field, "value": v, "start": s, "stop": e, "rule": i} for s, e, i, v in sorted(kept)]


def values(found: Column, field: str) -> Column:
    """All values of a field, in the order of the text."""
    return F.transform(F.filter(found, lambda x: x["field"] == field), lambda x: x["value"])


def first(found: Column, field: str) -> Column:
    """A field's value by its rules' order, then by place; null if there is none."""
    ordered = F.transform(F.filter(found, lambda x: x["field"] == field), lambda x: F.struct(x["rule"].alias("rule"), x["start"].alias("start"), x["value"].alias("value")))
    return F.array_min(ordered)["value"]


def named(fields: Column, pattern: str) -> Column:
    """The first filled value of a map whose key matches, in the map's order."""
    fitting = F.filter(F.map_entries(fields), lambda e: F.lower(e["key"]).rlike(pattern) & (F.trim(e["value"]) != ""))
    return F.trim(F.try_element_at(fitting, F.lit(1))["value"])


def case_number(df: DataFrame, text: str, fields: str, name: str = "case") -> DataFrame:
    """``df`` with the number of a case: a named field's if one is filled, else the first rule's that finds one in the text."""
    found = extract(df, text, CASES, "__cases")
    return found.withColumn(name, F.coalesce(named(F.col(fields), CASE_NAMES), first(F.col("__cases"), "case"))).drop("__cases")


def surface(value: Column) -> Column:
    """``1'234`` as 1234."""
    return F.regexp_replace(value, r"[^0-9]", "").try_cast("bigint")


def people(value: Column) -> Column:
    """Names in a list without titles: split at commas, ``&`` and ``et`` or ``und`` between words."""
    bare = F.regexp_replace(value, r"(?i)(^|[\s,&])(?:M\.|MM\.|Mme|Mmes|Mlle|Me|Dr\.?|Herr|Frau)(?=\s)", "$1")
    return F.filter(F.transform(F.split(bare, r"\s*,\s*|\s+(?:et|und)\s+|\s*&\s*"), lambda p: F.trim(p)), lambda p: p != "")


def permit_status(kind: Column) -> Column:
    """``pendant`` for a public inquiry, ``accordé`` for a permit, else null (C4)."""
    return F.when(kind.rlike(r"(?i)avis d['’]enqu[êe]te"), "pendant").when(kind.rlike(r"(?i)permis (?:d[ée]livr[ée]|de construire|de d[ée]molir)"), "accordé")


def employment_grade(schedule: Column, kind: Column) -> Column:
    """Grade by the schedule's words, then by the kind of employment; null where neither says."""
    has = lambda c, word: F.coalesce(F.lower(c).contains(word), F.lit(False))
    by_schedule = F.when(has(schedule, "full"), "full_time").when(has(schedule, "part"), "part_time").when(has(schedule, "intern"), "internship")
    by_kind = F.when(has(kind, "intern"), "internship").when(has(kind, "permanent"), "full_time").when(has(kind, "temporary"), "contract").when(has(kind, "freelance"), "freelance")
    return F.coalesce(by_schedule, by_kind)
