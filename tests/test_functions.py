"""Scalar functions on literal examples."""

import datetime

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import rules, text, values
from sparkloom.sources.files import snake


def one(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()], F.lit(0).alias("_")).select(column.alias("out"))
    return row.first()["out"]





@pytest.mark.parametrize(
    ("made", "given", "wanted"),
    [
        (lambda X: text.clean(X), " — ", None),
        (lambda X: text.clean(X), "  a ", "a"),
        (lambda X: text.collapse(X), "a \n b", "a b"),
        (lambda X: text.slugify(X), "Résumé & Co.", "resume_co"),
        (lambda X: text.slugify(X), "!!", "unknown"),
        (lambda X: text.format_uid(X), "CHE123456789", "CHE-123.456.789"),
        (lambda X: text.format_uid(X), "1234", "1234"),
        (lambda X: text.normalize_phone(X), "079 123 45 67", "41791234567"),
        (lambda X: text.normalize_phone(X), "0041 79 123 45 67", "41791234567"),
        (lambda X: text.normalize_phone(X), "123", None),
        (lambda X: text.html_to_text(X), "<p>a<br>b</p><ul><li>c</li></ul>", "a\nb\n\n- c"),
        (lambda X: text.html_to_markdown(X), "<h2>T</h2><p>x</p>", "## T\n\nx"),
        (lambda X: text.count_names(X), "A et B, C", 3),
        (lambda X: text.decode_entities(X), "&amp;lt;", "&lt;"),
        (lambda X: values.swiss_number(X), "CHF 1'234.50", 1234.5),
        (lambda X: values.swiss_number(X), "1.234,50", 1234.5),
        (lambda X: values.swiss_number(X), "1,5", 1.5),
        (lambda X: values.prefix_number(X), "12abc", 12.0),
        (lambda X: values.numeric(X), "1,234.5", 1234.5),
        (lambda X: values.numeric(X), "x", None),
        (lambda X: values.range_middle(X), "18-22 ans", 20.0),
        (lambda X: values.range_middle(X), "35+ ans", 35.0),
        (lambda X: values.any_date(X), "06.03.2026", datetime.date(2026, 3, 6)),
        (lambda X: values.any_date(X), "31.02.2026", None),
        (lambda X: values.french_date(X), "3 février 2024", datetime.date(2024, 2, 3)),
        (lambda X: values.french_date(X), "1er août 2023", datetime.date(2023, 8, 1)),
        (lambda X: values.keywords(X), "a; b,a", ["a", "b"]),
        (lambda X: values.half_up(X.cast("double")), "-2.5", -2),
        (lambda X: rules.first_match(X, [("É", "e"), ("b", "b")], "z"), "été", "e"),
    ],
)
def test_scalar(spark, made, given, wanted):
    assert one(spark, made(F.col("x")), x=given) == wanted


def test_two_digit_years(spark):
    got = [one(spark, values.full_year(F.col("x"), 50, inc), x=y) for y, inc in ((49, True), (50, True), (50, False), (51, False))]
    assert got == [2049, 1950, 2050, 1951]


def test_snake():
    assert [snake(x) for x in ("statutDA", "Née le (date)", "﻿A b")] == ["statut_da", "née_le_date", "a_b"]
