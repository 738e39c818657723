"""Similarity joins of names on an inverted q-gram index.

A name is compared in three forms: as it is, with its tokens sorted, and with its distinct tokens sorted; the latter two weigh
95 in a hundred. Names reach a score only within a number of edits that their length gives, so each form is listed under its rarest
``q * edits + 1`` q-grams (repeats numbered): forms that can reach the score meet in a list. Their lengths must fit, then the distance decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Form and its weight in a hundred.
FORMS = (("plain", 100), ("sorted", 95), ("set", 95))


def forms(df: DataFrame, name: str) -> DataFrame:
    """``(value, kind, weight, form)`` for each distinct name that isn't blank."""
    values = df.select(F.col(name).alias("value")).where(F.trim(name) != "").distinct()
    plain = F.lower(F.trim("value"))
    tokens = F.filter(F.split(plain, " "), lambda t: t != "")
    made = (plain, F.concat_ws(" ", F.array_sort(tokens)), F.concat_ws(" ", F.array_sort(F.array_distinct(tokens))))
    each = [F.struct(F.lit(kind).alias("kind"), F.lit(weight).alias("weight"), form.alias("form")) for (kind, weight), form in zip(FORMS, made, strict=True)]
    return values.select("value", F.inline(F.array(*each)))


def edits(longest: Column, threshold: int) -> Column:
    """Edits within which forms reach ``threshold`` in a hundred, by the longer one's length."""
    return F.floor(longest * (F.col("weight") - threshold) / F.col("weight")).cast("int")


def listed(made: DataFrame, counted: DataFrame, threshold: int, q: int) -> DataFrame:
    """The lists that each form is in: ``(kind, gram, form, weight, length)``."""
    rank = F.row_number().over(Window.partitionBy("kind", "form").orderBy("df", "gram"))
    longest = F.floor(F.col("length") * F.col("weight") / threshold)
    return grams(made, q).join(counted, ["kind", "gram"]).withColumn("rank", rank).where(F.col("rank") <= q * edits(longest, threshold) + 1).select("kind", "gram", "form", "weight", "length")


def grams(made: DataFrame, q: int) -> DataFrame:
    """``(kind, form, weight, length, gram)``: q-grams of the padded forms, a gram's repeats numbered."""
    padded = F.concat(F.lit("\x01" * (q - 1)), "form", F.lit("\x02" * (q - 1)))
    each = F.transform(F.sequence(F.lit(1), F.length("form") + q - 1), lambda i: F.substring(F.col("padded"), i, F.lit(q)))
    numbered = F.transform("each", lambda g, i: F.concat(g, F.size(F.filter(F.slice("each", F.lit(1), i), lambda h: h == g)).cast("string")))
    split = made.select("kind", "weight", "form").distinct().withColumn("padded", padded).withColumn("each", each)
    return split.select("kind", "form", "weight", F.length("form").alias("length"), F.explode(numbered).alias("gram"))


def candidates(left: DataFrame, right: DataFrame, threshold: int, q: int = 2) -> DataFrame:
    """``(kind, weight, form, form_b)``: the pairs of forms that are compared."""
    counted = grams(left.unionByName(right), q).groupBy("kind", "gram").agg(F.count("*").alias("df"))
    a = listed(left, counted, threshold, q)
    b = listed(right, counted, threshold, q).select("kind", "gram", F.col("form").alias("form_b"), F.col("length").alias("length_b"))
    fits = F.abs(F.col("length") - F.col("length_b")) <= edits(F.greatest("length", "length_b"), threshold)
    return a.join(b, ["kind", "gram"]).where(fits).select("kind", "weight", "form", "form_b").distinct()


def near_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, threshold: int = 85, q: int = 2) -> DataFrame:
    """``(value, other, score)``: distinct names of both sides whose weighted score reaches ``threshold`` of 100."""
    a, b = forms(left, left_name), forms(right, right_name)
    longest = F.greatest(F.length("form"), F.length("form_b"))
    scored = candidates(a, b, threshold, q).withColumn("d", F.levenshtein("form", "form_b")).withColumn("score", F.floor(F.col("weight") * (longest - F.col("d")) / longest)).where(F.col("score") >= threshold)
    named = scored.join(a.select("kind", "form", "value"), ["kind", "form"]).join(b.select("kind", F.col("form").alias("form_b"), F.col("value").alias("other")), ["kind", "form_b"])
    return named.groupBy("value", "other").agg(F.max("score").alias("score"))


def best_match(df: DataFrame, name: str, pairs: DataFrame, ahead: int = 5) -> DataFrame:
    """``df`` with ``other``, ``score``, ``candidates`` and ``status``: a match is ``ahead`` points before the next, else it needs review.

    Rows without a partner stay as unmatched. Of equal scores the smaller name comes first.
    """
    order = Window.partitionBy("value").orderBy(F.desc("score"), "other")
    ranked = pairs.withColumn("__rank", F.row_number().over(order)).where("__rank <= 2")
    first, second = F.col("__rank") == 1, F.col("__rank") == 2
    top = ranked.groupBy("value").agg(F.max(F.when(first, F.col("other"))).alias("other"), F.max(F.when(first, F.col("score"))).alias("score"), F.max(F.when(second, F.col("score"))).alias("__next"))
    counted = pairs.groupBy("value").agg(F.count("*").alias("candidates"))
    found = df.join(top.join(counted, "value").withColumnRenamed("value", name), name, "left")
    clear = F.col("score") - F.coalesce("__next", F.lit(0)) >= ahead
    status = F.when(F.col("other").isNull(), "unmatched").when(clear, "matched").otherwise("needs_review")
    return found.withColumn("status", status).withColumn("candidates", F.coalesce("candidates", F.lit(0))).drop("__next")
