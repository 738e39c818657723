"""Overlays, similar names, keywords in texts and names that begin alike, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import fuzzy, keywords, overlay
from sparkloom.session import table


def ring(*points):
    """A ring of corners given as pairs of columns."""
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points])


def overlay_shares(spark, sf_dir):
    """customers' L-shaped plots with a yard against suppliers' frames: shared area and shares, above 2 and up to 0.3 of the plot."""
    x, y = F.col("c_custkey") * 37 % 400, F.col("c_custkey") * 61 % 390
    outer = ring((x, y), (x + 8, y), (x + 8, y + 3), (x + 3, y + 3), (x + 3, y + 10), (x, y + 10))
    yard = ring((x + 1, y + 4), (x + 1, y + 6), (x + 2, y + 6), (x + 2, y + 4))
    plots = table(spark, sf_dir, "customer").select("c_custkey", F.array(outer, yard).alias("rings"))
    u, v = F.col("s_suppkey") * 53 % 400, F.col("s_suppkey") * 29 % 390
    box = lambda d: ring((u + d, v + d), (u + 20 - d, v + d), (u + 20 - d, v + 20 - d), (u + d, v + 20 - d))
    frames = table(spark, sf_dir, "supplier").select("s_suppkey", F.array(box(0), box(5)).alias("rings"))
    return overlay.overlay(plots, frames, "c_custkey", "s_suppkey", "rings", size=20.0, least_area=2.0, most_share=0.3)


OVERLAY = """WITH c AS (SELECT c_custkey, c_custkey * 37 % 400 AS x, c_custkey * 61 % 390 AS y FROM customer),
s AS (SELECT s_suppkey, s_suppkey * 53 % 400 AS u, s_suppkey * 29 % 390 AS v FROM supplier),
a AS (SELECT c_custkey, x + p[1] AS x0, y + p[2] AS y0, x + p[3] AS x1, y + p[4] AS y1, p[5] AS sign FROM c, (SELECT unnest([[0, 0, 8, 3, 1], [0, 3, 3, 10, 1], [1, 4, 2, 6, -1]]) AS p)),
b AS (SELECT s_suppkey, u + p[1] AS x0, v + p[1] AS y0, u + p[2] AS x1, v + p[2] AS y1, p[3] AS sign FROM s, (SELECT unnest([[0, 20, 1], [5, 15, -1]]) AS p)),
m AS (SELECT c_custkey, s_suppkey, sum(a.sign * b.sign * greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)))::DOUBLE AS area FROM a, b GROUP BY ALL)
SELECT c_custkey, s_suppkey, area, area / 43 AS left_share, area / 300 AS right_share FROM m WHERE area > 2 AND area / 43 <= 0.3"""


def fuzzy_match(spark, sf_dir):
    """Each part's name and size against all other parts' names: the most alike one, how many reach 85, and whether it leads by 5."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"))
    pairs = fuzzy.near_pairs(p, p, "name", "name").where("value <> other")
    return fuzzy.best_match(p, "name", pairs)


SCORED = """s AS (SELECT value, other, max(score) AS score FROM (
SELECT v.value, o.other, unnest([100 * (greatest(length(v.f[1]), length(o.f[1])) - levenshtein(v.f[1], o.f[1])) // greatest(length(v.f[1]), length(o.f[1])),
95 * (greatest(length(v.f[2]), length(o.f[2])) - levenshtein(v.f[2], o.f[2])) // greatest(length(v.f[2]), length(o.f[2])),
95 * (greatest(length(v.f[3]), length(o.f[3])) - levenshtein(v.f[3], o.f[3])) // greatest(length(v.f[3]), length(o.f[3]))]) AS score FROM v CROSS JOIN o) WHERE score >= 85 AND KEEP GROUP BY ALL),
r AS (SELECT value, other, score, count(*) OVER (PARTITION BY value) AS candidates, score - coalesce(lead(score) OVER w, 0) AS ahead FROM s WINDOW w AS (PARTITION BY value ORDER BY score DESC, other) QUALIFY row_number() OVER w = 1)"""
THREE = "[lower(NAME), array_to_string(list_sort(string_split(lower(NAME), ' ')), ' '), array_to_string(list_sort(list_distinct(string_split(lower(NAME), ' '))), ' ')]"
STATUS = "coalesce(candidates, 0) AS candidates, CASE WHEN other IS NULL THEN 'unmatched' WHEN ahead >= 5 THEN 'matched' ELSE 'needs_review' END AS status"

MATCH = f"""WITH p AS (SELECT p_partkey, p_name || ' ' || p_size AS name FROM part), n AS (SELECT DISTINCT name FROM p),
v AS (SELECT name AS value, {THREE.replace("NAME", "name")} AS f FROM n), o AS (SELECT value AS other, f FROM v),
{SCORED.replace("KEEP", "value <> other")}
SELECT p_partkey, name, other, score, {STATUS} FROM p LEFT JOIN r ON name = value"""


def fuzzy_names(spark, sf_dir):
    """Part names with a lost letter, tokens in another order or said twice, or unlike any, against the list of all names; equal names are one row on both sides."""
    p = table(spark, sf_dir, "part")
    key, name = F.col("p_partkey"), F.concat_ws(" ", "p_name", (F.col("p_size") % 10).cast("string"))
    lost, swapped, unlike = F.concat(F.substring(name, 1, 2), F.substring(name, 4, 200)), F.concat_ws(" ", (F.col("p_size") % 10).cast("string"), "p_name", "p_name"), F.concat(F.lit("??"), F.reverse(name))
    noisy = F.when(key % 15 == 2, unlike).when(key % 3 == 0, lost).when(key % 3 == 1, swapped).otherwise(name)
    parts = p.select(key, noisy.alias("given"))
    return fuzzy.best_match(parts, "given", fuzzy.near_pairs(parts, p.select(name.alias("other")), "given", "other"))


NAMES = f"""WITH p AS (SELECT p_partkey, p_name AS base, p_size % 10 AS size, p_name || ' ' || p_size % 10 AS name FROM part),
g AS (SELECT p_partkey, CASE WHEN p_partkey % 15 = 2 THEN '??' || reverse(name) WHEN p_partkey % 3 = 0 THEN substr(name, 1, 2) || substr(name, 4) WHEN p_partkey % 3 = 1 THEN size || ' ' || base || ' ' || base ELSE name END AS given FROM p),
v AS (SELECT given AS value, {THREE.replace("NAME", "given")} AS f FROM (SELECT DISTINCT given FROM g)), o AS (SELECT name AS other, {THREE.replace("NAME", "name")} AS f FROM (SELECT DISTINCT name FROM p)),
{SCORED.replace("KEEP", "true")}
SELECT p_partkey, given, other, score, {STATUS} FROM g LEFT JOIN r ON given = value"""


def benchmark_words(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split(F.regexp_replace("text", "[.,\n]", " "), " ")).alias("word"))


def theme_keywords(spark, sf_dir):
    """The longest word of the benchmark items, of five letters or more, that a document's text contains; ties by the first item with it, then the word."""
    words = benchmark_words(spark, sf_dir).where("length(word) >= 5").groupBy("word").agg(F.min("item_id").alias("item"))
    ranks = words.withColumn("rank", F.col("item") * 1_000_000 + F.pmod(F.conv(F.substring(F.md5("word"), 1, 7), 16, 10).cast("bigint"), F.lit(1_000_000)))
    found = keywords.longest_keyword(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ranks, "word", "rank")
    return found.select("doc_id", "keyword", F.floor(F.col("keyword_order") / 1_000_000).alias("item"))


THEMES = """WITH w AS (SELECT word, min(item_id) AS item FROM (SELECT item_id, unnest(string_split(regexp_replace(text, '[.,\n]', ' ', 'g'), ' ')) AS word FROM benchmark) WHERE length(word) >= 5 GROUP BY word),
k AS (SELECT word, item, item * 1000000 + ('0x' || left(md5(word), 7))::BIGINT % 1000000 AS rank FROM w),
f AS (SELECT doc_id, word, item FROM documents JOIN k ON contains(text, word) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(word) DESC, rank) = 1)
SELECT d.doc_id, word AS keyword, item FROM documents d LEFT JOIN f USING (doc_id)"""


def prefix_lookup(spark, sf_dir):
    """documents' first words looked up among the benchmark's words: exact, as an alias, without an ending, or by a beginning either way."""
    words = benchmark_words(spark, sf_dir).select(F.lower("word").alias("entry")).where("length(entry) >= 5").distinct()
    aliases = words.select(F.reverse("entry").alias("alias"), "entry").union(words.select(F.concat("entry", F.lit(",")), "entry"))
    first = F.lower(F.split(F.col("text"), "[ \n]")[0])
    docs = table(spark, sf_dir, "documents").select("doc_id", first.alias("first"))
    return keywords.cascade(docs, "first", words, "entry", aliases, "alias", suffix="s|ly|ment|ión|ung|[.,]", least=4)


PREFIXES = """WITH w AS (SELECT DISTINCT lower(word) AS entry FROM (SELECT unnest(string_split(regexp_replace(text, '[.,\n]', ' ', 'g'), ' ')) AS word FROM benchmark) WHERE length(word) >= 5),
d AS (SELECT doc_id, lower(string_split_regex(text, '[ \n]')[1]) AS first FROM documents),
n AS (SELECT DISTINCT first, regexp_replace(first, '(?:s|ly|ment|ión|ung|[.,])$', '') AS bare FROM d),
a AS (SELECT alias, min(entry) AS entry FROM (SELECT reverse(entry) AS alias, entry FROM w UNION ALL SELECT entry || ',', entry FROM w) GROUP BY alias),
t AS (SELECT n.first, x.entry AS e, a.entry AS s, b.entry AS b FROM n LEFT JOIN w x ON x.entry = n.first LEFT JOIN a ON a.alias = n.first LEFT JOIN w b ON b.entry = n.bare),
p AS (SELECT t.first, w.entry FROM t JOIN w ON (starts_with(t.first, w.entry) OR starts_with(w.entry, t.first)) AND length(t.first) >= 4 WHERE coalesce(e, s, b) IS NULL
QUALIFY row_number() OVER (PARTITION BY t.first ORDER BY least(length(t.first), length(w.entry)) DESC, w.entry) = 1)
SELECT d.doc_id, d.first, coalesce(e, s, b, p.entry) AS entry, CASE WHEN e IS NOT NULL THEN 'exact' WHEN s IS NOT NULL THEN 'alias' WHEN b IS NOT NULL THEN 'suffix' WHEN p.entry IS NOT NULL THEN 'prefix' END AS tier
FROM d LEFT JOIN t ON t.first = d.first LEFT JOIN p ON p.first = d.first"""

QUERIES = {
    "overlay_shares": (overlay_shares, OVERLAY),
    "fuzzy_match": (fuzzy_match, MATCH),
    "fuzzy_names": (fuzzy_names, NAMES),
    "theme_keywords": (theme_keywords, THEMES),
    "prefix_lookup": (prefix_lookup, PREFIXES),
}
