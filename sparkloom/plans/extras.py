"""Fuzzy and prefix lookups, geometry, clusters, ordered children and sampling over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions import text, values
from sparkloom.operators import spatial
from sparkloom.session import table


def point_in_zone(spark, sf_dir):
    """Suppliers as points in a triangle, and the triangle's area."""
    s = table(spark, sf_dir, "supplier")
    x, y = (F.col("s_suppkey") * 37 % 100 + 0.5).cast("double"), (F.col("s_suppkey") * 61 % 100 + 0.25).cast("double")
    zone = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((0, 0), (90, 0), (0, 90))])
    wkt = F.format_string("POINT(%.2f %.2f)", x, y)
    return s.select("s_suppkey", spatial.contains_point(zone, x, y).alias("inside"), spatial.ring_area(zone).alias("area"), wkt.alias("wkt"))


ZONE = """WITH p AS (SELECT s_suppkey, s_suppkey * 37 % 100 + 0.5 AS x, s_suppkey * 61 % 100 + 0.25 AS y FROM supplier)
SELECT s_suppkey, x + y < 90 AS inside, 4050.0::DOUBLE AS area, printf('POINT(%.2f %.2f)', x::DOUBLE, y::DOUBLE) AS wkt FROM p"""


def cluster_labels(spark, sf_dir):
    """Parts of a brand whose keys differ by less than 40 are one cluster, by gaps in key order (a chain needs no graph)."""
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    p = table(spark, sf_dir, "part").withColumn("new", (F.col("p_partkey") - F.coalesce(F.lag("p_partkey").over(w), F.lit(-1000)) >= 40).cast("int"))
    p = p.withColumn("island", F.sum("new").over(w))
    return p.groupBy("p_brand", "island").agg(F.min("p_partkey").alias("label"), F.count("*").alias("n")).drop("island")


CLUSTERS = """WITH g AS (SELECT *, CASE WHEN p_partkey - coalesce(lag(p_partkey) OVER w, -1000) >= 40 THEN 1 ELSE 0 END AS new FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)),
i AS (SELECT *, sum(new) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS island FROM g)
SELECT p_brand, min(p_partkey) AS label, count(*) AS n FROM i GROUP BY p_brand, island"""


def unseen_children(spark, sf_dir):
    """Lines that aren't known yet, numbered by order; the first of an order without known lines leads."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    known = lines.where("l_linenumber % 3 = 0 AND l_orderkey % 2 = 0").select("l_orderkey", "l_linenumber")
    counts = known.groupBy("l_orderkey").agg(F.count("*").alias("known"))
    fresh = lines.join(known, ["l_orderkey", "l_linenumber"], "left_anti").join(counts, "l_orderkey", "left")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
    return fresh.select("l_orderkey", "l_linenumber", "part", (place + F.coalesce("known", F.lit(0))).alias("place"), (F.col("known").isNull() & (place == 1)).alias("leads"))


UNSEEN = """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2), k AS (SELECT * FROM l WHERE l_linenumber % 3 = 0 AND l_orderkey % 2 = 0), c AS (SELECT l_orderkey, count(*) AS known FROM k GROUP BY 1),
f AS (SELECT * FROM l ANTI JOIN k USING (l_orderkey, l_linenumber))
SELECT f.l_orderkey, l_linenumber, part, row_number() OVER w + coalesce(known, 0) AS place, known IS NULL AND row_number() OVER w = 1 AS leads FROM f LEFT JOIN c ON f.l_orderkey = c.l_orderkey WINDOW w AS (PARTITION BY f.l_orderkey ORDER BY l_linenumber)"""


def scoped_blocklist(spark, sf_dir):
    """Labels dropped by a list, by a list that holds in one group only, and by the names of a reference set."""
    p = table(spark, sf_dir, "part")
    names = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("label"))
    labelled = p.withColumn("label", F.lower(F.split_part("p_type", F.lit(" "), F.lit(1))))
    kept = labelled.where(~F.col("label").isin("promo", "small") & ~((F.col("p_brand") == "Brand#1") & F.col("p_type").ilike("%steel%")))
    return kept.join(names, "label", "left_anti").select("p_partkey", "label")


SCOPED = """SELECT p_partkey, lower(split_part(p_type, ' ', 1)) AS label FROM part WHERE lower(split_part(p_type, ' ', 1)) NOT IN ('promo', 'small') AND NOT (p_brand = 'Brand#1' AND p_type ILIKE '%steel%') AND lower(split_part(p_type, ' ', 1)) NOT IN (SELECT lower(n_name) FROM nation)"""


def random_batch(spark, sf_dir):
    """100 orders in an order that a seed and the key fix."""
    o = table(spark, sf_dir, "orders").withColumn("draw", F.md5(F.concat(F.lit("seed7-"), F.col("o_orderkey").cast("string"))))
    return o.orderBy("draw").limit(100).select("o_orderkey")


RANDOM = "SELECT o_orderkey FROM orders ORDER BY md5('seed7-' || o_orderkey) LIMIT 100"


def early_stop(spark, sf_dir):
    """Orders whose newest date of three lies in the last 180 days."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    o = table(spark, sf_dir, "orders")
    last = F.lit(o.agg(F.max("o_orderdate")).first()[0])  # one value
    j = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    newest = F.greatest("o_orderdate", "shipped", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")))
    return j.where(newest >= last - F.expr("INTERVAL 180 DAYS")).select("o_orderkey", "o_orderstatus")


EARLY = """WITH l AS (SELECT l_orderkey, max(l_shipdate) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus FROM orders LEFT JOIN l ON o_orderkey = l_orderkey WHERE greatest(o_orderdate, s, CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 90 DAYS END) >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 180 DAYS"""


def colours(spark, sf_dir):
    """Colours of parts, back and forth, and the middle of a range text."""
    r, g, b = (F.col("p_partkey") * k % 256 for k in (3, 7, 11))
    code = values.to_hex(r, g, b)
    red = F.conv(F.substring(code, 2, 2), 16, 10).cast("bigint")
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("colour"), red.alias("red"), values.range_middle(F.concat(F.col("p_size").cast("string"), F.lit("-"), (F.col("p_size") + 5).cast("string"), F.lit(" y"))).alias("middle"))


COLOURS = "SELECT p_partkey, '#' || printf('%02x', (p_partkey * 3 % 256)::INT) || printf('%02x', (p_partkey * 7 % 256)::INT) || printf('%02x', (p_partkey * 11 % 256)::INT) AS colour, p_partkey * 3 % 256 AS red, p_size + 2.5::DOUBLE AS middle FROM part"


def first_lines(spark, sf_dir):
    """First line, first sentence and the words between two marks in documents."""
    d = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    return d.select("doc_id", F.md5(F.element_at(lines, 1)).alias("first_line"), F.size(lines).cast("bigint").alias("n_lines"), F.coalesce(text.between(F.col("text"), 'token = "', '"'), F.lit("~")).alias("secret"), (text.word_count(F.element_at(lines, 1)) > 3).alias("long_title"))


FIRST_LINES = r"""SELECT doc_id, md5(string_split(text, chr(10))[1]) AS first_line, len(string_split(text, chr(10))) AS n_lines, coalesce(nullif(regexp_extract(text, '(?s)token = "(.*?)"', 1), ''), '~') AS secret,
len(list_filter(regexp_split_to_array(string_split(text, chr(10))[1], '\s+'), lambda w: w <> '')) > 3 AS long_title FROM documents"""


def order_chain(spark, sf_dir):
    """Lines back to their orders' customers by key, distinct, ten largest nations."""
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_nationkey").agg(F.countDistinct("o_custkey").alias("customers"), F.count("*").alias("lines")).orderBy(F.desc("lines"), "c_nationkey").limit(10)


CHAIN = """SELECT c_nationkey, count(DISTINCT o_custkey) AS customers, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY lines DESC, c_nationkey LIMIT 10"""

QUERIES = {
    "point_in_zone": (point_in_zone, ZONE),
    "clusters": (cluster_labels, CLUSTERS),
    "unseen_children": (unseen_children, UNSEEN),
    "scoped_blocklist": (scoped_blocklist, SCOPED),
    "random_batch": (random_batch, RANDOM),
    "early_stop": (early_stop, EARLY),
    "colours": (colours, COLOURS),
    "first_lines": (first_lines, FIRST_LINES),
    "order_chain": (order_chain, CHAIN),
}
