"""Joins, set operations, reshaping and aggregation over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.operators import joins, shape
from sparkloom.session import table


def anti_join_no_children(spark, sf_dir):
    """Parts without a line of 45 or more pieces."""
    big = table(spark, sf_dir, "lineitem").where("l_quantity >= 45")
    return table(spark, sf_dir, "part").join(big, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


ANTI = "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)"


def semi_join_resample(spark, sf_dir):
    """A fixed tenth of the users that bought, by a hash of the key."""
    e = table(spark, sf_dir, "events")
    users = e.select("user_id").distinct().where(F.substring(F.md5(F.col("user_id").cast("string")), 1, 1).isin("0", "1"))
    return users.join(e.where("event_type = 'purchase'"), "user_id", "left_semi")


SEMI = "SELECT DISTINCT user_id FROM events WHERE substr(md5(user_id::VARCHAR), 1, 1) IN ('0', '1') AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')"


def null_safe_join(spark, sf_dir):
    """Nations and regions on keys that may be null on both sides."""
    n = table(spark, sf_dir, "nation").select("n_name", F.nullif("n_regionkey", F.lit(2)).alias("k"))
    r = table(spark, sf_dir, "region").select("r_name", F.nullif("r_regionkey", F.lit(2)).alias("rk"))
    return n.join(r, F.col("k").eqNullSafe(F.col("rk"))).select("n_name", "r_name")


NULL_SAFE = "SELECT n_name, r_name FROM nation JOIN region ON nullif(n_regionkey, 2) IS NOT DISTINCT FROM nullif(r_regionkey, 2)"


def name_bridge_join(spark, sf_dir):
    """Customers to regions through names, counted."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    bridge = n.join(r, n.n_regionkey == r.r_regionkey).select(F.lower("n_name").alias("name"), "r_name")
    named = c.join(n, c.c_nationkey == n.n_nationkey).select(F.lower("n_name").alias("name"), "c_acctbal")
    return named.join(bridge, "name").groupBy("r_name").agg(F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))


NAME_BRIDGE = """SELECT r_name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""


def cascading_lookup(spark, sf_dir):
    """Part types found by whole name, then by the first word, then not at all."""
    p = table(spark, sf_dir, "part")
    exact = p.where("p_size > 40").groupBy("p_type").agg(F.min("p_partkey").alias("ref"))
    loose = p.where("p_size > 10").groupBy(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("word")).agg(F.min("p_partkey").alias("ref"))
    found = joins.first_of_tiers(p, [(F.col("p_type"), exact.withColumnRenamed("p_type", "t"), "t", "ref"), (F.split_part("p_type", F.lit(" "), F.lit(1)), loose, "word", "ref")], "ref_key")
    return found.select("p_partkey", "ref_key")


CASCADE = """WITH e AS (SELECT p_type, min(p_partkey) AS r FROM part WHERE p_size > 40 GROUP BY 1), l AS (SELECT split_part(p_type, ' ', 1) AS w, min(p_partkey) AS r FROM part WHERE p_size > 10 GROUP BY 1)
SELECT p_partkey, coalesce(e.r, l.r) AS ref_key FROM part LEFT JOIN e USING (p_type) LEFT JOIN l ON w = split_part(p_type, ' ', 1)"""


def lateral_first_child(spark, sf_dir):
    """Each conversation's first turn."""
    c = table(spark, sf_dir, "conversations")
    first = c.groupBy("conv_id").agg(F.min_by(F.struct("role", "text"), "turn").alias("x"), F.count("*").alias("turns"))
    return first.select("conv_id", "x.role", F.length("x.text").cast("bigint").alias("n_chars"), "turns")


LATERAL = "SELECT conv_id, arg_min(role, turn) AS role, length(arg_min(text, turn)) AS n_chars, count(*) AS turns FROM conversations GROUP BY 1"


def _boxes(df, key, x, y, prefix):
    x0, y0 = (F.col(x) % 100).cast("double"), (F.col(y) * 7 % 100).cast("double")
    return df.select(F.col(key).alias(f"{prefix}key"), x0.alias(f"{prefix}x0"), y0.alias(f"{prefix}y0"), (x0 + 4).alias(f"{prefix}x1"), (y0 + 3).alias(f"{prefix}y1"))


def theta_bbox_join(spark, sf_dir):
    """suppliers' boxes against regions' boxes on grid cells, with the shared share."""
    s = _boxes(table(spark, sf_dir, "supplier"), "s_suppkey", "s_suppkey", "s_nationkey", "s")
    n = _boxes(table(spark, sf_dir, "customer"), "c_custkey", "c_custkey", "c_nationkey", "n")
    a, b = tuple(f"s{c}" for c in ("x0", "y0", "x1", "y1")), tuple(f"n{c}" for c in ("x0", "y0", "x1", "y1"))
    # many share a box: boxes meet once, then their rows
    met = joins.box_join(s.select(*a).distinct(), n.select(*b).distinct(), a, b, 8.0)
    met = met.select(*a, *b, F.round(joins.overlap_area(a, b) / 12.0 * 100, 2).alias("overlap_pct"))
    return joins.expand(met, s, n, [*a], [*b]).select("skey", "nkey", "overlap_pct")


BBOX = """WITH s AS (SELECT s_suppkey AS skey, CAST(s_suppkey % 100 AS DOUBLE) AS sx, CAST(s_nationkey * 7 % 100 AS DOUBLE) AS sy FROM supplier),
n AS (SELECT c_custkey AS nkey, CAST(c_custkey % 100 AS DOUBLE) AS nx, CAST(c_nationkey * 7 % 100 AS DOUBLE) AS ny FROM customer)
SELECT skey, nkey, round((least(sx, nx) + 4 - greatest(sx, nx)) * (least(sy, ny) + 3 - greatest(sy, ny)) / 12.0 * 100, 2) AS overlap_pct
FROM s JOIN n ON abs(sx - nx) <= 4 AND abs(sy - ny) <= 3"""


def keyword_longest_match(spark, sf_dir):
    """The longest keyword in a part's type, from a fixed list."""
    words = ["STEEL", "STANDARD", "BRASS", "COPPER", "LARGE", "TIN", "ECONOMY", "NICKEL"]
    found = F.filter(F.array(*[F.lit(w) for w in sorted(words, key=lambda w: (-len(w), w))]), lambda w: F.col("p_type").contains(w))
    return table(spark, sf_dir, "part").select("p_partkey", F.try_element_at(found, F.lit(1)).alias("keyword"))


KEYWORD = """WITH k AS (SELECT unnest(['STEEL','STANDARD','BRASS','COPPER','LARGE','TIN','ECONOMY','NICKEL']) AS w)
SELECT p_partkey, (SELECT w FROM k WHERE contains(p_type, w) ORDER BY length(w) DESC, w LIMIT 1) AS keyword FROM part"""


def parent_price_inherit(spark, sf_dir):
    """A part's own price, or its brand's average where it has none."""
    p = table(spark, sf_dir, "part").withColumn("own", F.when(F.col("p_size") > 10, F.col("p_retailprice").cast("decimal(18,2)")))
    brand = p.groupBy("p_brand").agg(F.sum("own").alias("s"), F.count("own").alias("c"))
    return p.join(brand, "p_brand", "left").select("p_partkey", F.round(F.coalesce(F.col("own").cast("double"), F.col("s").cast("double") / F.col("c")), 4).alias("price"))


INHERIT = """WITH p AS (SELECT *, CASE WHEN p_size > 10 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS own FROM part),
b AS (SELECT p_brand, sum(own) AS s, count(own) AS c FROM p GROUP BY 1)
SELECT p_partkey, round(coalesce(CAST(own AS DOUBLE), CAST(s AS DOUBLE) / c), 4) AS price FROM p LEFT JOIN b USING (p_brand)"""


def tolerance_join(spark, sf_dir):
    """Parts of one brand whose prices differ by one at most, counted by part."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    a = p.select("p_brand", F.col("p_partkey").alias("a"), (F.col("p_retailprice") - 1).alias("low"), (F.col("p_retailprice") + 1).alias("high"))
    b = p.select("p_brand", F.col("p_partkey").alias("b"), F.col("p_retailprice").alias("at"), F.col("p_retailprice").alias("to"))
    return joins.interval_join(a, b, "low", "high", "at", "to", 4.0, ["p_brand"]).where("a <> b").groupBy(F.col("a").alias("p_partkey")).agg(F.count("*").alias("near"))


TOLERANCE = """SELECT a.p_partkey, count(*) AS near FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey AND b.p_retailprice BETWEEN a.p_retailprice - 1 AND a.p_retailprice + 1 GROUP BY 1"""


def triples_fold(spark, sf_dir):
    """suppliers' attributes as triples, folded to one row a subject."""
    s = table(spark, sf_dir, "supplier")
    pairs = F.array(F.struct(F.lit("name").alias("p"), F.col("s_name").alias("o")), F.struct(F.lit("nation").alias("p"), F.col("s_nationkey").cast("string").alias("o")), F.struct(F.lit("name").alias("p"), F.lower("s_name").alias("o")))
    triples = s.select(F.col("s_suppkey").alias("s"), F.explode(pairs).alias("x")).select("s", "x.*").distinct()
    return shape.fold_triples(triples).select("s", F.array_join("attributes.name", "|").alias("names"), F.array_join("attributes.nation", "|").alias("nations"))


TRIPLES = """SELECT s_suppkey AS s, array_to_string(list_sort([s_name, lower(s_name)]), '|') AS names, s_nationkey::VARCHAR AS nations FROM supplier"""


def majority_vote(spark, sf_dir):
    """The most frequent type a brand, ties to the first part."""
    return shape.majority(table(spark, sf_dir, "part"), ["p_brand"], "p_type", F.col("p_partkey"))


MAJORITY = """WITH c AS (SELECT p_brand, p_type, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY 1, 2)
SELECT p_brand, p_type, n FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, f, p_type) = 1"""


def unpivot_pairs(spark, sf_dir):
    """Value and companion columns as rows."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.max("l_quantity").alias("q"), F.max("l_tax").alias("qt"), F.max("l_discount").alias("d"), F.min("l_tax").alias("dt"))
    return shape.unpivot_pairs(lines, ["l_returnflag"], {"quantity": ("q", "qt"), "discount": ("d", "dt")})


UNPIVOT = """WITH l AS (SELECT l_returnflag, max(l_quantity) AS q, max(l_tax) AS qt, max(l_discount) AS d, min(l_tax) AS dt FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'quantity' AS name, q AS value, qt AS companion FROM l UNION ALL SELECT l_returnflag, 'discount', d, dt FROM l"""


def pivot_language(spark, sf_dir):
    """Documents a source, a column for each language."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(*[F.count_if(F.col("lang") == x).alias(f"n_{x}") for x in ("en", "de", "fr", "es")])


PIVOT = "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS n_{x}" for x in ("en", "de", "fr", "es")) + " FROM documents GROUP BY 1"


def explode_ordinality(spark, sf_dir):
    """Words of part names; the first is the head."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word"))
    return p.select("p_partkey", (F.col("at") + 1).cast("bigint").alias("place"), "word", (F.col("at") == 0).alias("is_head"))


EXPLODE = "SELECT p_partkey, place, word, place = 1 AS is_head FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS place FROM part)"


def forward_fill(spark, sf_dir):
    """The last sign-up's or purchase's value carried on; a purchase below 50 resets it."""
    e = table(spark, sf_dir, "events")
    filled = shape.forward_fill(e, ["user_id"], ["ts", "event_id"], F.col("event_type").isin("signup", "purchase"), F.when((F.col("event_type") == "signup") | (F.col("value") >= 50), F.col("value")), "carried")
    return filled.select("event_id", "carried")


FILL = """WITH e AS (SELECT *, count(*) FILTER (event_type IN ('signup', 'purchase')) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT event_id, first_value(CASE WHEN event_type = 'signup' OR (event_type = 'purchase' AND value >= 50) THEN value END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS carried FROM e"""


def multi_pass_dedup(spark, sf_dir):
    """Three passes of first-wins dedup over parts, then bounds by brand."""
    from sparkloom.operators.keyed import keep_one

    p = table(spark, sf_dir, "part").withColumn("cell", F.floor(F.col("p_retailprice") / 10))
    p = keep_one(p, ["cell", "p_brand"], [F.asc("p_partkey")])
    p = keep_one(p, ["p_type", "p_size"], [F.asc("p_partkey")])
    rank = F.when(F.col("p_type").contains("STEEL"), 0).when(F.col("p_type").contains("TIN"), 1).otherwise(2)
    p = keep_one(p, ["p_name"], [rank.asc(), F.asc("p_partkey")])
    return p.groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))


MULTI = """WITH a AS (SELECT *, floor(p_retailprice / 10) AS cell FROM part QUALIFY row_number() OVER (PARTITION BY floor(p_retailprice / 10), p_brand ORDER BY p_partkey) = 1),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY p_type, p_size ORDER BY p_partkey) = 1),
c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY CASE WHEN contains(p_type, 'STEEL') THEN 0 WHEN contains(p_type, 'TIN') THEN 1 ELSE 2 END, p_partkey) = 1)
SELECT p_brand, count(*) AS n, min(p_retailprice) AS low, max(p_retailprice) AS high FROM c GROUP BY 1"""


def densest_bucket(spark, sf_dir):
    """Price buckets of a brand with four parts or more, the fullest, ties to the right, and if it dominates."""
    p = table(spark, sf_dir, "part").groupBy("p_brand", (F.floor(F.col("p_retailprice") / 50) * 50).cast("bigint").alias("cell")).agg(F.count("*").alias("n"))
    total = p.withColumn("total", F.sum("n").over(Window.partitionBy("p_brand"))).where("n >= 4")
    best = total.groupBy("p_brand").agg(F.max(F.struct("n", "cell")).alias("x"), F.max("total").alias("total"))
    return best.select("p_brand", "x.cell", "x.n", (F.col("x.n") >= F.greatest(F.lit(3), F.col("total") * 0.6)).alias("dominant"))


DENSEST = """WITH p AS (SELECT p_brand, CAST(floor(p_retailprice / 50) * 50 AS BIGINT) AS cell, count(*) AS n FROM part GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY p_brand) AS total FROM p)
SELECT p_brand, cell, n, n >= greatest(3, total * 0.6) AS dominant FROM t WHERE n >= 4 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, cell DESC) = 1"""


def topn_priority(spark, sf_dir):
    """The 50 orders that come first by priority rank, price and key."""
    rank = F.when(F.col("o_orderpriority").startswith("1"), 0).when(F.col("o_orderpriority").startswith("2"), 1).otherwise(2)
    return table(spark, sf_dir, "orders").orderBy(rank, F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_orderpriority")


TOPN = "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE WHEN o_orderpriority LIKE '1%' THEN 0 WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 2 END, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50"


def per_group_cap(spark, sf_dir):
    """Three newest orders a customer."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("place", F.row_number().over(w)).where("place <= 3").select("o_custkey", "o_orderkey", "place")


CAP = "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INT) AS place FROM orders QUALIFY place <= 3"


def union_pending(spark, sf_dir):
    """Three kinds of texts in one list of what is pending."""
    d = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.length("text").cast("bigint").alias("n_chars"), "lang")
    p = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.length("html").cast("bigint").alias("n_chars"))
    c = table(spark, sf_dir, "conversations").where("turn = 0").select(F.lit("conversation").alias("kind"), F.col("conv_id").alias("id"), F.length("text").cast("bigint").alias("n_chars"))
    return d.unionByName(p, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


UNION_PENDING = """SELECT 'document' AS kind, doc_id AS id, length(text) AS n_chars, lang FROM documents UNION ALL SELECT 'page', page_id, length(html), NULL FROM pages UNION ALL SELECT 'conversation', conv_id, length(text), NULL FROM conversations WHERE turn = 0"""


def set_operations(spark, sf_dir):
    """Users by which of two sets hold them."""
    e = table(spark, sf_dir, "events")
    a, b = (e.where(F.col("event_type") == t).select("user_id").distinct() for t in ("purchase", "signup"))
    label = lambda df, x: df.withColumn("part", F.lit(x))
    return label(a.intersect(b), "both").union(label(a.subtract(b), "purchase")).union(label(b.subtract(a), "signup"))


SETS = """WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.user_id IS NULL THEN 'signup' WHEN b.user_id IS NULL THEN 'purchase' ELSE 'both' END AS part FROM a FULL JOIN b ON a.user_id = b.user_id"""


def hierarchy_levels(spark, sf_dir):
    """Regions, nations and customers as one table of levels."""
    r = table(spark, sf_dir, "region").select(F.lit(1).alias("level"), F.col("r_regionkey").cast("bigint").alias("key"), F.lit(-1).cast("bigint").alias("parent"))
    n = table(spark, sf_dir, "nation").select(F.lit(2).alias("level"), F.col("n_nationkey").cast("bigint").alias("key"), F.col("n_regionkey").cast("bigint").alias("parent"))
    c = table(spark, sf_dir, "customer").select(F.lit(3).alias("level"), F.col("c_custkey").alias("key"), F.col("c_nationkey").cast("bigint").alias("parent"))
    return r.union(n).union(c)


LEVELS = """SELECT 1 AS level, CAST(r_regionkey AS BIGINT) AS key, CAST(-1 AS BIGINT) AS parent FROM region UNION ALL SELECT 2, n_nationkey, n_regionkey FROM nation UNION ALL SELECT 3, c_custkey, c_nationkey FROM customer"""


def gold_market_monthly(spark, sf_dir):
    """Ours, where a gold stub has no body: monthly orders by nation with count, mean and median."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "n_name").agg(
        F.count("*").alias("n"), F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("mean"), F.floor(F.median("o_totalprice")).alias("median")
    )


GOLD = """SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name, count(*) AS n, CAST(floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)) AS BIGINT) AS mean, CAST(floor(median(o_totalprice)) AS BIGINT) AS median
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"""

QUERIES = {
    "anti_join_no_children": (anti_join_no_children, ANTI),
    "semi_join_resample": (semi_join_resample, SEMI),
    "null_safe_join": (null_safe_join, NULL_SAFE),
    "name_bridge_join": (name_bridge_join, NAME_BRIDGE),
    "cascading_lookup": (cascading_lookup, CASCADE),
    "lateral_first_child": (lateral_first_child, LATERAL),
    "theta_bbox_join": (theta_bbox_join, BBOX),
    "keyword_longest_match": (keyword_longest_match, KEYWORD),
    "parent_price_inherit": (parent_price_inherit, INHERIT),
    "tolerance_join": (tolerance_join, TOLERANCE),
    "triples_fold": (triples_fold, TRIPLES),
    "majority_vote": (majority_vote, MAJORITY),
    "unpivot_pairs": (unpivot_pairs, UNPIVOT),
    "pivot_language": (pivot_language, PIVOT),
    "explode_ordinality": (explode_ordinality, EXPLODE),
    "forward_fill": (forward_fill, FILL),
    "multi_pass_dedup": (multi_pass_dedup, MULTI),
    "densest_bucket": (densest_bucket, DENSEST),
    "topn_priority": (topn_priority, TOPN),
    "per_group_cap": (per_group_cap, CAP),
    "union_pending": (union_pending, UNION_PENDING),
    "set_operations": (set_operations, SETS),
    "hierarchy_levels": (hierarchy_levels, LEVELS),
    "gold_market_monthly": (gold_market_monthly, GOLD),
}
