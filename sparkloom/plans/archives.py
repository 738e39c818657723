"""Archives and workbooks, nested records and fields in running text, over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import extraction, fits, layout, tables
from sparkloom.operators.mapping import Constant, Either, Joined, Json, Many, Record, Text, Value, map_records
from sparkloom.session import shared_folder, table
from sparkloom.sources import archives


def zipped_tables(spark, sf_dir):
    """documents' first lines in ZIP archives of CSV files with a byte order mark, quotes, separators and line breaks in cells, and three wanted columns read back by name."""
    archives.register(spark)
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").alias("Doc Id"), F.concat(F.lit(" "), F.substring("text", 1, 120), F.lit('; "x"\n ')).alias("textStart"), F.col("lang").alias("lang "), F.when(F.col("n_chars") % 2 == 0, F.col("source")).alias("SourceName"))
    path = shared_folder(spark, "zipped")
    rows.repartition(4).write.format("zipped_csv").mode("append").option("sep", ";").save(path)
    read = spark.read.format("zipped_csv").option("columns", "doc_id,text_start,source_name").load(path)
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text_start").alias("digest"), F.length("text_start").alias("n"), "source_name")


ZIPPED = r"""SELECT doc_id, md5(t) AS digest, length(t) AS n, CASE WHEN n_chars % 2 = 0 THEN source END AS source_name
FROM (SELECT *, regexp_replace(left(text, 120) || '; "x"', '^\s+', '') AS t FROM documents)"""


def workbook_rows(spark, sf_dir):
    """Suppliers in workbooks of one sheet, with title lines above a header that is found by a label; cells back as rows."""
    archives.register(spark)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name & title"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_acctbal")).alias("balance"))
    path = shared_folder(spark, "workbooks")
    s.repartition(3).write.format("xlsx_cells").mode("append").option("title", "Suppliers <all>\n2026").save(path)
    cells = spark.read.format("xlsx_cells").load(path)
    rows = layout.grid_rows(cells, "file", "row", "col", "value", "name & title")
    field = lambda name: F.try_element_at("fields", F.lit(name))
    return rows.select(field("key").cast("bigint").alias("key"), field("name & title").alias("name"), field("balance").cast("double").alias("balance"), F.col("head").cast("bigint").alias("head"))


WORKBOOK = "SELECT s_suppkey AS key, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS balance, 3::BIGINT AS head FROM supplier"

#: Orders as listings: prices under several paths, titles by language, places, pictures and an agent.
LISTING = {
    "id": Value(("id", "$.listing.id", "Ref No.")),
    "price": Value(("$.card.price", "$.listing.prices.buy.value", "$.listing.prices.rent.value"), "double"),
    "title": Text(("$.listing.title", "$.title"), ("fr", "en")),
    "address": Record({"street": Value(("street",)), "city": Value(("locality", "city"), default="?")}, "$.listing.address"),
    "images": Many(("$.listing.images", "$.images"), Record({"url": Value(("url", "$.links.large")), "n": Value(("n",), "int")})),
    "tags": Many(("$.listing.tags",), Value(("$",))),
    "agent": Json(Many(("agents",), Record({"name": Joined((Value(("first",)), Value(("last",))), " "), "phone": Value(("phone", "mobile"))}))),
    "deadline": Either((Value(("$.dates.until",)), Joined((Value(("$.dates.days",)), Constant("days")), " "))),
    "country": Constant("CH"),
}


def listing_records(spark, sf_dir):
    """Orders as nested listings of several shapes, mapped to one table; those without an id go."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_linestatus").alias("tag")))).alias("lines"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k, text = F.col("o_orderkey"), lambda x: F.col(x).cast("string")
    only = lambda test, value: F.when(test, value)
    picture = lambda x: F.struct(only(x["part"] % 3 == 0, F.concat(F.lit("p/"), x["part"].cast("string"))).alias("url"), F.struct(only(x["part"] % 3 == 1, F.concat(F.lit("l/"), x["part"].cast("string"))).alias("large")).alias("links"), only(x["part"] % 3 != 2, x["n"]).alias("n"))
    agent = F.struct(only(k % 5 < 3, text("c_mktsegment")).alias("first"), only(k % 5 != 1, text("c_name")).alias("last"), only(k % 2 == 0, F.lit(" ")).alias("phone"), only(k % 3 == 0, text("c_custkey")).alias("mobile"))
    listing = F.struct(
        only(k % 4 == 1, text("o_orderkey")).alias("id"),
        F.struct(F.struct(only(k % 3 == 1, F.col("o_totalprice")).alias("value")).alias("buy"), F.struct(only(k % 3 == 2, text("o_totalprice")).alias("value")).alias("rent")).alias("prices"),
        F.struct(only(k % 4 == 0, text("o_orderpriority")).alias("fr"), only(k % 3 == 0, F.lit("")).alias("en"), only(k % 2 == 0, text("o_orderstatus")).alias("rm")).alias("title"),
        F.struct(only(k % 6 == 0, text("c_name")).alias("street"), only(k % 6 == 1, text("c_mktsegment")).alias("city")).alias("address"),
        only(k % 2 == 0, F.transform("lines", picture)).alias("images"), F.transform("lines", lambda x: F.when(x["n"] % 2 == 0, x["tag"]).otherwise("")).alias("tags"),
    )
    dates = F.struct(only(k % 8 == 3, F.lit("2026-01-31")).alias("until"), only(k % 8 > 3, F.col("o_custkey")).alias("days"))
    whole = F.to_json(F.struct(
        only(k % 4 == 0, k).alias("id"), listing.alias("listing"), only(k % 4 == 2, F.concat(F.lit("R-"), text("o_orderkey"))).alias("Ref No."), only(k % 5 == 1, F.lit("plain")).alias("title"),
        only(k % 2 == 1, F.transform("lines", picture)).alias("images"), F.array(agent).alias("agents"), dates.alias("dates"),
    ))
    mapped = map_records(joined.select("o_orderkey", whole.alias("json")), "json", LISTING, keep=("o_orderkey",), required=("id",))
    urls = F.array_join(F.transform("images", lambda x: F.concat_ws("#", x["url"], x["n"].cast("string"))), "|")
    return mapped.select("o_orderkey", "id", "price", "title", F.concat_ws("/", "address.street", "address.city").alias("address"), urls.alias("images"), F.array_join("tags", "").alias("tags"), "agent", "deadline", "country")


LISTINGS = """WITH l AS (SELECT l_orderkey, string_agg(CASE l_partkey % 3 WHEN 0 THEN 'p/' || l_partkey || '#' || l_linenumber WHEN 1 THEN 'l/' || l_partkey || '#' || l_linenumber END, '|' ORDER BY l_linenumber, l_partkey, l_linestatus) AS images,
string_agg(CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END, '' ORDER BY l_linenumber, l_partkey, l_linestatus) AS tags FROM lineitem GROUP BY 1),
o AS (SELECT *, o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey WHERE o_orderkey % 4 <> 3)
SELECT o_orderkey, CASE k % 4 WHEN 2 THEN 'R-' || k ELSE k::VARCHAR END AS id, CASE WHEN k % 3 > 0 THEN o_totalprice END AS price,
CASE WHEN k % 4 = 0 THEN o_orderpriority WHEN k % 2 = 0 THEN o_orderstatus WHEN k % 5 = 1 THEN 'plain' END AS title,
CASE k % 6 WHEN 0 THEN c_name || '/?' WHEN 1 THEN c_mktsegment ELSE '?' END AS address, images, tags,
'[{"name":"' || concat_ws(' ', CASE WHEN k % 5 < 3 THEN c_mktsegment END, CASE WHEN k % 5 <> 1 THEN c_name END) || '"' || CASE WHEN k % 3 = 0 THEN ',"phone":"' || c_custkey || '"' ELSE '' END || '}]' AS agent,
CASE WHEN k % 8 = 3 THEN '2026-01-31' WHEN k % 8 > 3 THEN o_custkey || ' days' ELSE 'days' END AS deadline, 'CH' AS country FROM o"""

#: What documents hold: keys, network addresses, long numbers and shouted words; a number inside a key or an address is part of that.
MARKS = (
    extraction.Rule("key", r'token = "(?P<value>[0-9a-f]{40})"', 0, exact=True),
    extraction.Rule("host", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b", 1),
    extraction.Rule("number", r"[0-9]{6,}", 2),
)


def text_fields(spark, sf_dir):
    """Keys, network addresses and long numbers of all documents in one pass, overlaps settled by priority, with the place of the first."""
    found = extraction.extract(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", MARKS)
    x = F.col("found")
    count = lambda f: F.size(extraction.values(x, f)).cast("bigint")
    return found.select("doc_id", count("key").alias("n_keys"), count("host").alias("n_hosts"), F.array_join(extraction.values(x, "number"), ",").alias("numbers"), extraction.first(x, "host").alias("host"), (F.try_element_at(x, F.lit(1))["start"] + 1).cast("bigint").alias("place"))


FIELDS = r"""WITH d AS (SELECT doc_id, text, regexp_replace(text, 'token = "[0-9a-f]{40}"', repeat('~', 50), 'g') AS t FROM documents),
e AS (SELECT *, regexp_extract_all(t, '\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b') AS hosts, regexp_extract_all(regexp_replace(t, '\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b', '.', 'g'), '[0-9]{6,}') AS numbers FROM d)
SELECT doc_id, len(regexp_extract_all(text, 'token = "[0-9a-f]{40}"')) AS n_keys, len(hosts) AS n_hosts, array_to_string(numbers, ',') AS numbers, hosts[1] AS host,
nullif(least(CASE WHEN contains(t, repeat('~', 50)) THEN instr(t, repeat('~', 50)) ELSE 1e9 END, CASE WHEN len(hosts) > 0 THEN length(regexp_extract(t, '(?s)^(.*?)\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b', 1)) + 1 ELSE 1e9 END,
  CASE WHEN len(numbers) > 0 THEN length(regexp_extract(t, '(?s)^(.*?)[0-9]{6,}', 1)) + 1 ELSE 1e9 END), 1e9)::BIGINT AS place FROM e"""

def checked_orders(spark, sf_dir):
    """Orders loaded under four rules; what broke which rule, from the rows put apart, beside the counts of the writing pass."""
    o = table(spark, sf_dir, "orders").withColumn("note", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")))
    rules = {"dear": F.col("o_totalprice") < 400000, "open": ~((F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 10 == 0)), "noted": F.col("note") != "1-URGENT", "keyed": F.col("o_orderkey").isNotNull()}
    report, passed, failed = tables.checked_load(o, rules, shared_folder(spark, "checked"))
    counted = F.create_map(*[x for name in ("rows", "loaded", *rules) for x in (F.lit(name), F.lit(report[name]))])
    each = failed.select(F.explode("violations").alias("rule"), "o_orderkey").union(passed.select(F.lit("loaded"), "o_orderkey"))
    return each.groupBy("rule").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select("rule", "n", "keys", counted[F.col("rule")].alias("counted"), F.lit(report["rows"]).alias("rows"))


CHECKED = """WITH o AS (SELECT o_orderkey AS k, o_totalprice >= 400000 AS dear, o_orderstatus = 'O' AND o_custkey % 10 = 0 AS open, o_orderkey % 5 > 0 AND o_orderpriority = '1-URGENT' AS noted FROM orders),
e AS (SELECT k, unnest(CASE WHEN dear OR open OR noted THEN list_filter([CASE WHEN dear THEN 'dear' END, CASE WHEN open THEN 'open' END, CASE WHEN noted THEN 'noted' END], lambda x: x IS NOT NULL) ELSE ['loaded'] END) AS rule FROM o)
SELECT rule, count(*) AS n, sum(k)::BIGINT AS keys, count(*) AS counted, (SELECT count(*) FROM orders) AS rows FROM e GROUP BY rule"""


def merged_versions(spark, sf_dir):
    """Customers of a table on storage after two merges, the second for one nation's, with each row's version."""
    c = table(spark, sf_dir, "customer").select(F.nullif("c_custkey", F.lit(0)).alias("key"), F.col("c_acctbal").alias("balance"), "c_nationkey")
    stored = tables.ManifestTable(spark, shared_folder(spark, "merged"), ["key"], buckets=16)
    stored.merge(c.withColumn("version", F.lit(1)), [F.desc("balance")])
    twice = c.where("c_nationkey = 3").withColumn("version", F.lit(2))
    stored.merge(twice.union(twice.withColumn("balance", F.col("balance") + 1)), [F.desc("balance")])
    return stored.read()


MERGED = """SELECT nullif(c_custkey, 0) AS key, c_acctbal + CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS balance, c_nationkey, CASE WHEN c_nationkey = 3 THEN 2 ELSE 1 END AS version FROM customer"""

def page_fits(spark, sf_dir):
    """Lines of a supplier as anchors (quantity to price, tax to discount plus date): scale, shift and confidence after two rounds without what lies far off."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), (F.col("l_linenumber") * 10.0 + F.col("l_tax") * 100).alias("y"), (F.col("l_extendedprice") / 100).alias("to_x"), (F.col("l_discount") * 100 + F.col("l_linenumber") * 7).alias("to_y"))
    found = fits.fit_pages(lines, "l_suppkey", rounds=2)
    return found.select("l_suppkey", "anchors", *[F.round(c, 3).alias(c) for c in ("sx", "tx", "sy", "ty", "confidence")])


ROUND = """f{n} AS (SELECT p, regr_slope(u, x) AS sx, regr_intercept(u, x) AS tx, regr_slope(v, y) AS sy, regr_intercept(v, y) AS ty FROM a{n} GROUP BY p),
r{n} AS (SELECT a.*, sqrt((sx * x + tx - u) ** 2 + (sy * y + ty - v) ** 2) AS d FROM a{n} a JOIN f{n} USING (p)),
a{m} AS (SELECT p, x, y, u, v FROM r{n} JOIN (SELECT p, median(d) * 3 + 1e-9 AS most FROM r{n} GROUP BY p) USING (p) WHERE d <= most)"""
FITS = f"""WITH a0 AS (SELECT l_suppkey AS p, l_quantity AS x, l_linenumber * 10.0::DOUBLE + l_tax * 100 AS y, l_extendedprice / 100 AS u, l_discount * 100 + l_linenumber * 7 AS v FROM lineitem),
{ROUND.format(n=0, m=1)},
{ROUND.format(n=1, m=2)},
g AS (SELECT p, count(*) AS anchors, regr_slope(u, x) AS sx, regr_intercept(u, x) AS tx, regr_slope(v, y) AS sy, regr_intercept(v, y) AS ty FROM a2 GROUP BY p)
SELECT p AS l_suppkey, anchors, round(sx, 3) AS sx, round(tx, 3) AS tx, round(sy, 3) AS sy, round(ty, 3) AS ty, round(0.85 + 0.15 * least(abs(sx), abs(sy)) / greatest(abs(sx), abs(sy)), 3) AS confidence FROM g WHERE sx <> 0 AND sy <> 0"""

QUERIES = {
    "zipped_tables": (zipped_tables, ZIPPED),
    "workbook_rows": (workbook_rows, WORKBOOK),
    "listing_records": (listing_records, LISTINGS),
    "text_fields": (text_fields, FIELDS),
    "checked_orders": (checked_orders, CHECKED),
    "merged_versions": (merged_versions, MERGED),
    "page_fits": (page_fits, FITS),
}
