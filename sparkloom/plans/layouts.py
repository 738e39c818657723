"""JSON in pages, positional lines, sheets as grids, labels beside marks and name lookups over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions import records
from sparkloom.operators import joins, layout, spatial
from sparkloom.session import table


def embedded_json(spark, sf_dir):
    """An event's state object out of a page's script, and a number of its linked-data block."""
    state = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.lit(', "note": "a } in \\"text\\""}'))
    html = F.concat(F.lit("<html><script>window.__STATE__ = "), state, F.lit('; other = {};</script><script type="application/ld+json">'), "props", F.lit("</script></html>"))
    pages = table(spark, sf_dir, "events").select("event_id", html.alias("html"))
    linked = F.regexp_extract("html", r'(?s)<script type="application/ld\+json">(.*?)</script>', 1)
    return pages.select("event_id", F.md5(records.balanced_json(F.col("html"), "window.__STATE__ =")).alias("state"), F.try_variant_get(F.try_parse_json(linked), "$.k", "bigint").alias("k"))


EMBEDDED = r"""SELECT event_id, md5('{"id": ' || event_id || ', "props": ' || props || ', "note": "a } in \"text\""}') AS state, (props->>'$.k')::BIGINT AS k FROM events"""


def positional_lines(spark, sf_dir):
    """A document's lines by place: commune, locality unless it looks like an address, address; applicant, matter, references."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    d = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).withColumn("n", F.size("lines"))
    second = F.try_element_at("lines", F.lit(2))
    locality = F.when(~second.rlike("[0-9]"), second)
    rest = F.when(F.col("n") > 1, F.slice("lines", F.when(locality.isNull(), 2).otherwise(3), F.col("n")))
    middle = F.when(F.col("n") > 2, F.array_join(F.slice("lines", F.lit(2), F.col("n") - 2), " "))
    parts = {"commune": F.try_element_at("lines", F.lit(1)), "locality": locality, "address": F.array_join(rest, ", "), "matter": F.regexp_replace(middle, r"[.;,]+\z", ""), "refs": F.when(F.col("n") > 1, F.try_element_at("lines", F.lit(-1)))}
    return d.select("doc_id", F.col("n").cast("bigint").alias("n_lines"), *[F.md5(F.coalesce(c, F.lit("~"))).alias(name) for name, c in parts.items()])


LINES = r"""WITH d AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM documents),
p AS (SELECT *, len(l) AS n, CASE WHEN NOT regexp_matches(l[2], '[0-9]') THEN l[2] END AS loc FROM d)
SELECT doc_id, n AS n_lines, md5(coalesce(l[1], '~')) AS commune, md5(coalesce(loc, '~')) AS locality,
md5(coalesce(CASE WHEN n > 1 THEN array_to_string(l[CASE WHEN loc IS NULL THEN 2 ELSE 3 END:], ', ') END, '~')) AS address,
md5(coalesce(CASE WHEN n > 2 THEN regexp_replace(array_to_string(l[2:n - 1], ' '), '[.;,]+\z', '') END, '~')) AS matter,
md5(coalesce(CASE WHEN n > 1 THEN l[n] END, '~')) AS refs FROM p"""


def sheet_rows(spark, sf_dir):
    """Customers laid out as one sheet a nation, with title rows and headers in varying places, read back as rows."""
    c = table(spark, sf_dir, "customer").withColumn("n", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    header = F.col("c_nationkey") % 3 + 1
    named = F.col("c_nationkey") % 4 != 3
    cell = lambda row, col, value: F.struct(row.cast("int").alias("row"), F.lit(col).alias("col"), value.alias("value"))
    body = [cell(header + F.col("n"), i, F.col(v).cast("string")) for i, v in enumerate(("c_name", "c_mktsegment", "c_custkey"))]
    top = [cell(header, i, F.when(named, a).otherwise(b)) for i, (a, b) in enumerate((("name", "Nom"), ("segment", "Branche"), ("key", "Numéro")))]
    title = cell(F.lit(0), 0, F.lit("Report"))
    first = F.when(F.col("n") == 1, F.array(title, *top, *body)).otherwise(F.array(*body))
    cells = c.select(F.col("c_nationkey").alias("sheet"), F.explode(first).alias("cell")).select("sheet", "cell.*")
    rows = layout.grid_rows(cells, "sheet", "row", "col", "value", "name")
    field = lambda *keys: F.coalesce(*[F.try_element_at("fields", F.lit(k)) for k in keys])
    return rows.select("sheet", (F.col("row") - F.col("head")).cast("bigint").alias("n"), field("name", "Nom").alias("name"), field("segment", "Branche").alias("segment"), field("key", "Numéro").cast("bigint").alias("key"))


SHEETS = """SELECT c_nationkey AS sheet, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n, c_name AS name, c_mktsegment AS segment, c_custkey AS key FROM customer"""


def legend_labels(spark, sf_dir):
    """An order's even lines as marks on a page, its odd ones as labels; pages of more than three labels are no legends."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((F.min("l_partkey") % 50).alias("x"), (F.min("l_suppkey") % 40).alias("y"))
    lines = lines.withColumnRenamed("l_linenumber", "id")
    labels = lines.where("id % 2 = 1").withColumn("text", F.concat(F.lit("L"), F.col("id").cast("string")))
    return layout.nearest_labels(lines.where("id % 2 = 0"), labels, "l_orderkey", reach=25, aside=20, most=3).select("l_orderkey", F.col("id").alias("mark"), "score", "label")


LEGEND = """WITH p AS (SELECT l_orderkey, l_linenumber AS id, min(l_partkey) % 50 AS x, min(l_suppkey) % 40 AS y FROM lineitem GROUP BY ALL),
t AS (SELECT * FROM p WHERE id % 2 = 1 QUALIFY count(*) OVER (PARTITION BY l_orderkey) <= 3),
b AS (SELECT m.l_orderkey, m.id, t.id AS tid, t.x, t.y, t.x - m.x + 2 * abs(t.y - m.y) AS score FROM p m LEFT JOIN t ON t.l_orderkey = m.l_orderkey AND t.x >= m.x AND abs(t.y - m.y) <= 25 WHERE m.id % 2 = 0
QUALIFY row_number() OVER (PARTITION BY m.l_orderkey, m.id ORDER BY score, t.id) = 1),
u AS (SELECT b.l_orderkey, b.id, t.id AS below, row_number() OVER (PARTITION BY b.l_orderkey, b.id ORDER BY t.y, t.id) AS r FROM b JOIN t ON t.l_orderkey = b.l_orderkey AND t.y > b.y AND abs(t.x - b.x) <= 20),
s AS (SELECT l_orderkey, id, string_agg(' L' || below, '' ORDER BY r) AS more FROM u WHERE r <= 2 GROUP BY ALL)
SELECT b.l_orderkey, b.id AS mark, b.score, 'L' || b.tid || coalesce(s.more, '') AS label FROM b LEFT JOIN s USING (l_orderkey, id)"""


def near_clusters(spark, sf_dir):
    """Customers as points, linked where they are at most 4 apart; each one's cluster by its smallest key."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * F.col("c_custkey") % 97).cast("double").alias("x"), F.floor(F.col("c_custkey") / 2).cast("double").alias("y"))
    box = lambda p: c.select(F.col("id").alias(f"{p}id"), *[(F.col(v) + d).alias(f"{p}{v}{i}") for v in "xy" for i, d in enumerate((-2, 2))])
    sides = [tuple(f"{p}{k}" for k in ("x0", "y0", "x1", "y1")) for p in "ab"]
    near = joins.box_join(box("a"), box("b"), *sides, size=8.0).where("aid < bid AND pow(ax0 - bx0, 2) + pow(ay0 - by0, 2) <= 16")
    labels = spatial.clusters(near, "aid", "bid").withColumnRenamed("u", "id")
    return c.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


NEAR = """WITH RECURSIVE c AS (SELECT c_custkey AS id, c_custkey * c_custkey % 97 AS x, c_custkey // 2 AS y FROM customer),
e AS (SELECT a.id AS u, b.id AS v FROM c a JOIN c b ON b.id BETWEEN a.id - 20 AND a.id + 20 AND a.id <> b.id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 16),
r AS (SELECT id AS u, id AS v FROM c UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT u AS id, min(v) AS label FROM r GROUP BY u"""


def swiss_customers(spark, sf_dir):
    """Customers whose composed address, or second place, lies in the country, by nations of a list."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    place = F.when(k % 6 == 0, F.concat(F.lit("CH-"), (k % 9000 + 900).cast("string"))).when(k % 6 == 1, "Genève").when(k % 6 == 2, "Romont (FR)").when(k % 6 == 3, "Lyon")
    composed = F.concat_ws(", ", place, "n_name")
    second = F.when(k % 10 == 3, "Aigle, Suisse")
    found = records.swiss_place(composed) | records.swiss_place(second)
    return c.where("c_nationkey IN (1, 3, 5, 7, 9, 11) AND c_acctbal >= 0 AND c_name IS NOT NULL").select("c_custkey", composed.alias("address"), found.alias("swiss"))


SWISS = """SELECT c_custkey, concat_ws(', ', CASE c_custkey % 6 WHEN 0 THEN 'CH-' || (c_custkey % 9000 + 900) WHEN 1 THEN 'Genève' WHEN 2 THEN 'Romont (FR)' WHEN 3 THEN 'Lyon' END, n_name) AS address,
CASE c_custkey % 6 WHEN 0 THEN c_custkey % 9000 + 900 BETWEEN 1000 AND 9658 WHEN 1 THEN true WHEN 2 THEN true ELSE false END OR c_custkey % 10 = 3 AS swiss
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey IN (1, 3, 5, 7, 9, 11) AND c_acctbal >= 0 AND c_name IS NOT NULL"""


def mapped_records(spark, sf_dir):
    """Orders as nested records: keys as snake case at all levels, aliases in order, a composite id where none is known; rows without a key go."""
    o = table(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL")  # here, as a filter on what is read from the text would read it again
    k = F.col("o_orderkey")
    ref = F.when(k % 3 == 0, "unknown").otherwise(F.concat(F.lit("R"), k.cast("string")))
    raw = F.format_string('{"orderKey": %d, "shipInfo": {"shipMode": "aB: cD", "placeName": "x"}, "dealRef": "%s"}', k, ref)
    shape = "order_key bigint, reference string, deal_ref string, ship_info struct<ship_mode: string, place_name: string>"
    tidy = o.select("o_orderkey", "o_custkey", "o_orderpriority", records.snake_keys(raw).alias("json"))
    read = tidy.withColumn("r", F.from_json("json", shape))
    real = records.known(F.coalesce("r.reference", "r.deal_ref"), "unknown", "-")
    made = F.concat_ws("-", F.col("o_custkey").cast("string"), F.col("r.order_key").cast("string"))
    place = F.concat_ws(", ", "r.ship_info.place_name", "r.ship_info.ship_mode", "o_orderpriority")
    return read.select("o_orderkey", F.coalesce(real, made).alias("id"), place.alias("place"), F.md5("json").alias("digest"))

MAPPED = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE 'R' || o_orderkey END AS ref FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey || '-' || o_orderkey ELSE ref END AS id, 'x, aB: cD, ' || o_orderpriority AS place,
md5('{"order_key": ' || o_orderkey || ', "ship_info": {"ship_mode": "aB: cD", "place_name": "x"}, "deal_ref": "' || ref || '"}') AS digest FROM o"""


QUERIES = {
    "embedded_json": (embedded_json, EMBEDDED),
    "positional_lines": (positional_lines, LINES),
    "sheet_rows": (sheet_rows, SHEETS),
    "legend_labels": (legend_labels, LEGEND),
    "near_clusters": (near_clusters, NEAR),
    "swiss_customers": (swiss_customers, SWISS),
    "mapped_records": (mapped_records, MAPPED),
}
