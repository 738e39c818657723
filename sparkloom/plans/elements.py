"""Queries over map elements, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.operators import elements
from sparkloom.operators.spatial import ring_area
from sparkloom.session import table

ORDER = ["purchase", "error", "signup", "click", "view"]


def map_features(spark, sf_dir):
    """Users as elements whose tags are their event types: signed ids, place or centre, class by tag order, code by key and value or by key."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    tag = F.when(F.max("k") % 4 == 0, "").otherwise(F.concat(F.lit("k_"), F.max("k").cast("string")))
    users = e.groupBy("user_id", "event_type").agg(tag.alias("v"), F.min("value").alias("lon"), F.max("value").alias("lat"))
    users = users.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("tags"), F.min("lon").alias("lon"), F.max("lat").alias("lat"))
    kind = F.get(F.array(F.lit("node"), F.lit("way"), F.lit("relation")), (F.col("user_id") % 3).cast("int"))
    given = F.when(F.col("user_id") % 7 != 0, F.struct("lat", "lon"))  # others lack a place
    node = kind == "node"
    users = users.select(kind.alias("type"), F.col("user_id").alias("id"), *[F.when(node, given[a]).alias(a) for a in ("lat", "lon")], F.when(~node, given).alias("center"), "tags")
    size = F.col("p_size")
    codes = table(spark, sf_dir, "part").groupBy(F.lit("purchase").alias("key"), F.concat(F.lit("k_"), (size + 48).cast("string")).alias("value")).agg(F.min("p_partkey").alias("code"), F.min("p_type").alias("description"))
    return elements.features(users, codes, ORDER, {"error": 1500})


FEATURES = """WITH t AS (SELECT user_id, event_type, max(CAST(props->>'$.k' AS INT)) AS k, min(value) AS lon, max(value) AS lat FROM events GROUP BY 1, 2),
u AS (SELECT user_id, arg_min(event_type, o) FILTER (k % 4 <> 0) AS key, arg_min(k, o) FILTER (k % 4 <> 0) AS k, min(lon) AS lon, max(lat) AS lat
FROM (SELECT *, list_position(['purchase', 'error', 'signup', 'click', 'view'], event_type) AS o FROM t) GROUP BY 1),
c AS (SELECT p_size + 48 AS k, min(p_partkey) AS code, min(p_type) AS description FROM part GROUP BY 1)
SELECT CAST(CASE WHEN user_id % 3 = 0 THEN user_id ELSE -user_id END AS VARCHAR) AS osm_id, CASE key WHEN 'purchase' THEN code WHEN 'error' THEN 1500 END AS code, 'k_' || u.k AS fclass,
CAST(NULL AS VARCHAR) AS name, CASE WHEN key = 'purchase' AND description IS NOT NULL THEN description ELSE 'K ' || u.k END AS description, lon, lat, '{"type":"Point","coordinates":[' || lon || ',' || lat || ']}' AS geometry
FROM u LEFT JOIN c ON c.k = u.k WHERE key IS NOT NULL AND user_id % 7 <> 0"""


def map_rings(spark, sf_dir):
    """Each customer's orders by date as a track of ways back to its first, in either direction, without the urgent ones: rings, loose chains, nodes and area."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    behind = F.coalesce(F.lead("o_orderkey").over(w), F.first("o_orderkey").over(w))
    nodes = F.array("o_orderkey", -1 - F.col("o_orderkey"), behind)
    tracks = o.select(F.col("o_custkey").alias("relation"), F.lit("outer").alias("role"), F.col("o_orderkey").alias("way"), F.when(F.col("o_orderkey") % 2 == 1, F.reverse(nodes)).otherwise(nodes).alias("nodes"), "urgent")
    found = elements.rings(tracks.select("relation", "role", "way"), tracks.where("NOT urgent").select("way", "nodes"))
    k = F.col("o_orderkey")
    corner = lambda node, x, y: F.struct(node.alias("node"), x.cast("double").alias("x"), y.cast("double").alias("y"))
    places = o.select(F.inline(F.array(corner(k, k % 1000, k * 7 % 777), corner(-1 - k, k * 13 % 991, k * 29 % 887))))
    placed = elements.outlines(found, places)
    area = F.sum(F.when(F.col("closed"), F.abs(ring_area(F.col("points")))))
    return placed.groupBy("relation").agg(F.count_if("closed").alias("closed"), F.count_if(~F.col("closed")).alias("loose"), F.sum("ways").alias("ways"), F.sum(F.size("points")).alias("nodes"), area.alias("area"))


RINGS = """WITH o AS (SELECT o_custkey AS relation, o_orderkey AS k, o_orderpriority = '1-URGENT' AS urgent,
coalesce(lead(o_orderkey) OVER w, first_value(o_orderkey) OVER w) AS n, coalesce(lag(o_orderpriority) OVER w, last_value(o_orderpriority) OVER v) = '1-URGENT' AS was
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), v AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
s AS (SELECT relation, count(*) FILTER (NOT urgent) AS ways, count(*) FILTER (urgent) AS lost, count(*) FILTER (NOT urgent AND was) AS runs,
sum((k % 1000) * (k * 29 % 887) - (k * 13 % 991) * (k * 7 % 777) + (k * 13 % 991) * (n * 7 % 777) - (n % 1000) * (k * 29 % 887)) AS twice FROM o GROUP BY 1)
SELECT relation, CASE WHEN lost = 0 THEN 1 ELSE 0 END AS closed, runs AS loose, ways, 2 * ways + CASE WHEN lost = 0 THEN 1 ELSE runs END AS nodes, CASE WHEN lost = 0 THEN abs(twice) / 2 END AS area FROM s WHERE ways > 0"""

QUERIES = {
    "map_features": (map_features, FEATURES),
    "map_rings": (map_rings, RINGS),
}
