"""Map elements: signed ids, places, classes by tag order (G9, R28), and rings chained from ways.

Elements are rows ``(type, id, lat, lon, center, nodes, members, tags)``, as :func:`read_elements` gives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.session import shared_folder

ELEMENTS = (
    "elements array<struct<type: string, id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, nodes: array<bigint>, "
    "members: array<struct<type: string, ref: bigint, role: string>>, tags: map<string, string>>>"
)
#: Tag keys that name an element's class, the first that it has (fixed values).
TAG_ORDER = ["amenity", "shop", "tourism", "leisure", "historic", "place", "natural", "highway", "railway", "waterway", "landuse", "building"]
#: Codes of keys whose value has none of its own (fixed values).
DEFAULT_CODES = {"building": 1500}


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Answers ``{"elements": [...]}`` below ``path``, one element a row; the schema is given, so the files are read once."""
    return spark.read.schema(ELEMENTS).option("multiLine", True).json(path).select(F.inline("elements"))


def tag_class(tags: Column, order: list[str]) -> Column:
    """``(key, value)`` of the first key in ``order`` with a value that isn't empty; null without one."""
    tag = lambda k: F.get(F.map_values(F.map_filter(tags, lambda name, v: (name == k) & (v != ""))), F.lit(0))
    return F.coalesce(*[F.when(tag(k).isNotNull(), F.struct(F.lit(k).alias("key"), tag(k).alias("value"))) for k in order])


def titled(value: Column) -> Column:
    """Underscores as spaces, and each letter behind anything but a letter in upper case."""
    apart = F.regexp_replace(F.translate(value, "_", " "), r"(?<=[^\p{L}])(?=\p{L})", "\u0001 ")
    return F.regexp_replace(F.initcap(apart), "\u0001 ", "")


def features(elements: DataFrame, codes: DataFrame, order: list[str] = TAG_ORDER, defaults: dict[str, int] = DEFAULT_CODES) -> DataFrame:
    """``(osm_id, code, fclass, name, description, lon, lat, geometry)`` of the elements that have a class and a place.

    Ids of ways and relations are negative. Nodes have their own place, others their centre. ``codes`` holds ``(key, value, code,
    description)``, each key and value once; a key of ``defaults`` whose value it lacks has the default. Without a description the
    value itself is one. Null or empty tags have no class; an empty name is null.
    """
    tags = F.coalesce("tags", F.create_map().cast("map<string, string>"))
    node = F.coalesce(F.col("type"), F.lit("node")) == "node"
    of = lambda axis: F.when(node, F.col(axis)).otherwise(F.col(f"center.{axis}"))
    whole = F.col("type").isin("way", "relation")
    found = elements.select(
        F.when(whole, -F.col("id")).otherwise(F.col("id")).cast("string").alias("osm_id"),
        tag_class(tags, order).alias("c"), F.nullif(F.element_at(tags, "name"), F.lit("")).alias("name"), of("lon").alias("lon"), of("lat").alias("lat"),
    ).where("c IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    listed = codes.select(F.col("key").alias("__key"), F.col("value").alias("__value"), F.col("code").cast("bigint").alias("__code"), F.col("description").alias("__text"))
    joined = found.join(listed, (F.col("c.key") == F.col("__key")) & (F.col("c.value") == F.col("__value")), "left")
    code = F.coalesce("__code", *[F.when(F.col("c.key") == k, F.lit(v).cast("bigint")) for k, v in defaults.items()])
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    return joined.select("osm_id", code.alias("code"), F.col("c.value").alias("fclass"), "name", F.coalesce("__text", titled(F.col("c.value"))).alias("description"), "lon", "lat", point.alias("geometry"))


def follow(links: DataFrame, folder: str) -> DataFrame:
    """``(me, next, steps, low, last)`` of chains ``(me, next)``: steps to the end, the end, and the least name on the way.

    Pointers double, so a chain of n links takes log n joins; each round is a table below ``folder``. Cycles have no end:
    ``last`` is null there, and ``low`` the least name of the cycle.
    """
    spark = links.sparkSession
    end = F.col("next").isNull()
    table = links.select("me", "next", F.col("next").alias("to"), F.when(end, 0).otherwise(1).cast("bigint").alias("steps"), F.least("me", "next").alias("low"), F.when(end, F.col("me")).alias("last"), F.lit(True).alias("moved"))
    for i in range(64):
        table.write.parquet(f"{folder}/{i}")
        table = spark.read.schema(table.schema).parquet(f"{folder}/{i}")
        if table.where("moved").isEmpty():
            break
        far = table.select(F.col("me").alias("to"), F.col("to").alias("far"), F.col("steps").alias("on"), F.col("low").alias("lower"), F.col("last").alias("ending"))
        low, last = F.least("low", "lower"), F.col("ending")
        ahead = table.where("to IS NOT NULL").join(far, "to", "left")
        ahead = ahead.select("me", "next", F.col("far").alias("to"), (F.col("steps") + F.col("on")).alias("steps"), low.alias("low"), F.coalesce("last", last).alias("last"), ((low != F.col("low")) | (F.col("last").isNull() & last.isNotNull())).alias("moved"))
        table = ahead.unionByName(table.where("to IS NULL").withColumn("moved", F.lit(False)))
    return table.select("me", "next", "steps", "low", "last")


def rings(members: DataFrame, ways: DataFrame) -> DataFrame:
    """``(relation, role, ring, closed, ways, nodes)``: ways ``(way, nodes)`` of relations' members ``(relation, role, way)`` chained at their ends.

    Ways come in any order and direction. A way that ends where it begins is a ring; others meet at equal ends within a relation and
    role, and where more than two meet, two by two in the order of their ids: areas by the even-odd rule don't depend on that choice.
    ``ring`` is the least way of the chain, which is run through in that way's direction if it is closed. Chains with a loose end,
    as where a way is missing, aren't ``closed``. A member counts once a role; null roles are one role; ways below two nodes are left
    out. No relation is gathered in one task, only the nodes of one ring.
    """
    folder = shared_folder(members.sparkSession, "rings")
    count = F.size("nodes")
    held = members.select("relation", F.coalesce("role", F.lit("")).alias("role"), "way").distinct()
    placed = held.join(ways.where(count >= 2).select("way", "nodes"), "way").select("relation", "role", "way", "nodes")
    first, last = F.get("nodes", F.lit(0)), F.get("nodes", count - 1)
    own = placed.where(first == last).select("relation", "role", F.col("way").alias("ring"), F.lit(True).alias("closed"), F.lit(1).cast("bigint").alias("ways"), "nodes")

    # a dart is a way in one direction; at its end it goes on with the mate of that end
    ends = placed.where(first != last).select("relation", "role", "way", F.posexplode(F.array(first, last)).alias("end", "node"))
    spot = Window.partitionBy("relation", "role", "node").orderBy("way", "end")
    end = F.struct("way", "end")
    mates = ends.withColumn("rn", F.row_number().over(spot)).withColumn("mate", F.when(F.col("rn") % 2 == 1, F.lead(end).over(spot)).otherwise(F.lag(end).over(spot)))
    dart = lambda way, back: F.struct("relation", "role", way.alias("way"), back.alias("back"))
    links = mates.select(dart(F.col("way"), 1 - F.col("end")).alias("me"), F.when(F.col("mate").isNotNull(), dart(F.col("mate.way"), F.col("mate.end"))).alias("next"))
    reached = follow(links, f"{folder}/chains").withColumn("chain", F.coalesce("last", "low"))
    # both directions of a way are in two chains, one the other's reverse: one of them stays
    kept = reached.groupBy("me.relation", "me.role", "me.way").agg(F.min_by(F.struct("me", "next", "steps", "last", "chain"), "chain").alias("k")).select("k.*")
    loose = kept.where("last IS NOT NULL").select("me", "chain", "steps", F.lit(False).alias("closed"))
    around = kept.where("last IS NULL").select("me", F.when(F.col("next") != F.col("chain"), F.col("next")).alias("next"), "chain")
    around.write.parquet(f"{folder}/around")
    around = members.sparkSession.read.schema(around.schema).parquet(f"{folder}/around")
    whole = follow(around.select("me", "next"), f"{folder}/cycles").select("me", "steps").join(around.select("me", "chain"), "me").select("me", "chain", "steps", F.lit(True).alias("closed"))
    pieces = loose.unionByName(whole).select("me.*", "chain", "steps", "closed").join(ways.select("way", "nodes"), "way")
    way_nodes = F.when(F.col("back") == 1, F.reverse("nodes")).otherwise(F.col("nodes"))
    chains = pieces.groupBy("relation", "role", "chain", "closed").agg(F.min("way").alias("ring"), F.count("*").alias("ways"), F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("at"), way_nodes.alias("nodes")))).alias("parts"))
    joined = F.concat(F.slice(F.col("parts")[0]["nodes"], 1, 1), F.flatten(F.transform("parts", lambda p: F.slice(p["nodes"], 2, F.size(p["nodes"])))))
    return chains.select("relation", "role", "ring", "closed", "ways", joined.alias("nodes")).unionByName(own)


def outlines(found: DataFrame, places: DataFrame) -> DataFrame:
    """Rings with ``points`` ``(x, y)`` in place of their nodes, by ``places`` ``(node, x, y)``, each node once; ``missing`` counts nodes without one, which are left out."""
    keys = ["relation", "role", "ring"]
    each = found.select(*keys, "closed", "ways", F.posexplode("nodes").alias("at", "node")).join(places.select("node", "x", "y"), "node", "left")
    known = F.col("x").isNotNull() & F.col("y").isNotNull()
    points = F.array_sort(F.collect_list(F.when(known, F.struct("at", "x", "y"))))
    return each.groupBy(*keys, "closed", "ways").agg(points.alias("p"), F.count_if(~known).alias("missing")).select(
        *keys, "closed", "ways", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"), "missing"
    )


def polygons(outlined: DataFrame) -> DataFrame:
    """``(relation, rings)`` of the closed rings, as :func:`sparkloom.operators.overlay.overlay` takes them."""
    return outlined.where("closed").groupBy("relation").agg(F.transform(F.array_sort(F.collect_list(F.struct("role", "ring", "points"))), lambda r: r["points"]).alias("rings"))
