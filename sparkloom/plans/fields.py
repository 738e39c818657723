"""Labels, typed notices, house style, fields of texts, geometries and work lists over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import records, rules, shapes, text, values
from sparkloom.operators import keyed
from sparkloom.session import table


def label_shapes(spark, sf_dir):
    """How many of a document's pieces between line breaks and commas are cut short, noise, or running text."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", "[\n,]").alias("labels"))
    count = lambda test: F.size(F.filter("labels", test)).cast("bigint")
    return d.select("doc_id", F.size("labels").cast("bigint").alias("n"), count(rules.truncated_label).alias("n_truncated"), count(rules.noise_label).alias("n_noise"), count(rules.paragraph_label).alias("n_paragraph"))


SHAPES = r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '[\n,]')) AS x FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, lower(regexp_replace(x, '^[ /–—-]+|[ /–—-]+$', '', 'g')) AS low FROM l)
SELECT doc_id, count(*) AS n, count(*) FILTER (regexp_matches(x, '(?i)\s(à|de|du|des|et|en|au|aux|par|pour|sur|sous|la|le|les|liée?s?\s+à)\s*$')) AS n_truncated,
count(*) FILTER (length(low) < 3 OR regexp_matches(low, '^[0-9\s''’.,m]+$') OR regexp_matches(low, 'echelle|legende|légende|commune de|plan directeur|urbaplan')) AS n_noise,
count(*) FILTER (regexp_matches(x, '\.\s+[A-ZÉÈÊÀÂÎÔÛÇ]') OR regexp_matches(x, ':\s*$') OR regexp_matches(x, '^\s*([>•·]|[-–—]\s)') OR regexp_matches(x, '^\s*[0-9]+(\.[0-9]+)?(\s*[-–]\s*[0-9]+(\.[0-9]+)?)?\s*$')
OR regexp_matches(x, '[.!?]\s+[\p{L}\p{N}_]+.*[.!?]')) AS n_paragraph FROM s GROUP BY doc_id"""

# Notices as they are written; the SQL holds what a reader takes from each.
NOTICES = """(0, 'Appartement en PPE, 4 pièces', 'mig-12-3', 'French', 'ZH', '2600000.0/1200000', ' 12,5 m2', '3/4/2024', '2nd floor;Construit en 1987', 'Bonjour! Tell me that you saw me on Place !'),
(1, 'Terrain  bâti, garage', 'AB1C-9Z9Z-123', NULL, 'TI', '2500000/1118000.5', 'ca. 80', '2024-01-02', 'étage 3', 'Incall : Je reçois en salon. Bienvenue'),
(2, 'Villa jumelle et parcelle', 'ab1c-9z9z-123', '', 'GR', '260000/1200000', '-3 m', '13/12/2023', 'Surface propriété: 820 m2;surface utilisable 75', 'https://www.place.ch/ad/12?x=1 voir'),
(3, 'part de copropriété simple', NULL, 'DE-ch', 'TI', NULL, NULL, NULL, 'balcon', NULL),
(4, 'Stockwerkeigentum', '17.5', NULL, 'GE', 'x', '7', '1/2', 'disponible de suite;3e ÉTAGE disponible', 'Pour voir mes photos non censurées : ici'),
(5, 'zone rurale, chalets', '', NULL, NULL, '2720000/1075000', 'm2', ' 9/10/2021 ', 'surface propriété inconnue', 'Outcall: Je ne me deplace pas.'),
(6, 'Place de parc', 'mig', 'IT', 'VD', '1200000/2600000', '007', '', '', 'Dis moi que tu m’as vu sur place')"""
READ = """(0, 'PPE', 'migrated', 'fr', 2600000.0, 1200000.0, 12, '2024-04-03', '2nd floor', NULL, NULL, NULL, 1987, 'Bonjour!'),
(1, 'terrain bati', 'newhome', 'it', 2500000.0, 1118000.5, NULL, '2024-01-02', 'étage 3', NULL, NULL, NULL, NULL, 'Bienvenue'),
(2, 'villa', 'other', 'de', NULL, NULL, -3, '2023-12-13', NULL, NULL, 820, 75, NULL, 'voir'),
(3, 'COP', 'unknown', 'de', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL),
(4, 'PPE', 'other', 'fr', NULL, NULL, 7, '1/2', '3e ÉTAGE disponible', 'disponible de suite', NULL, NULL, NULL, 'ici'),
(5, 'rural', 'unknown', 'fr', 2720000.0, 1075000.0, NULL, '2021-10-09', NULL, NULL, NULL, NULL, NULL, NULL),
(6, 'place de parc', 'other', 'it', 1200000.0, 2600000.0, 7, '', NULL, NULL, NULL, NULL, NULL, NULL)"""


def typed_notices(spark, sf_dir):
    """Parts under hand-written notices: type, portal, language, place, size, day, remarks and plain description."""
    notices = spark.sql(f"SELECT * FROM VALUES {NOTICES} AS t(n, title, ref, language, canton, place, size, day, extras, note)")
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 7).cast("int").alias("n"))
    j = p.join(F.broadcast(notices), "n")  # seven rows
    point = values.swiss_point(F.split("place", "\n"))
    return j.select(
        "p_partkey", rules.property_type(F.col("title")).alias("type"), rules.portal(F.col("ref"), "other").alias("portal"), rules.canton_language(F.col("language"), F.col("canton")).alias("lang"),
        F.round(point["lon"], 6).alias("lon"), F.round(point["lat"], 6).alias("lat"), values.prefix_integer(F.col("size")).alias("size"), values.day_first(F.col("day")).alias("day"),
        rules.extra_properties(F.split("extras", ";")).alias("e"), text.without_phrases(F.col("note"), "place").alias("note"),
    ).select("*", "e.*").drop("e")


TYPED = f"""WITH t AS (SELECT * FROM (VALUES {READ}) AS t(n, type, portal, lang, east, north, size, day, floor, availability, parcel_m2, usable_m2, built, note)),
m AS (SELECT *, (east - 2600000) / 1e6 AS y, (north - 1200000) / 1e6 AS x FROM t)
SELECT p_partkey, type, portal, lang, round((2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y) * 100 / 36, 6) AS lon,
round((16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x) * 100 / 36, 6) AS lat,
size::BIGINT AS size, day, floor, availability, parcel_m2::BIGINT AS parcel_m2, usable_m2::BIGINT AS usable_m2, built::BIGINT AS built, note FROM part JOIN m ON p_partkey % 7 = n"""


def url_fields(spark, sf_dir):
    """Fields of a page's URL behind question mark, ampersand and fragment; the last of a name counts."""
    p = table(spark, sf_dir, "pages").select("page_id", F.split(F.concat("url", F.lit("&page=&tag = a=b &tag=c")), "[?&#]").alias("parts"))
    fields = p.withColumn("fields", records.key_values(F.col("parts"), "="))
    field = lambda name: F.try_element_at("fields", F.lit(name)).alias(name)
    return fields.select("page_id", F.array_join("parts", " | ").alias("raw"), field("page"), field("ref"), field("tag"), F.size("fields").cast("bigint").alias("n_fields"))


FIELDS = r"""WITH p AS (SELECT page_id, string_split_regex(url || '&page=&tag = a=b &tag=c', '[?&#]') AS parts FROM pages),
f AS (SELECT page_id, list_filter(list_transform(parts, lambda x: {'k': trim(split_part(x, '=', 1)), 'v': trim(x[instr(x, '=') + 1:]), 'has': contains(x, '=')}), lambda x: x.has AND x.k <> '' AND x.v <> '') AS kv FROM p)
SELECT page_id, array_to_string(parts, ' | ') AS raw, list_filter(kv, lambda x: x.k = 'page')[-1].v AS page, list_filter(kv, lambda x: x.k = 'ref')[-1].v AS ref,
list_filter(kv, lambda x: x.k = 'tag')[-1].v AS tag, len(list_distinct(list_transform(kv, lambda x: x.k))) AS n_fields FROM p JOIN f USING (page_id)"""


def page_links(spark, sf_dir):
    """A page as a link with its heading and a price, in house style; links to one domain lose their tag."""
    p = table(spark, sf_dir, "pages")
    head = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    link = F.concat(F.lit('<a href="'), "url", F.lit('">'), head, F.lit("</a> – lu  : "), F.col("page_id").cast("string"), F.lit(" francs — "), F.col("page_id").cast("string"), F.lit(".50CHF ! "))
    return p.select("page_id", text.house_style(link, ("example.net",)).alias("link"))


LINKS = r"""WITH p AS (SELECT page_id, url, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS head FROM pages)
SELECT page_id, CASE WHEN regexp_matches(url, 'example\.net') THEN head ELSE '<a href="' || url || '" target="_blank" rel="noopener">' || head || '</a>' END || ' - lu: CHF ' || page_id || '.- - CHF ' || page_id || '.50!' AS link FROM p"""


def page_sections(spark, sf_dir):
    """What stands in a page's HTML between one heading, paragraph or list item and the next."""
    p = table(spark, sf_dir, "pages").select("page_id", F.inline(records.sections(F.col("html"), r"<(?:h[1-6]|p|li)(?:\s[^>]*)?>")))
    return p.select("page_id", "place", "header", F.md5("body").alias("digest"), F.length("body").cast("bigint").alias("n"))


SECTIONS = r"""WITH p AS (SELECT page_id, html, regexp_replace(html, '(<(?:h[1-6]|p|li)(?:\s[^>]*)?>)', chr(1) || '\1' || chr(2), 'g') AS marked FROM pages),
s AS (SELECT page_id, unnest(string_split(marked, chr(1))) AS piece, unnest(range(0, len(string_split(marked, chr(1))))) AS place FROM p)
SELECT page_id, place, CASE WHEN place > 0 THEN split_part(piece, chr(2), 1) END AS header, md5(CASE WHEN place > 0 THEN split_part(piece, chr(2), 2) ELSE piece END) AS digest,
length(CASE WHEN place > 0 THEN split_part(piece, chr(2), 2) ELSE piece END) AS n FROM s"""

# Records as services give them, with an event's properties at @; the SQL holds what is to be read from each.
RECORDS = """(0, '{"fr": {"language": "fr", "value": "Genève"}, "de": {"language": "de"}}', '[{"building_id": "12/34-5", "floor": 2}, {"building_id": "9/9"}]', '{"id": 7, "cpv": [], "vendors": {"a": [1]}, "note": null, "props": @}', '[{"language": "FR", "text": "Noël"}, {"language": "fr", "text": "autre"}]'),
(1, '{', '{"building_id": "1/2-3"}', '{"cpv": [@, 2], "vendors": "x"}', '[{"language": "DE", "text": "Ostern"}]'),
(2, '{}', '[1', '[1]', '[]'),
(3, NULL, NULL, NULL, NULL),
(4, '{"de": {"value": "Genf", "x": 1}, "it": null}', '[{"floor": null}, {"building_id": "7/8-09"}]', '{"cpv": "[]", "vendors": {}, "tags": [], "props": @}', '[{"language": "fr", "text": null}, {"language": "de", "text": "Neujahr"}]')"""
KNOWN = """(0, 'Genève', NULL, '[{"floor":2,"building_id":"12/34","feuillet_number":"5"},{"building_id":"9/9"}]', '{"id":7,"props":@,"vendors":"{\\"a\\":[1]}"}', 'Noël', NULL),
(1, NULL, NULL, '{"building_id": "1/2-3"}', '{"cpv":"[#,2]","vendors":"x"}', NULL, 'Ostern'),
(2, NULL, NULL, '[1', NULL, NULL, NULL),
(3, NULL, NULL, NULL, NULL, NULL, NULL),
(4, NULL, 'Genf', '[{"floor":null},{"building_id":"7/8","feuillet_number":"09"}]', '{"cpv":"[]","props":@,"tags":[]}', NULL, 'Neujahr')"""


def messy_records(spark, sf_dir):
    """Records with an event's properties in them: labels by language, building ids split, empty lists and null keys out, names as columns."""
    given = spark.sql(f"SELECT * FROM VALUES {RECORDS} AS t(n, labels, buildings, record, names)")
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5).cast("int").alias("n"), F.coalesce("props", F.lit("{}")).alias("props"))
    j = e.join(F.broadcast(given), "n")  # five rows
    labels = j.withColumn("labels", records.flat_labels(F.col("labels"))).withColumn("names", F.from_json("names", "array<struct<language: string, text: string>>"))
    record = records.tidy_record(F.replace("record", F.lit("@"), "props"), "cpv", "vendors")
    return labels.select(
        "event_id", F.try_element_at("labels", F.lit("fr")).alias("label_fr"), F.try_element_at("labels", F.lit("de")).alias("label_de"), records.split_building_ids(F.col("buildings")).alias("buildings"),
        record.alias("record"), records.by_language(F.col("names"), "fr").alias("name_fr"), records.by_language(F.col("names"), "de").alias("name_de"),
    )


MESSY = rf"""WITH k AS (SELECT * FROM (VALUES {KNOWN}) AS k(n, label_fr, label_de, buildings, record, name_fr, name_de)), e AS (SELECT event_id, replace(coalesce(props, '{{}}'), ' ', '') AS props FROM events)
SELECT event_id, label_fr, label_de, buildings, replace(replace(record, '@', props), '#', replace(props, '"', '\"')) AS record, name_fr, name_de FROM e JOIN k ON event_id % 5 = n"""


def feature_geometry(spark, sf_dir):
    """G1: customers' plots as feature services send them: points, rings of either direction with holes and open ends, lines, and broken or empty ones."""
    k = F.col("c_custkey")
    x, y = k % 50, k % 40
    text_of = lambda pattern, *points: F.format_string(pattern, *[v.cast("bigint") for p in points for v in p])
    corner = "[%d, %d]"
    ring = lambda n: "[" + ", ".join([corner] * n) + "]"
    hole = [(x + 1, y + 1), (x + 2, y + 1), (x + 2, y + 2), (x + 1, y + 1)]
    box = [(x, y), (x + 9, y), (x + 9, y + 9), (x, y)]
    document = (
        F.when(k % 7 == 0, text_of('{"x": %d, "y": "%d"}', (x, y)))
        .when(k % 7 == 1, text_of(f'{{"rings": [{ring(4)}]}}', (x, y), (x, y + 2), (x + 3, y + 2), (x + 3, y)))
        .when(k % 7 == 2, text_of(f'{{"rings": [{ring(4)}, {ring(4)}]}}', *box, *hole))
        .when(k % 7 == 3, text_of(f'{{"paths": [{ring(2)}], "spatialReference": {{"wkid": 4326}}}}', (x, y), (x + 1, y)))
        .when(k % 7 == 4, text_of(f'{{"rings": [{ring(3)}', (x, y), (x, y), (x, y)))
        .when(k % 7 == 5, text_of(f'{{"rings": [{ring(2)}]}}', (x, y), (x + 1, y)))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", shapes.geojson(document).alias("geometry"))


def _sql_points(*points: str) -> str:
    return "'[' || " + " || ',' || ".join(f"'[' || ({p.split(' ')[0]}) || '.0,' || ({p.split(' ')[1]}) || '.0]'" for p in points) + " || ']'"


GEOMETRY = f"""WITH c AS (SELECT c_custkey, c_custkey % 50 AS x, c_custkey % 40 AS y FROM customer)
SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '{{"type":"Point","coordinates":[' || x || '.0,' || y || '.0]}}'
WHEN 1 THEN '{{"type":"Polygon","coordinates":[' || {_sql_points("x y", "x+3 y", "x+3 y+2", "x y+2", "x y")} || ']}}'
WHEN 2 THEN '{{"type":"Polygon","coordinates":[' || {_sql_points("x y", "x+9 y", "x+9 y+9", "x y")} || ',' || {_sql_points("x+1 y+1", "x+2 y+2", "x+2 y+1", "x+1 y+1")} || ']}}'
WHEN 3 THEN '{{"type":"MultiLineString","coordinates":[' || {_sql_points("x y", "x+1 y")} || ']}}' END AS geometry FROM c"""


def candle_clock(spark, sf_dir):
    """The quarter of an hour that an event falls into, from milliseconds."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    e = table(spark, sf_dir, "events").select("event_id", values.candle_times(ms - ms % 900_000, F.lit(900_000)).alias("c"))
    form = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
    return e.select("event_id", form("c.open_time").alias("opened"), form("c.close_time").alias("closed"), F.col("c.hour_utc").cast("bigint").alias("hour_utc"), F.col("c.dow_utc").cast("bigint").alias("dow_utc"))


CLOCK = """WITH e AS (SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS o FROM events)
SELECT event_id, strftime(o, '%Y-%m-%d %H:%M:%S.%g') AS opened, strftime(o + INTERVAL 15 MINUTE - INTERVAL 1 MILLISECOND, '%Y-%m-%d %H:%M:%S.%g') AS closed, hour(o) AS hour_utc, dayofweek(o) AS dow_utc FROM e"""


def fetch_days(spark, sf_dir):
    """The day from which a customer's orders are to be fetched again: 400 days back, or the newest known where that is earlier."""
    newest = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("newest"))
    c = table(spark, sf_dir, "customer").select("c_custkey").join(newest, "c_custkey", "left")
    return c.select("c_custkey", values.fetch_from(F.col("newest"), F.lit("2000-01-31").cast("date"), 400).cast("string").alias("first_day"))


DAYS = """SELECT c_custkey, strftime(least(coalesce(max(o_orderdate)::DATE, DATE '2000-01-31'), DATE '2000-01-31' - 400), '%Y-%m-%d') AS first_day FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""


def daily_work(spark, sf_dir):
    """Customers to fetch today: those without orders yet, and a tenth of the others by digest."""
    known = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return keyed.work_list(table(spark, sf_dir, "customer"), known, ["c_custkey"], "daily", 0.1).select("c_custkey", "c_name", "is_new")


WORK = """WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'),
c AS (SELECT c_custkey, c_name, o_custkey IS NULL AS is_new FROM customer LEFT JOIN k ON o_custkey = c_custkey)
SELECT * FROM c WHERE is_new OR ('0x' || md5(c_custkey::VARCHAR)[:4])::INTEGER < 6553"""


QUERIES = {
    "label_shapes": (label_shapes, SHAPES),
    "typed_notices": (typed_notices, TYPED),
    "url_fields": (url_fields, FIELDS),
    "page_links": (page_links, LINKS),
    "page_sections": (page_sections, SECTIONS),
    "messy_records": (messy_records, MESSY),
    "feature_geometry": (feature_geometry, GEOMETRY),
    "candle_clock": (candle_clock, CLOCK),
    "fetch_days": (fetch_days, DAYS),
    "daily_work": (daily_work, WORK),
}
