"""Text, number, date, rule and quality queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import rules, text, values
from sparkloom.session import table


def clean_text(spark, sf_dir):
    """Padded, dashed and blank variants of part names."""
    raw = F.when(F.col("p_partkey") % 5 == 0, F.lit(" - ")).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("  "), "p_name", F.lit("\t"))).when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("• "), "p_name", F.lit(" –"))).otherwise(F.concat("p_name", F.lit("  x")))
    p = table(spark, sf_dir, "part").withColumn("raw", raw)
    return p.select("p_partkey", F.coalesce(text.clean(F.col("raw")), F.lit("~")).alias("cleaned"), F.coalesce(text.collapse(F.col("raw")), F.lit("~")).alias("collapsed"), F.coalesce(text.clean_label(F.col("raw")), F.lit("~")).alias("label"))


CLEAN = r"""WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ' - ' WHEN 1 THEN chr(160) || ' ' || p_name || chr(9) WHEN 2 THEN '• ' || p_name || ' –' ELSE p_name || '  x' END AS raw FROM part),
t AS (SELECT p_partkey, raw, regexp_replace(raw, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS c FROM p)
SELECT p_partkey, CASE WHEN c IN ('', '-', '—', 'N/A') THEN '~' ELSE c END AS cleaned,
coalesce(nullif(regexp_replace(regexp_replace(raw, '\s+', ' ', 'g'), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'), ''), '~') AS collapsed,
coalesce(nullif(regexp_replace(regexp_replace(raw, '^[\s•·*–—-]+|[\s•·*–—-]+$', '', 'g'), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'), ''), '~') AS label FROM t"""


def slugs(spark, sf_dir):
    """Slugs of part types and a file name."""
    p = table(spark, sf_dir, "part").withColumn("raw", F.concat(F.lit("Épône "), "p_type"))
    return p.select("p_partkey", text.slugify(F.col("raw")).alias("slug"), text.slugify(F.col("raw"), "-", 12).alias("short"), text.file_name(F.col("p_brand"), F.col("p_partkey").cast("string"), url=F.lit("http://h/a.PNG?x")).alias("file"))


SLUGS = r"""SELECT p_partkey, regexp_replace(lower(strip_accents('Épône ' || p_type)), '[^a-z0-9]+', '_', 'g') AS slug,
left(regexp_replace(lower(strip_accents('Épône ' || p_type)), '[^a-z0-9]+', '-', 'g'), 12) AS short,
regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g') || '-' || p_partkey || '.png' AS file FROM part"""


def swiss_numbers(spark, sf_dir):
    """Prices written four ways and read back."""
    o = table(spark, sf_dir, "orders").withColumn("whole", F.floor("o_totalprice").cast("string"))
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("CHF "), "whole", F.lit(".50"))).when(F.col("o_orderkey") % 3 == 1, F.concat("whole", F.lit(",5"))).otherwise(F.concat("whole", F.lit(".--")))
    o = o.withColumn("raw", raw)
    return o.select("o_orderkey", values.swiss_number(F.col("raw")).alias("amount"), F.coalesce(values.prefix_number(F.col("raw")), F.lit(-1.0)).alias("prefix"), values.half_up(F.col("o_totalprice")).alias("rounded"), values.clamp(F.col("o_totalprice") / 200000 - 0.25).alias("clamped"))


SWISS = """WITH o AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS w FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN CAST(w AS DOUBLE) ELSE w + 0.5::DOUBLE END AS amount, CASE o_orderkey % 3 WHEN 0 THEN -1.0::DOUBLE WHEN 1 THEN w + 0.5::DOUBLE ELSE CAST(w AS DOUBLE) END AS prefix,
CAST(floor(o_totalprice + 0.5) AS BIGINT) AS rounded, greatest(0.0::DOUBLE, least(1.0::DOUBLE, o_totalprice / 200000 - 0.25)) AS clamped FROM o"""


def parse_dates(spark, sf_dir):
    """Order dates in three notations, and broken ones."""
    form = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "dd-MM-yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "d/M/yyyy")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("31.02.2024"))
    o = table(spark, sf_dir, "orders").withColumn("d", values.any_date(form))
    return o.select("o_orderkey", F.coalesce(F.date_format("d", "yyyy-MM-dd"), F.lit("~")).alias("day"), F.coalesce(values.sunday_first(F.col("d")), F.lit(-1)).alias("dow"), F.date_format(F.greatest("d", F.lit("1996-01-01").cast("date")), "yyyy-MM-dd").alias("latest"))


DATES = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
SELECT o_orderkey, coalesce(strftime(d, '%Y-%m-%d'), '~') AS day, CAST(coalesce(dayofweek(d), -1) AS INT) AS dow, strftime(greatest(coalesce(d, DATE '1996-01-01'), DATE '1996-01-01'), '%Y-%m-%d') AS latest FROM o"""


def two_digit_year(spark, sf_dir):
    """The three pivots side by side."""
    yy = (F.col("p_partkey") % 100).cast("int")
    return table(spark, sf_dir, "part").select("p_partkey", values.full_year(yy, 50).alias("from_50"), values.full_year(yy, 80).alias("from_80"), values.full_year(yy, 50, False).alias("after_50"))


YEARS = """SELECT p_partkey, CAST(y + CASE WHEN y >= 50 THEN 1900 ELSE 2000 END AS INT) AS from_50, CAST(y + CASE WHEN y >= 80 THEN 1900 ELSE 2000 END AS INT) AS from_80, CAST(y + CASE WHEN y > 50 THEN 1900 ELSE 2000 END AS INT) AS after_50 FROM (SELECT p_partkey, p_partkey % 100 AS y FROM part)"""


def phone_normalize(spark, sf_dir):
    """Numbers in four notations to digits with the country code."""
    n = F.lpad(F.col("c_custkey").cast("string"), 9, "7")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("0"), n)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("0041 "), n)).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("+41 "), n, F.lit("99"))).otherwise(F.lit("12"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(text.normalize_phone(raw), F.lit("~")).alias("phone"))


PHONE = "SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN '~' ELSE '41' || lpad(c_custkey::VARCHAR, 9, '7') END AS phone FROM customer"


def uid_format(spark, sf_dir):
    """Nine digits as a grouped id, shorter ones as they are."""
    raw = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("CHE"), F.lpad(F.col("s_suppkey").cast("string"), 9, "1"))).otherwise(F.col("s_suppkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.format_uid(raw).alias("uid"))


UID = """WITH s AS (SELECT s_suppkey, lpad(s_suppkey::VARCHAR, 9, '1') AS d FROM supplier)
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'CHE-' || d[1:3] || '.' || d[4:6] || '.' || d[7:9] ELSE s_suppkey::VARCHAR END AS uid FROM s"""


def html_to_text(spark, sf_dir):
    """Paragraphs of pages by pattern, counted and joined."""
    inner = F.regexp_extract_all("html", F.lit(r"<p>([^<]*)</p>"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.size(inner).cast("bigint").alias("n_paragraphs"), F.md5(F.array_join(inner, "\n")).alias("digest"), F.coalesce(text.collapse(F.regexp_extract("html", r"<title>([^<]*)</title>", 1)), F.lit("~")).alias("title"))


HTML = r"""SELECT page_id, len(regexp_extract_all(html, '<p>([^<]*)</p>', 1)) AS n_paragraphs, md5(array_to_string(regexp_extract_all(html, '<p>([^<]*)</p>', 1), chr(10))) AS digest,
coalesce(nullif(regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g'), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'), ''), '~') AS title FROM pages"""


def html_meta(spark, sf_dir):
    """Language, link counts and host of pages."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("lang"), F.size(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).cast("bigint").alias("n_links"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


META = r"""SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages"""


def json_props(spark, sf_dir):
    """M3 M4 M8: the number in an event's properties, summed by type; broken ones are null."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.count(k).alias("n"))


JSON = "SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total, count(props->>'k') AS n FROM events GROUP BY 1"


def content_hash_dups(spark, sf_dir):
    """Texts that occur more than once, by digest, and who was first."""
    d = table(spark, sf_dir, "documents").withColumn("digest", F.md5("text"))
    return d.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


HASHES = "SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1"

TYPE_RULES = [("econ|small", "cheap"), ("steel|brass", "metal"), ("^promo", "promo"), ("tin$", "tin")]


def property_type_rules(spark, sf_dir):
    """The first rule that fits a part's type."""
    return table(spark, sf_dir, "part").select("p_partkey", rules.first_match(F.col("p_type"), TYPE_RULES, "other").alias("class"))


TYPES = "SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(p_type, '(?i){p}') THEN '{c}'" for p, c in TYPE_RULES) + " ELSE 'other' END AS class FROM part"


def drop_reasons(spark, sf_dir):
    """F2-F8 F16: why documents would be dropped; the first reason and all of them."""
    t = F.col("text")
    tests = [("short", F.length(t) < 100), ("shouting", t.rlike("[A-Z]{5,}!!")), ("table", t.rlike(r" \| ")), ("marks", t.rlike(r"(\*\*\*|###|%%%)"))]
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.coalesce(rules.first_reason(*tests), F.lit("~")).alias("reason"), F.array_join(rules.reasons(*tests), ",").alias("all_reasons"))


REASONS = r"""WITH d AS (SELECT doc_id, length(text) < 100 AS a, regexp_matches(text, '[A-Z]{5,}!!') AS b, regexp_matches(text, ' \| ') AS c, regexp_matches(text, '(\*\*\*|###|%%%)') AS e FROM documents)
SELECT doc_id, CASE WHEN a THEN 'short' WHEN b THEN 'shouting' WHEN c THEN 'table' WHEN e THEN 'marks' ELSE '~' END AS reason,
concat_ws(',', CASE WHEN a THEN 'short' END, CASE WHEN b THEN 'shouting' END, CASE WHEN c THEN 'table' END, CASE WHEN e THEN 'marks' END) AS all_reasons FROM d"""


def rooms_bucket(spark, sf_dir):
    """Sizes in buckets, counted."""
    return table(spark, sf_dir, "part").groupBy(values.bucket(F.col("p_size"), 10, 20, 35).alias("bucket")).agg(F.count("*").alias("n"))


ROOMS = "SELECT CAST(CASE WHEN p_size >= 35 THEN 4 WHEN p_size >= 20 THEN 3 WHEN p_size >= 10 THEN 2 ELSE 1 END AS INT) AS bucket, count(*) AS n FROM part GROUP BY 1"


def lv03_to_wgs84(spark, sf_dir):
    """Grid metres to degrees, and whether they lie in the country's box."""
    east, north = 500000 + F.col("s_suppkey") * 997 % 350000, 70000 + F.col("s_suppkey") * 1231 % 230000
    lon, lat = values.lv03_to_wgs84(east.cast("double"), north.cast("double"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), (lon.between(5.5, 11) & lat.between(45.5, 48)).alias("inside"))


GRID = """WITH g AS (SELECT s_suppkey, CAST(500000 + s_suppkey * 997 % 350000 - 600000 AS DOUBLE) / 1e6 AS y, CAST(70000 + s_suppkey * 1231 % 230000 - 200000 AS DOUBLE) / 1e6 AS x FROM supplier),
d AS (SELECT s_suppkey, (2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y) * 100 / 36 AS lon, (16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x) * 100 / 36 AS lat FROM g)
SELECT s_suppkey, round(lon, 6) AS lon, round(lat, 6) AS lat, lon BETWEEN 5.5 AND 11 AND lat BETWEEN 45.5 AND 48 AS inside FROM d"""


def filtered_counts_by_run(spark, sf_dir):
    """Events of a user and day by outcome."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


COUNTS = """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS purchases, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1, 2"""


def quality_gates(spark, sf_dir):
    """A2 A3 A4: five gates a supplier in one pass."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"), F.count_if(F.col("l_quantity") >= 40).alias("big"), (F.count_if(F.col("l_discount") > 0.09) * 10 <= F.count("*")).alias("gate_discount"), (F.countDistinct("l_partkey") >= 5).alias("gate_parts"), (F.max("l_tax") <= 0.08).alias("gate_tax")
    )


GATES = """SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(*) FILTER (l_quantity >= 40) AS big, count(*) FILTER (l_discount > 0.09) * 10 <= count(*) AS gate_discount, count(DISTINCT l_partkey) >= 5 AS gate_parts, max(l_tax) <= 0.08 AS gate_tax FROM lineitem GROUP BY 1"""


def run_summary(spark, sf_dir):
    """Days as runs, with a status by the share of events that aren't errors."""
    e = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") != "error").alias("done"), F.countDistinct("user_id").alias("users"))
    return e.withColumn("status", rules.run_status(F.col("done"), F.col("n"), 0.8))


SUMMARY = """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (event_type <> 'error') AS done, count(DISTINCT user_id) AS users FROM events GROUP BY 1)
SELECT *, CASE WHEN done = n THEN 'ok' WHEN done >= 0.8 * n THEN 'partial' ELSE 'failed' END AS status FROM e"""


def precision_recall(spark, sf_dir):
    """A rule for bad documents against the labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike(r"(\*\*\*|%%%|!!)").alias("flagged"))
    j = d.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("bad", F.col("quality") == 0)
    hit = F.count_if(F.col("flagged") & F.col("bad"))
    return j.agg(hit.alias("hits"), F.count_if("flagged").alias("flagged"), F.count_if("bad").alias("bad"), F.round(hit / F.count_if("flagged"), 6).alias("precision"), F.round(hit / F.count_if("bad"), 6).alias("recall"))


PRECISION_SQL = r"""WITH j AS (SELECT regexp_matches(text, '(\*\*\*|%%%|!!)') AS f, quality = 0 AS b FROM documents JOIN labels USING (doc_id))
SELECT count(*) FILTER (f AND b) AS hits, count(*) FILTER (f) AS flagged, count(*) FILTER (b) AS bad, round(count(*) FILTER (f AND b) / count(*) FILTER (f), 6) AS precision, round(count(*) FILTER (f AND b) / count(*) FILTER (b), 6) AS recall FROM j"""


def coverage_gate(spark, sf_dir):
    """Share of documents with a label by source, and whether it is enough."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("has")), "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count("has").alias("labelled"), (F.count("has") * 10 >= F.count("*") * 4).alias("enough"))


COVERAGE = "SELECT source, count(*) AS n, count(l.doc_id) AS labelled, count(l.doc_id) * 10 >= count(*) * 4 AS enough FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1"


def route_confidence(spark, sf_dir):
    """Labelled documents routed by confidence and vocabulary."""
    j = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    confidence = F.least(F.lit(1.0), F.col("n_chars") / 2000)
    topics = values.flags(toxic=F.col("toxic") == 1, good=F.col("quality") == 1, other=F.col("lang") == "es")
    return j.select("doc_id", F.array_join(topics, ",").alias("topics"), rules.route(confidence, rules.within_vocabulary(topics, F.array(F.lit("toxic"), F.lit("good")))).alias("route"), rules.enum_or(F.col("lang"), ["en", "de"], "xx").alias("lang"))


ROUTE = """SELECT doc_id, concat_ws(',', CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 1 THEN 'good' END, CASE WHEN lang = 'es' THEN 'other' END) AS topics,
CASE WHEN least(1.0, n_chars / 2000) >= 0.75 AND lang <> 'es' THEN 'auto' ELSE 'needs_review' END AS route, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'xx' END AS lang FROM labels JOIN documents USING (doc_id)"""


def section_bodies(spark, sf_dir):
    """Lines of documents with their length and that of the line behind."""
    from pyspark.sql.window import Window

    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    ahead = F.lead(F.length("line")).over(Window.partitionBy("doc_id").orderBy("place"))
    return lines.select("doc_id", F.col("place").cast("bigint").alias("place"), F.length("line").cast("bigint").alias("n"), F.coalesce(ahead, F.lit(-1)).cast("bigint").alias("n_next"))


SECTIONS = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS place FROM documents)
SELECT doc_id, place, length(line) AS n, coalesce(lead(length(line)) OVER (PARTITION BY doc_id ORDER BY place), -1) AS n_next FROM l"""


def sections_concat(spark, sf_dir):
    """Titled sections of documents, their words and keywords."""
    d = table(spark, sf_dir, "documents")
    whole = text.sections(("Source", F.col("source")), ("Language", F.when(F.col("lang") != "en", F.col("lang"))))
    return d.select("doc_id", F.md5(whole).alias("digest"), F.ceil(F.length("text") / 1000).alias("pages"), F.array_join(values.keywords(F.concat_ws(",", "source", "lang", "source")), "|").alias("keywords"))


SECTIONS_CONCAT = """SELECT doc_id, md5('## Source' || chr(10) || chr(10) || source || CASE WHEN lang <> 'en' THEN chr(10) || chr(10) || '## Language' || chr(10) || chr(10) || lang ELSE '' END) AS digest,
CAST(ceil(length(text) / 1000) AS BIGINT) AS pages, source || '|' || lang AS keywords FROM documents"""

QUERIES = {
    "clean_text": (clean_text, CLEAN),
    "slugify": (slugs, SLUGS),
    "swiss_number": (swiss_numbers, SWISS),
    "parse_dates": (parse_dates, DATES),
    "two_digit_year": (two_digit_year, YEARS),
    "phone_normalize": (phone_normalize, PHONE),
    "uid_format": (uid_format, UID),
    "html_to_text": (html_to_text, HTML),
    "html_meta": (html_meta, META),
    "json_props": (json_props, JSON),
    "content_hash_dups": (content_hash_dups, HASHES),
    "property_type_rules": (property_type_rules, TYPES),
    "drop_reasons": (drop_reasons, REASONS),
    "rooms_bucket": (rooms_bucket, ROOMS),
    "lv03_to_wgs84": (lv03_to_wgs84, GRID),
    "filtered_counts_by_run": (filtered_counts_by_run, COUNTS),
    "quality_gates": (quality_gates, GATES),
    "run_summary": (run_summary, SUMMARY),
    "precision_recall": (precision_recall, PRECISION_SQL),
    "coverage_gate": (coverage_gate, COVERAGE),
    "route_confidence": (route_confidence, ROUTE),
    "section_bodies": (section_bodies, SECTIONS),
    "sections_concat": (sections_concat, SECTIONS_CONCAT),
}
