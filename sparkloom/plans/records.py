"""Nested records, labels, amounts and load lifecycles over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions import records
from sparkloom.operators import keyed
from sparkloom.session import table


def language_columns(spark, sf_dir):
    """The latest text of each language as columns of a source, and the title picked by language order."""
    d = table(spark, sf_dir, "documents")
    last = {lang: F.max_by(F.when(F.col("lang") == lang, F.md5("text")), F.when(F.col("lang") == lang, F.col("doc_id"))) for lang in ("fr", "de", "en")}
    merged = d.groupBy("source").agg(*[c.alias(f"title_{lang}") for lang, c in last.items()])
    return merged.withColumn("title", F.coalesce("title_fr", "title_de", "title_en"))


LANGUAGES = """SELECT source, max_by(md5(text), doc_id) FILTER (lang = 'fr') AS title_fr, max_by(md5(text), doc_id) FILTER (lang = 'de') AS title_de, max_by(md5(text), doc_id) FILTER (lang = 'en') AS title_en,
coalesce(title_fr, title_de, title_en) AS title FROM documents GROUP BY source"""


def first_source_wins(spark, sf_dir):
    """Of equal texts the one of the first source by name wins; what each source keeps, grouped."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    won = keyed.keep_one(d, ["digest"], [F.col("source").asc_nulls_last(), F.col("doc_id")])
    return won.groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


FIRST_SOURCE = """SELECT source, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM
(SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY source ASC NULLS LAST, doc_id) AS r FROM documents) WHERE r = 1 GROUP BY source"""


def nested_lines(spark, sf_dir):
    """An order's lines as an array of structs, filtered and rebuilt; the first large one, and any match."""
    line = F.struct(F.col("l_linenumber").cast("bigint").alias("no"), F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_partkey").alias("part"))
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    large = F.transform(F.filter("lines", lambda x: x["quantity"] > 30), lambda x: F.struct((x["quantity"] * 2).alias("twice"), x["no"].alias("no")))
    first = records.find_first(F.col("lines"), lambda x: x["quantity"] > 40)
    return o.select(
        "l_orderkey",
        F.size("lines").cast("bigint").alias("n"),
        F.aggregate(large, F.lit(0).cast("bigint"), lambda s, x: s + x["twice"]).alias("large_twice"),
        F.array_join(F.transform(large, lambda x: x["no"].cast("string")), ",").alias("large_numbers"),
        first["no"].alias("first_no"),
        F.exists("lines", lambda x: x["quantity"] == 50).alias("any_full"),
    )


NESTED = """WITH o AS (SELECT l_orderkey, list({'no': l_linenumber::BIGINT, 'quantity': l_quantity::BIGINT, 'part': l_partkey} ORDER BY l_linenumber, l_quantity::BIGINT, l_partkey) AS lines FROM lineitem GROUP BY 1),
f AS (SELECT *, list_transform(list_filter(lines, lambda x: x.quantity > 30), lambda x: {'twice': x.quantity * 2, 'no': x.no}) AS large FROM o)
SELECT l_orderkey, len(lines) AS n, coalesce(list_sum(list_transform(large, lambda x: x.twice)), 0)::BIGINT AS large_twice, array_to_string(list_transform(large, lambda x: x.no::VARCHAR), ',') AS large_numbers,
coalesce(list_filter(lines, lambda x: x.quantity > 40)[1].no, lines[1].no) AS first_no, len(list_filter(lines, lambda x: x.quantity = 50)) > 0 AS any_full FROM f"""


def text_blocks(spark, sf_dir):
    """A text split before lines that begin with a capital letter; marks tidied, boilerplate lines out, cut to 80."""
    tidy = F.regexp_replace(F.regexp_replace(F.col("text"), r" +([,.;:!?])", "$1"), r"--+", "-")
    blocks = F.split(tidy, r"\n(?=[A-Z])")
    kept = F.filter(blocks, lambda b: ~b.rlike(r"(?i)^(?:share|subscribe|copyright|all rights reserved)"))
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.size(blocks).cast("bigint").alias("n_blocks"), F.size(kept).cast("bigint").alias("n_kept"), F.left(F.try_element_at(kept, F.lit(-1)), F.lit(80)).alias("last_block"))


BLOCKS = r"""WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(text, ' +([,.;:!?])', '\1', 'g'), '--+', '-', 'g') AS tidy FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, string_split(regexp_replace(tidy, '\n([A-Z])', chr(1) || '\1', 'g'), chr(1)) AS blocks FROM t),
k AS (SELECT *, list_filter(blocks, lambda x: NOT regexp_matches(x, '(?i)^(?:share|subscribe|copyright|all rights reserved)')) AS kept FROM b)
SELECT doc_id, len(blocks) AS n_blocks, len(kept) AS n_kept, left(kept[-1], 80) AS last_block FROM k"""


def line_fields(spark, sf_dir):
    """Lines as key and value where a colon stands between, the last of a key wins; all lines joined by bars; control characters out."""
    clean = F.regexp_replace("text", r"[\x00\\]", "")
    lines = F.filter(F.transform(F.split(clean, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    pairs = F.filter(lines, lambda x: x.contains(": "))
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", lines.alias("lines"), pairs.alias("pairs"))
    last = F.try_element_at("pairs", F.lit(-1))
    return d.select("doc_id", F.md5(F.array_join("lines", " | ")).alias("raw"), F.size(F.array_distinct(F.transform("pairs", lambda x: F.split_part(x, F.lit(": "), F.lit(1))))).cast("bigint").alias("n_keys"), F.split_part(last, F.lit(": "), F.lit(2)).alias("last_value"))


FIELDS = r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '[\x00\\]', '', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM documents WHERE text IS NOT NULL),
p AS (SELECT *, list_filter(lines, lambda x: contains(x, ': ')) AS pairs FROM l)
SELECT doc_id, md5(array_to_string(lines, ' | ')) AS raw, len(list_distinct(list_transform(pairs, lambda x: split_part(x, ': ', 1)))) AS n_keys, split_part(pairs[-1], ': ', 2) AS last_value FROM p"""


def merged_props(spark, sf_dir):
    """An event's properties with newer ones on top; empty ones as null; the id in an array rewritten."""
    e = table(spark, sf_dir, "events")
    old = F.coalesce(F.from_json("props", "map<string,bigint>"), F.create_map().cast("map<string,bigint>"))
    new = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("k"), F.lit(-1).cast("bigint"), F.lit("seen"), F.lit(1).cast("bigint"))).otherwise(F.create_map(F.lit("seen"), F.lit(0).cast("bigint")))
    both = records.merged_map(old, new)
    ids = F.transform(F.array(F.concat_ws("-", "event_id", "user_id")), lambda x: F.regexp_replace(x, "^([0-9]+)-([0-9]+)$", "$2/$1"))
    return e.select("event_id", both["k"].alias("k"), both["seen"].alias("seen"), F.size(both).cast("bigint").alias("n_keys"), ids[0].alias("rewritten"))


PROPS = """WITH m AS (SELECT event_id, user_id, json_merge_patch(coalesce(props, '{}'), CASE WHEN event_id % 3 = 0 THEN '{"k": -1, "seen": 1}' ELSE '{"seen": 0}' END) AS j FROM events)
SELECT event_id, (j->>'k')::BIGINT AS k, (j->>'seen')::BIGINT AS seen, len(json_keys(j)) AS n_keys, user_id || '/' || event_id AS rewritten FROM m"""


def record_predicates(spark, sf_dir):
    """Labels cut short, paragraph shapes, codes of a list, ids of a form, list lookup, rows without any name."""
    d = table(spark, sf_dir, "documents").withColumn("label", F.substring_index("text", ".", 1))
    ids = F.array(F.concat_ws("/", F.col("doc_id").cast("string"), F.length("label").cast("string")), F.concat(F.col("doc_id").cast("string"), F.lit("/7-2")))
    known = spark.createDataFrame([("en", "English"), ("fr", "French")], "lang string, language string")
    flags = d.join(F.broadcast(known), "lang", "left").where(F.coalesce("text", "source").isNotNull())  # two rows
    return flags.groupBy("lang").agg(
        F.count_if(records.cut_short(F.col("label"))).alias("cut_short"),
        F.count_if(F.col("label").rlike(r"^\(?[a-z0-9]\)|^[0-9]+\.|^[-*]\s|\n")).alias("paragraphs"),
        F.count_if(F.lower(F.trim("lang")).isin("en", "de")).alias("chosen"),
        F.count_if(records.building_ids(ids)).alias("with_ids"),
        F.max("language").alias("language"),
    )


PREDICATES = r"""WITH d AS (SELECT *, split_part(text, '.', 1) AS label FROM documents WHERE coalesce(text, source) IS NOT NULL)
SELECT lang, count(*) FILTER (regexp_matches(label, '(?i)(?:^|\s)(?:the|a|an|and|or|of|to|in|with|by|de|du|la|le|et|der|die|und|von)\s*$')) AS cut_short,
count(*) FILTER (regexp_matches(label, '^\(?[a-z0-9]\)|^[0-9]+\.|^[-*]\s|\n')) AS paragraphs, count(*) FILTER (lower(trim(lang)) IN ('en', 'de')) AS chosen, count(*) FILTER (label IS NOT NULL) AS with_ids,
max(CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' END) AS language FROM d GROUP BY lang"""


def amounts(spark, sf_dir):
    """Amounts written for people read back; monthly rents half to even; totals, and a fallback in millions."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.floor("c_acctbal").cast("bigint").alias("whole"))
    price = F.concat(F.lit("Frs "), F.regexp_replace(F.abs("whole").cast("string"), r"(\d)(\d{3})$", "$1'$2"), F.lit(".--"))
    digits = records.price_digits(price)
    return c.select("c_custkey", digits.alias("price"), records.grouped_int(F.regexp_replace(price, r"^Frs |\.--$", "")).alias("number"), F.bround(F.col("whole") / 8, 0).cast("bigint").alias("rent"), records.fallback_amount(F.when(F.col("whole") > 0, F.col("whole")), F.col("c_custkey")).alias("worth"), (digits.cast("bigint") + F.regexp_extract(price, r"(\d+)\.--", 1).cast("bigint")).alias("total"))


AMOUNTS = r"""WITH c AS (SELECT c_custkey, floor(c_acctbal)::BIGINT AS whole FROM customer)
SELECT c_custkey, abs(whole)::VARCHAR AS price, abs(whole) AS number, round_even(whole / 8, 0)::BIGINT AS rent, CASE WHEN whole > 0 THEN whole ELSE c_custkey * 1000000 END AS worth,
abs(whole) + abs(whole) % 1000 AS total FROM c"""


def date_labels(spark, sf_dir):
    """Date parts, minute labels and ISO weeks of orders, counted by week."""
    o = table(spark, sf_dir, "orders").withColumn("stamp", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).withColumn("iso", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return o.groupBy(records.week_label(F.col("o_orderdate")).alias("week")).agg(F.count("*").alias("n"), F.min(records.date_part(F.col("stamp"))).alias("first_day"), F.max(records.minute_label(F.col("iso"))).alias("last_minute"), F.count_if(records.minute_label(F.col("stamp")) == F.col("stamp")).alias("unchanged"))


DATES = """SELECT strftime(o_orderdate, '%G-W%V') AS week, count(*) AS n, min(strftime(o_orderdate, '%Y-%m-%d')) AS first_day, max(strftime(o_orderdate, '%Y-%m-%d, %H:%M')) AS last_minute, count(*) AS unchanged FROM orders GROUP BY 1"""


def classified_orders(spark, sf_dir):
    """Status, grade and language by ordered rules; tiered gates; the first list that is long enough."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "granted").when(F.col("o_orderstatus") == "O", "pending").otherwise(F.lower("o_orderstatus"))
    grade = F.when(F.col("o_orderpriority").rlike("URGENT|HIGH"), "full").when(F.col("o_orderpriority").rlike("MEDIUM"), "part").otherwise("open")
    score = (F.col("o_orderkey") % 100) / 100.0
    kind = F.when(F.col("o_orderkey") % 2 == 0, "map").otherwise("maybe")
    words, letters = F.split("o_orderpriority", " "), F.array_compact(F.split("o_orderpriority", "-"))
    picked = records.cascade(words, letters, least=2)
    language = F.coalesce(F.when(F.col("o_custkey") % 5 == 0, "it"), F.when(F.col("o_custkey") % 3 == 0, "fr"), F.lit("de"))
    return o.groupBy(status.alias("status"), grade.alias("grade"), language.alias("language")).agg(F.count("*").alias("n"), F.count_if(records.tiered_gate(kind, score) == "ok").alias("ok"), F.sum(F.coalesce(F.size(picked), F.lit(0)).cast("bigint")).alias("parts"))


CLASSIFIED = """SELECT CASE o_orderstatus WHEN 'F' THEN 'granted' WHEN 'O' THEN 'pending' ELSE lower(o_orderstatus) END AS status, CASE WHEN regexp_matches(o_orderpriority, 'URGENT|HIGH') THEN 'full' WHEN regexp_matches(o_orderpriority, 'MEDIUM') THEN 'part' ELSE 'open' END AS grade,
coalesce(CASE WHEN o_custkey % 5 = 0 THEN 'it' END, CASE WHEN o_custkey % 3 = 0 THEN 'fr' END, 'de') AS language, count(*) AS n,
count(*) FILTER ((o_orderkey % 100) / 100.0 >= CASE WHEN o_orderkey % 2 = 0 THEN 0.8 ELSE 0.85 END) AS ok,
sum(CASE WHEN len(string_split(o_orderpriority, ' ')) >= 2 THEN len(string_split(o_orderpriority, ' ')) WHEN len(string_split(o_orderpriority, '-')) >= 2 THEN len(string_split(o_orderpriority, '-')) ELSE 0 END)::BIGINT AS parts FROM orders GROUP BY 1, 2, 3"""


def refresh_gates(spark, sf_dir):
    """What a customer's reload needs: counts before and after, equal revisions skipped, newer or unknown dates loaded, pending ones resumed."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 4 <> 0").groupBy("o_custkey").agg(F.count("*").alias("before"), F.max("o_orderdate").alias("seen"), F.max("o_orderkey").alias("old_revision"))
    new = o.groupBy("o_custkey").agg(F.count("*").alias("after"), F.max("o_orderdate").alias("modified"), F.max("o_orderkey").alias("revision"), F.count_if(F.col("o_orderstatus") == "O").alias("pending"))
    j = new.join(old, "o_custkey", "left")
    fresh = F.col("seen").isNull() | (F.col("modified") > F.col("seen"))
    return j.select("o_custkey", (F.col("after") - F.coalesce("before", F.lit(0))).alias("delta"), F.coalesce(F.col("before") == F.col("after"), F.lit(False)).alias("same_count"), fresh.alias("is_fresh"), F.col("old_revision").eqNullSafe(F.col("revision")).alias("skip"), "pending")


GATES = """WITH old AS (SELECT o_custkey, count(*) AS b, max(o_orderdate) AS seen, max(o_orderkey) AS rev FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1),
new AS (SELECT o_custkey, count(*) AS a, max(o_orderdate) AS modified, max(o_orderkey) AS rev, count(*) FILTER (o_orderstatus = 'O') AS pending FROM orders GROUP BY 1)
SELECT o_custkey, a - coalesce(b, 0) AS delta, coalesce(a = b, false) AS same_count, seen IS NULL OR modified > seen AS is_fresh, old.rev IS NOT DISTINCT FROM new.rev AS skip, pending FROM new LEFT JOIN old USING (o_custkey)"""


def soft_hide(spark, sf_dir):
    """I8: customers without an order in the newest year are hidden, not deleted; those who moved get the new nation."""
    newest = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_seen"))
    seen = newest.where(F.year("last_seen") >= 1998).select(F.col("o_custkey").alias("c_custkey"), (F.col("o_custkey") % 25).cast("int").alias("new_nation"))
    j = table(spark, sf_dir, "customer").join(seen, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("new_nation", "c_nationkey").alias("nation"), F.col("new_nation").isNull().alias("hidden"), F.coalesce(F.col("new_nation") != F.col("c_nationkey"), F.lit(False)).alias("moved"))


HIDE = """WITH seen AS (SELECT o_custkey AS c_custkey, (o_custkey % 25)::INTEGER AS new_nation FROM orders GROUP BY o_custkey HAVING year(max(o_orderdate)) >= 1998)
SELECT c_custkey, coalesce(new_nation, c_nationkey) AS nation, new_nation IS NULL AS hidden, coalesce(new_nation <> c_nationkey, false) AS moved FROM customer LEFT JOIN seen USING (c_custkey)"""


def one_pending(spark, sf_dir):
    """At most one pending order a customer, the newest; ids from the place within the customer; a log state for each."""
    o = table(spark, sf_dir, "orders")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    back = F.row_number().over(Window.partitionBy("o_custkey", "o_orderstatus").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")))
    numbered = o.select("o_orderkey", "o_orderstatus", F.concat_ws("-", "o_custkey", place.cast("string")).alias("id"), back.alias("back"))
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    return numbered.where("o_orderstatus <> 'O' OR back = 1").select("o_orderkey", "id", state.alias("state"))


PENDING = """WITH n AS (SELECT o_orderkey, o_orderstatus, o_custkey || '-' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS id,
row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS back FROM orders)
SELECT o_orderkey, id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS state FROM n WHERE o_orderstatus <> 'O' OR back = 1"""


QUERIES = {
    "language_columns": (language_columns, LANGUAGES),
    "first_source_wins": (first_source_wins, FIRST_SOURCE),
    "nested_lines": (nested_lines, NESTED),
    "text_blocks": (text_blocks, BLOCKS),
    "line_fields": (line_fields, FIELDS),
    "merged_props": (merged_props, PROPS),
    "record_predicates": (record_predicates, PREDICATES),
    "amounts": (amounts, AMOUNTS),
    "date_labels": (date_labels, DATES),
    "classified_orders": (classified_orders, CLASSIFIED),
    "refresh_gates": (refresh_gates, GATES),
    "soft_hide": (soft_hide, HIDE),
    "one_pending": (one_pending, PENDING),
}
