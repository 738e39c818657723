"""Column functions over nested records, labels and amounts as strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def find_first(items: Column, test: Callable[[Column], Column]) -> Column:
    """First element that passes, else the first of all (M6)."""
    return F.coalesce(F.try_element_at(F.filter(items, test), F.lit(1)), F.try_element_at(items, F.lit(1)))


def merged_map(old: Column, new: Column) -> Column:
    """Entries of both maps; those of ``new`` win (M8)."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def cut_short(label: Column) -> Column:
    """True for a label that ends with a word which needs another behind it."""
    return label.rlike(r"(?i)(?:^|\s)(?:the|a|an|and|or|of|to|in|with|by|de|du|la|le|et|der|die|und|von)\s*$")


def building_ids(ids: Column) -> Column:
    """True if there are ids and all look like ``12/34`` or ``12/34-5``."""
    return (F.size(ids) > 0) & F.forall(ids, lambda x: x.rlike(r"^[0-9]+/[0-9]+(?:-[0-9]+)?$"))


def price_digits(price: Column) -> Column:
    """``Frs 1'234.--`` as ``1234``: digits before the first stop; nothing left is ``0``."""
    digits = F.regexp_replace(F.split_part(price, F.lit("."), F.lit(1)), "[^0-9]", "")
    return F.coalesce(F.nullif(digits, F.lit("")), F.lit("0"))


def grouped_int(number: Column) -> Column:
    """Integer of a text with thousands marks and blanks; a fraction is cut."""
    return F.regexp_replace(number, "['\\s]", "").try_cast("double").cast("bigint")


def week_label(day: Column) -> Column:
    """ISO year and week as ``2024-W07``."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def date_part(stamp: Column) -> Column:
    """What stands before the first blank."""
    return F.split_part(stamp, F.lit(" "), F.lit(1))


def minute_label(stamp: Column) -> Column:
    """An ISO timestamp as ``YYYY-MM-DD, HH:MM``; anything else as it is."""
    return F.when(stamp.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), F.concat(F.substring(stamp, 1, 10), F.lit(", "), F.substring(stamp, 12, 5))).otherwise(stamp)


def fallback_amount(amount: Column, millions: Column) -> Column:
    """The amount, or where it is missing or 0 the one in millions."""
    return F.coalesce(F.nullif(amount, F.lit(0)), F.coalesce(millions, F.lit(0)) * 1_000_000)


def tiered_gate(kind: Column, confidence: Column) -> Column:
    """``ok`` from 0.8 for maps and 0.85 for maybes, else ``low_confidence``."""
    least = F.when(kind == "map", 0.8).otherwise(0.85)
    return F.when(confidence >= least, "ok").otherwise("low_confidence")


def cascade(*found: Column, least: int = 3) -> Column:
    """The first list with ``least`` entries, else null."""
    out = F.lit(None)
    for items in reversed(found):
        out = F.when(F.size(items) >= least, items).otherwise(out)
    return out


#: Codes of the cantons, and words and cities that name the country.
CANTONS = "ZH|BE|LU|UR|SZ|OW|NW|GL|ZG|FR|SO|BS|BL|SH|AR|AI|SG|GR|AG|TG|TI|VD|VS|NE|GE|JU"
COUNTRY = "switzerland|suisse|schweiz|svizzera"
CITIES = "zürich|genève|geneva|basel|lausanne|bern|winterthur|luzern|lugano"


def swiss_place(place: Column) -> Column:
    """True where a place names the country, a canton in brackets or behind a comma, a large city, or a postal code."""
    postal = F.regexp_extract(place, r"\b([0-9]{4})\b", 1).try_cast("int")
    named = place.rlike(rf"(?i)\b(?:{COUNTRY})\b") | place.rlike(rf"(?:\(|, )(?:{CANTONS})\b") | place.rlike(rf"(?i)\b(?:{CITIES})\b")
    return F.coalesce(named | postal.between(1000, 9658), F.lit(False))


def balanced_json(text: Column, marker: str) -> Column:
    """The object that opens behind ``marker``, to its matching brace; braces in strings don't count.

    Null without the marker, without a brace behind it, or if the object never ends.
    """
    behind = F.when(F.instr(text, marker) > 0, F.substring_index(text, marker, -1))
    behind = F.when(F.instr(behind, "{") > 0, F.substr(behind, F.instr(behind, "{")))
    tokens = F.regexp_extract_all(behind, F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}]|[^"{}]+|")'), F.lit(1))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"))

    def step(state: Column, token: Column) -> Column:
        ended = (state["length"] > 0) & (state["depth"] == 0)
        depth = state["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        return F.when(ended, state).otherwise(F.struct(depth.alias("depth"), (state["length"] + F.length(token)).alias("length")))

    end = F.aggregate(tokens, start, step)
    return F.when(end["depth"] == 0, F.substr(behind, F.lit(1), end["length"]))


def snake(name: Column) -> Column:
    """``shipMode`` as ``ship_mode`` (P10)."""
    return F.lower(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"))


def snake_keys(json: Column) -> Column:
    """JSON text with the keys of all levels as snake case; values stay."""
    tokens = F.regexp_extract_all(json, F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:?|[^"]+)'), F.lit(1))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.startswith('"') & t.endswith(":"), snake(t)).otherwise(t)), "")


def known(value: Column, *sentinels: str) -> Column:
    """Null for a text that only says that nothing is known."""
    return F.when(~F.trim(value).isin(*sentinels), value)


def html_lines(html: Column) -> Column:
    """Lines between line breaks without tags, with the common references read, trimmed; empty ones go."""

    def line(x: Column) -> Column:
        x = F.regexp_replace(x, "<[^>]+>", "")
        for pattern, plain in (("&nbsp;?", " "), ("&amp;", "&"), ("&#x27;|&apos;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
            x = F.regexp_replace(x, pattern, plain)
        return F.trim(x)

    return F.filter(F.transform(F.split(html, r"(?i)<br\s*/?>"), line), lambda x: x != "")


def key_values(lines: Column, mark: str = ":") -> Column:
    """A map of the lines that hold ``mark``: what stands before its first one, and behind, both trimmed; a key or value that is empty goes; the last of a key wins."""
    pairs = F.transform(F.filter(lines, lambda x: x.contains(mark)), lambda x: F.struct(F.trim(F.substring_index(x, mark, 1)).alias("key"), F.trim(F.substr(x, F.instr(x, mark) + F.lit(len(mark)))).alias("value")))
    kept = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    later = lambda all_, i: F.transform(F.slice(all_, i + 2, F.size(all_)), lambda p: p["key"])
    lasts = F.transform(F.array(kept), lambda all_: F.filter(all_, lambda p, i: ~F.array_contains(later(all_, i), p["key"])))[0]
    return F.map_from_entries(lasts)


def sections(text: Column, header: str) -> Column:
    """``(place, header, body)`` of each header in a text: the body goes to the next one; what stands before the first has place 0 and no header.

    Headers and bodies come from one pattern, which must not match the empty text; row by row, without a shuffle.
    """
    heads = F.regexp_extract_all(text, F.lit(f"({header})"), F.lit(1))
    bodies = F.split(text, header)
    return F.transform(bodies, lambda body, i: F.struct(i.cast("bigint").alias("place"), F.when(i > 0, F.get(heads, i - 1)).alias("header"), body.alias("body")))


def flat_labels(document: Column) -> Column:
    """``{language: {"value": text}}`` as a map of language to text; entries without a text go, nothing left is an empty map (M5)."""
    parsed = F.from_json(document, "map<string, struct<value: string>>")
    found = F.map_filter(F.transform_values(parsed, lambda _, v: v["value"]), lambda _, v: v.isNotNull())
    return F.coalesce(found, F.create_map().cast("map<string, string>"))


def split_building_ids(document: Column) -> Column:
    """A JSON list with ids ``12/34-5`` as ``12/34``, and ``5`` as a sheet number of their object; anything but a list stays as it is (M7)."""
    items = F.try_variant_get(F.try_parse_json(document), "$", "array<map<string, variant>>")

    def rewritten(item: Column) -> Column:
        ref = F.try_variant_get(F.try_element_at(item, F.lit("building_id")), "$", "string")
        parts = lambda group: F.regexp_extract(ref, r"^([0-9]+/[0-9]+)-([0-9]+)\z", group).cast("variant")
        new = F.map_from_arrays(F.array(F.lit("building_id"), F.lit("feuillet_number")), F.array(parts(1), parts(2)))
        return F.when(ref.rlike(r"^[0-9]+/[0-9]+-[0-9]+\z"), merged_map(item, new)).otherwise(item)

    return F.when(items.isNotNull(), F.to_json(F.transform(items, rewritten))).otherwise(document)


def by_language(items: Column, language: str) -> Column:
    """The text of the first of ``(language, text)`` in a language, whatever its case; null without one."""
    return F.try_element_at(F.filter(items, lambda x: F.lower(x["language"]) == language.lower()), F.lit(1))["text"]


def tidy_record(document: Column, *listed: str) -> Column:
    """A JSON object without its null keys; of the keys in ``listed`` an empty list or object goes, any other becomes its JSON text.

    Values of other keys keep their kind. Keys come in their own order; what is no object gives null.
    """
    entries = F.map_entries(F.try_variant_get(F.try_parse_json(document), "$", "map<string, variant>"))
    nested = lambda e: e["key"].isin(*listed) & F.to_json(e["value"]).rlike(r"^[\[{]")
    blank = lambda e: F.is_variant_null(e["value"]) | (nested(e) & F.to_json(e["value"]).isin("[]", "{}"))
    text = lambda e: F.when(nested(e), F.to_json(e["value"]).cast("variant")).otherwise(e["value"])
    kept = F.transform(F.filter(entries, lambda e: ~blank(e)), lambda e: F.struct(e["key"].alias("key"), text(e).alias("value")))
    return F.to_json(F.map_from_entries(kept))
