"""Column functions for text cleaning (S1-S37). All are built-in expressions; none needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a text, including the no-break space.
EDGE_SPACE = r"^[\s ]+|[\s ]+$"
# Latin letters with marks and what they fold to, in the same order.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def empty_to_null(x: Column) -> Column:
    """Trim all white space; empty becomes null."""
    return F.nullif(F.regexp_replace(x, EDGE_SPACE, ""), F.lit(""))


def clean(x: Column) -> Column:
    """:func:`empty_to_null`, and dashes and N/A become null too."""
    kept = empty_to_null(x)
    return F.when(kept.isin("—", "-", "N/A"), F.lit(None)).otherwise(kept)


def collapse(x: Column) -> Column:
    """Runs of white space become one space; empty becomes null."""
    return empty_to_null(F.regexp_replace(x, r"\s+", " "))


def strip_accents(x: Column) -> Column:
    """Latin letters without their marks."""
    return F.translate(x, ACCENTED, PLAIN)


def slugify(x: Column, separator: str = "_", most: int | None = None) -> Column:
    """Accent-free lower-case slug, 'unknown' if nothing is left."""
    slug = F.regexp_replace(F.lower(strip_accents(x)), "[^a-z0-9]+", separator)
    slug = F.regexp_replace(slug, f"^{separator}+|{separator}+$", "")
    slug = F.left(slug, F.lit(most)) if most else slug
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown"))


def tokens_kept(x: Column, stop: list[str]) -> Column:
    """Lower-case tokens without stop words, digits and single letters, joined by spaces."""
    words = F.split(F.lower(strip_accents(x)), "[^a-z]+")
    return F.array_join(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(stop)), " ")


def strip_html(x: Column) -> Column:
    """Tags to '. ', entities decoded, white space collapsed."""
    return collapse(decode_entities(F.regexp_replace(x, r"<[^>]+>", ". ")))


def decode_entities(x: Column) -> Column:
    """The six common entities; the ampersand last, so that nothing is decoded twice."""
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(plain))
    return x


def html_to_text(x: Column) -> Column:
    """Line breaks for br and block ends, a dash for list items, other tags gone, two line breaks at most."""
    x = F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")
    x = F.regexp_replace(x, r"(?i)</(p|div|h[1-6]|tr)>", "\n\n")
    x = F.regexp_replace(x, r"(?i)<li[^>]*>", "- ")
    x = decode_entities(F.regexp_replace(x, r"<[^>]+>", ""))
    return empty_to_null(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def html_segments(x: Column) -> Column:
    """Non-empty text segments between tags."""
    return F.filter(F.transform(F.split(x, r"<[^>]+>"), lambda s: F.regexp_replace(s, EDGE_SPACE, "")), lambda s: s != "")


def html_to_markdown(x: Column) -> Column:
    """Headings 1 to 4, paragraphs and line breaks as Markdown."""
    for level in range(1, 5):
        x = F.regexp_replace(x, rf"(?is)<h{level}[^>]*>(.*?)</h{level}>", "\n\n" + "#" * level + " $1\n\n")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)<br\s*/?>", "\n"), r"(?i)</?p[^>]*>", "\n\n")
    return empty_to_null(F.regexp_replace(decode_entities(F.regexp_replace(x, r"<[^>]+>", "")), r"\n{3,}", "\n\n"))


def word_count(x: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))


def reading_minutes(x: Column, pace: int = 200) -> Column:
    """Minutes at ``pace`` words, rounded up."""
    return F.ceil(word_count(x) / pace)


def clean_label(x: Column) -> Column:
    """Without bullets and dashes at the ends."""
    return empty_to_null(F.regexp_replace(x, r"^[\s•·*–—-]+|[\s•·*–—-]+$", ""))


def pick_language(texts: Column, *order: str) -> Column:
    """The first language of ``order`` that a map has, else any value."""
    return F.coalesce(*[F.try_element_at(texts, F.lit(k)) for k in order], F.try_element_at(F.map_values(texts), F.lit(1)))


def between(x: Column, start: str, end: str) -> Column:
    """Text between two marks, null if either is absent."""
    import re

    return F.nullif(F.regexp_extract(x, rf"(?s){re.escape(start)}(.*?){re.escape(end)}", 1), F.lit(""))


def count_names(x: Column, joiners: str = r"\s+et\s+|\s+und\s+|,") -> Column:
    """Names in a list, one at least."""
    return F.greatest(F.lit(1), F.size(F.filter(F.split(x, joiners), lambda p: F.trim(p) != "")))


def format_uid(x: Column) -> Column:
    """Nine digits as CHE-ddd.ddd.ddd, anything shorter as it is."""
    d = F.regexp_replace(x, "[^0-9]", "")
    uid = F.concat(F.lit("CHE-"), F.substring(d, 1, 3), F.lit("."), F.substring(d, 4, 3), F.lit("."), F.substring(d, 7, 3))
    return F.when(F.length(d) >= 9, uid).otherwise(x)


def normalize_phone(x: Column) -> Column:
    """Digits with the country code in front, or null outside 10 to 15 digits."""
    d = F.regexp_replace(F.regexp_replace(x, r"\.0$", ""), "[^0-9]", "")
    d = F.when(d.startswith("0041"), F.substring(d, 3, 99)).when(d.startswith("00"), F.substring(d, 3, 99)).otherwise(d)
    d = F.when((F.length(d) == 10) & d.startswith("0"), F.concat(F.lit("41"), F.substring(d, 2, 99))).otherwise(d)
    d = F.when(d.startswith("41") & (F.length(d) > 11), F.left(d, F.lit(11))).otherwise(d)
    return F.when(F.length(d).between(10, 15), d)


def content_hash(*columns: Column) -> Column:
    """SHA-256 over values with a separator that keeps nulls apart from empty."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256)


def sections(*titled: tuple[str, Column]) -> Column:
    """'## title' and body of each section that has one, joined by empty lines."""
    return F.concat_ws("\n\n", *[F.when(empty_to_null(body).isNotNull(), F.concat(F.lit(f"## {title}\n\n"), body)) for title, body in titled])


def file_name(*parts: Column, url: Column) -> Column:
    """Slugs joined by dashes with the URL's extension, jpg if it has none."""
    extension = F.coalesce(F.nullif(F.regexp_extract(url, r"\.([a-zA-Z0-9]{2,4})(?:\?|$)", 1), F.lit("")), F.lit("jpg"))
    return F.concat(F.concat_ws("-", *[slugify(p, "-") for p in parts]), F.lit("."), F.lower(extension))


def absolute_url(x: Column, base: str) -> Column:
    """Relative addresses below ``base``."""
    return F.when(x.rlike(r"^https?://"), x).when(x.startswith("//"), F.concat(F.lit("https:"), x)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(x, "^/+", "")))


def house_style(html: Column, dropped_domains: tuple[str, ...] = ()) -> Column:
    """Dashes, blanks before punctuation and amounts as the house writes them; links to some domains lose their tag, other outer ones open a new page.

    ``1'500 francs`` becomes ``CHF 1'500.-`` and ``12.50 CHF`` becomes ``CHF 12.50``.
    """
    x = F.replace(F.replace(html, F.lit("—"), F.lit(" - ")), F.lit("–"), F.lit("-"))
    x = F.regexp_replace(x, r"[\s ]+([;:!?])", "$1")
    # a mark behind amounts with a fraction keeps the second rule off them
    x = F.regexp_replace(F.translate(x, "\u0001", ""), r"(?i)([0-9][0-9']*\.[0-9]{2})[\s ]*(?:CHF|francs?)", "CHF $1\u0001")
    x = F.regexp_replace(x, r"(?i)([0-9][0-9']*)[\s ]*(?:CHF|francs?)", "CHF $1.-")
    x = F.regexp_replace(F.translate(x, "\u0001", ""), "  +", " ")
    x = F.regexp_replace(x, EDGE_SPACE, "")
    for domain in dropped_domains:
        host = domain.replace(".", r"\.")
        x = F.regexp_replace(x, rf'(?i)<a\s[^>]*href="[^"]*{host}[^"]*"[^>]*>(.*?)</a>', "$1")
    return F.regexp_replace(x, r'(?i)<a\s+(href="https?://[^"]*")', '<a $1 target="_blank" rel="noopener"')


def without_phrases(x: Column, site: str) -> Column:
    """A description without a site's own phrases, links to it and notes on visits; at most one blank line in a row; nothing left is null."""
    # The phrases, with the site's name as a parameter.
    phrases = (
        rf"Dis[- ]?moi que tu m[''’]as vue? sur {site}\s*!?",
        rf"Tell me that you saw me on {site}\s*!?",
        rf"Dime que me viste en {site}\s*!?",
        rf"Oui,?\s*je suis sur {site} et j[''’]aime [çc]a\s*!?",
        rf"Invitez[- ]moi [àa] vous rendre visite [àa] {site}\s*!?",
        r"Pour voir mes photos non censur[ée]es\s*:?\s*",
        rf"https?://(?:www\.)?{site}\.ch/ad/[^\s)}}\]\"]*",
        r"Incall\s*:?\s*Je re[çc]ois en (?:appartement priv[ée]|salon)\.?\s*",
        r"Incall\s*:?\s*Recibo en apartamento privado\.?\s*[¡!]?\s*",
        r"Outcall\s*:?\s*Je (?:peux me d[ée]placer|ne me d[ée]place pas)\.?\s*",
    )
    for phrase in phrases:
        x = F.regexp_replace(x, f"(?iu){phrase}", "")
    return F.nullif(F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), EDGE_SPACE, ""), F.lit(""))
