"""Main text of web pages by consensus host paths (op 6).

First pass: each page scores its containers (text of blocks outside links, halved per level up) and names
the generalised path (tags with classes, digits made equal) of its best. Spark sums these votes per host
and path, and joins a page's own container paths to all votes of its host. Second pass: a page takes its
containers at the path with the best product of its own score and the logarithm of the votes, or at a path
below that one which scores more on the page (so a general path doesn't stand for a layout's own).
Inside a container, menus, asides, footers, forms, notices, adverts and reader comments are left out, inline ones too.

A null or empty page has an empty text. A page that ends early is read to its end. Repeated rows are read each for
itself, but vote twice. Pages without a host vote together. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import few, materialize

#: Every loop is possessive and every markup may end with the page, so that reading takes time in proportion to the page. A quote opens a value behind ``=`` only.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"?|'[^']*+'?|[^\s>]++))?")
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "canvas"}
LEFT_OUT = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
BLOCKS = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "aside", "dialog", "menu"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES_P = BLOCKS - {"td", "th", "tr"}
BAD_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "replies", "respond", "sidebar", "signup", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget", "masthead", "reactions", "login"}
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "dialog", "form", "menu"}
WORDS = re.compile(r"[a-z]+|[0-9]+")
#: What may stand behind a bad word in a name of several words: ``sidebar-left`` is a sidebar, ``header-files`` isn't a header.
PLACES = {"area", "bar", "block", "bottom", "box", "button", "column", "container", "content", "footer", "form", "group", "holder", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "panel", "primary", "region", "right", "secondary", "section", "slot", "text", "title", "top", "unit", "widgets", "wrap", "wrapper"}
#: Names with these words say what a page has or lacks, not what the element is.
ABOUT = {"has", "hide", "is", "no", "non", "not", "show", "with", "without"}
#: Inline elements are left out by these words alone, or by their tag.
ADVERTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "promotion", "sponsor", "sponsored"}
INLINE_OUT = {"button", "select"}


class Element:
    """An open tag. ``path`` names its container and those around it, as a digest of the steps, so that depth costs nothing."""

    __slots__ = ("tag", "path", "out", "score", "parent", "holder", "depth")

    def __init__(self, tag: str, step: str, out: bool, parent):
        self.tag, self.out, self.parent, self.score = tag, out, parent, 0.0
        if parent is None:
            self.path, self.holder, self.depth = "", self, 0
        elif tag in CONTAINERS:
            self.path = hashlib.blake2b(f"{parent.path}/{step}".encode("utf-8", "replace"), digest_size=12).hexdigest()
            self.holder, self.depth = self, parent.holder.depth + 1
        else:
            self.path, self.holder, self.depth = parent.path, parent.holder, parent.holder.depth


def attributes(text: str) -> dict[str, str]:
    """The attributes that are looked at; the first of a name counts."""
    found: dict[str, str] = {}
    if "class" in text or "id" in text or "role" in text or "CLASS" in text or "ID" in text or "ROLE" in text:
        for name, value in ATTRIBUTE.findall(text):
            if name.lower() in ("class", "id", "role"):
                found.setdefault(name.lower(), value.strip("\"'"))
    return found


def left_out(tag: str, found: dict[str, str], inside_main: bool) -> bool:
    """True for parts that are never main text; a header counts as one outside articles only."""
    if tag in LEFT_OUT or tag == "header" and not inside_main:
        return True
    if found.get("role", "").lower() in BAD_ROLES:
        return True
    if tag in ("body", "html", "main", "article", "h1", "h2"):
        return False
    return any(named(found.get(name, ""), BAD_WORDS) for name in ("class", "id"))


def named(value: str, bad: set[str]) -> bool:
    """True if a name of the attribute is a bad word, ends with one, or begins with one and goes on with a place or number."""
    for name in value.lower().split():
        words = WORDS.findall(name)
        if words and not ABOUT.intersection(words):
            tail = [w for w in words if not w.isdigit()] or [""]
            if tail[-1] in bad or tail[0] in bad and all(w in bad or w in PLACES for w in tail[1:]):
                return True
    return False


def inline_out(tag: str, found: dict[str, str]) -> bool:
    """True for inline elements that are never main text: controls and adverts."""
    return tag in INLINE_OUT or any(named(found.get(name, ""), ADVERTS) for name in ("class", "id"))


def blocks_of(page: str) -> list[tuple[str, Element, int]]:
    """Text blocks in page order, each with its nearest container and the length of its link text."""
    root = Element("", "", False, None)
    stack, blocks, text, links = [root], [], [], 0
    place, in_link, is_open = 0, 0, Counter()  # how often each tag is open

    def close(tag: str) -> None:
        while True:
            gone = stack.pop().tag
            is_open[gone] -= 1
            if gone == tag:
                return

    def flush() -> None:
        nonlocal links
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            blocks.append((joined, stack[-1].holder, min(links, len(joined))))
        text.clear()
        links = 0

    while True:
        m = TOKEN.search(page, place)
        chunk = page[place : m.start() if m else len(page)]
        if chunk and not stack[-1].out:
            text.append(chunk)
            links += len(chunk) if in_link else 0
        if not m:
            break
        place = m.end()
        if m.group(2) is None:
            continue
        tag, closing = m.group(2).lower(), m.group(1)
        if not closing and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            place = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if tag in ("td", "th", "img"):
            text.append(" ")
        if closing:
            in_link = 0 if tag == "a" else in_link
            if is_open[tag]:
                close(tag)
            continue
        if tag in VOID:
            continue
        if tag == "a":
            in_link = 1
        if tag in CLOSES_P and any(e.tag == "p" for e in stack[-6:]):
            close("p")
        if tag == "li" and stack[-1].tag == "li":
            close("li")
        parent, found = stack[-1], attributes(m.group(3))
        inline = tag not in BLOCKS and tag != "span"
        if inline and not parent.out and not inline_out(tag, found):  # inline elements don't hold blocks together
            continue
        out = parent.out or inline or left_out(tag, found, is_open["article"] + is_open["main"] > 0)
        name = tag + "".join("." + re.sub("[0-9]+", "0", c) for c in sorted(found.get("class", "").split()))
        stack.append(Element(tag, name, out, parent))
        is_open[tag] += 1
    flush()
    return blocks


def scored_containers(blocks: list[tuple[str, Element, int]]) -> list[Element]:
    """Containers by the text outside links that their blocks hold; a level up counts half."""
    scored: dict[int, Element] = {}
    for text, holder, links in blocks:
        worth, node = max(0.0, len(text) - 2.0 * links) * (1.0 if len(text) >= 25 else 0.3), holder
        while node is not None and worth > 0.5:
            node.score += worth * (1.2 if node.tag in ("article", "main") else 1.0)
            scored[id(node)] = node
            node, worth = node.parent and node.parent.holder, worth / 2
    return list(scored.values())


def best_container(scored: list[Element]) -> Element | None:
    return max(scored, key=lambda e: (e.score, -e.depth, e.path), default=None)


def path_scores(scored: list[Element]) -> dict[str, float]:
    """Summed scores of the containers at each path."""
    out: dict[str, float] = {}
    for e in scored:
        if e.tag in CONTAINERS:
            out[e.path] = out.get(e.path, 0.0) + e.score
    return out


def inside(blocks: list[tuple[str, Element, int]], path: str) -> dict[int, bool]:
    """For each block's holder and those above it: whether it lies at ``path`` or below; each is looked at once."""
    known: dict[int, bool] = {}
    for _, node, _ in blocks:
        way = []
        while node is not None and id(node) not in known and not (node.path == path and node.tag in CONTAINERS):
            way.append(node)
            node = node.parent and node.parent.holder
        found = node is not None and (known[id(node)] if id(node) in known else True)
        known.update((id(n), found) for n in way)
        if node is not None:
            known[id(node)] = found
    return known


def chosen_path(scored: list[Element], blocks: list[tuple[str, Element, int]], votes: dict[str, int]) -> str | None:
    """The path to take on a page, of those that its host's pages voted for."""
    scores, depth = path_scores(scored), {e.path: e.depth for e in scored}
    voted = [p for p in scores if votes.get(p)]
    if not voted:
        return None
    path = max(voted, key=lambda p: (scores[p] * math.log1p(votes[p]), scores[p], depth[p], p))
    under = inside(blocks, path)
    below = {e.path for e in scored if under.get(id(e)) and votes.get(e.path) and scores.get(e.path, 0.0) > scores[path]}
    return max(below, key=lambda p: (scores[p], depth[p], p), default=path)


def main_text(page: str | None, votes: dict[str, int]) -> str:
    """Blocks at the chosen path, joined by empty lines."""
    blocks = blocks_of(page or "")
    scored = scored_containers(blocks)
    path = chosen_path(scored, blocks, votes)
    if path is None:
        best = best_container(scored)
        path = best.path if best is not None else None
    if path is None:
        return ""
    under = inside(blocks, path)
    return "\n\n".join(t for t, holder, _ in blocks if under[id(holder)])


def extract(pages: DataFrame, html_column: str = "html", url_column: str = "url", id_column: str = "page_id") -> DataFrame:
    """``(id, url, text)`` a row."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_column), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))

    # pages of one host with equal text have equal containers, so they share a key
    keyed = pages.select(F.col(id_column), F.col(url_column), F.col(html_column), host.alias("host")).withColumn("__key", F.xxhash64("host", html_column))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, own = [], []
            for x in batch.column(2):
                scored = scored_containers(blocks_of(x.as_py() or ""))
                best.append(best_container(scored))
                own.append(list(path_scores(scored)))
            columns = [batch.column(0), batch.column(1), pa.array([b.path if b else None for b in best], pa.string()), pa.array(own, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "host", "path", "own"])

    cast = materialize(keyed.select("__key", "host", html_column).mapInArrow(vote, "key bigint, host string, path string, own array<string>").where("path IS NOT NULL"), "votes")
    counted = materialize(cast.groupBy("host", "path").agg(F.count("*").alias("pages")), "paths")
    own = cast.select("key", "host", F.explode("own").alias("path")).join(few(counted, 200), ["host", "path"])
    lists = materialize(own.groupBy("key").agg(F.collect_set(F.struct("path", "pages")).alias("votes")), "page-paths")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), {v["path"]: v["pages"] for v in votes.as_py() or []}) for page, votes in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_column, url_column, "text"])

    kinds = f"{id_column} {pages.schema[id_column].dataType.simpleString()}, {url_column} {pages.schema[url_column].dataType.simpleString()}, text string"
    joined = keyed.join(few(lists.withColumnRenamed("key", "__key"), 400), "__key", "left")
    return joined.select(id_column, url_column, html_column, "votes").mapInArrow(take, kinds)
