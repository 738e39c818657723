"""Personal data: candidate spans, boosted trees over format and context, calibrated selection (op 10).

Native: everything on the documents is SQL functions. Four base kinds are fixed by pattern and
always stay. Further generators propose more spans (local phone numbers, obfuscated addresses,
bank accounts, social security numbers, addresses of version 6, grouped digits like a card's whose check digit fails);
gradient-boosted trees score them by format and the words before them, and those above
a threshold calibrated on held-out examples are added where they overlap nothing that stays.

The trees are trained here, by numpy on the driver, on a bounded set of ``EXAMPLES`` generated
examples whose features the same SQL expressions make: formats and words before them are drawn apart, so that neither
tells all. They become one Column expression.

Overlaps are settled by windows in text order, whose frames are running or of bounded length: n log n for n spans.

Patterns run over whole texts. They use possessive loops and guards at run starts, so that
very long runs cost neither stack nor quadratic time; their matches are those of the plain patterns.
A null text counts as empty and has no spans. Repeated rows are judged each for itself. Extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("email", "ip", "card", "phone")
LABEL = r"[A-Za-z0-9-]"
#: The base patterns, with guards that only skip starts inside a run that failed at its begin.
BASE = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@{LABEL}++\.{LABEL}(?:{LABEL}|\.(?={LABEL}))*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall generators of further spans.
PROPOSED = {
    "phone_local": r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)|0?[0-9]{2,4})[\x20./-][0-9]{2,4}[\x20./-][0-9]{2,6}(?![0-9A-Za-z])",
    "email_hidden": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)[A-Za-z]{2,24}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card_like": r"(?<![0-9])[0-9]{4}(?:\x20[0-9]{4}){3}(?![0-9])|(?<![0-9])[0-9]{4}(?:-[0-9]{4}){3}(?![0-9])",
    "ipv6": r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){5,7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])",
}
CONTEXT = 24
#: No proposed pattern matches more characters than this.
LONGEST = 256
EXAMPLES = 6000
#: Added spans need this share of true ones among held-out examples at their score and above.
PRECISION = 0.99


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit fits; every second digit from the right counts twice, less nine above nine."""
    turned = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    values = F.transform(turned, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, found: Column) -> Column:
    """The checks of the base kinds; matches that fail are dropped."""
    digits = digits_of(found)
    n = F.length(digits)
    octet = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    card = F.when(n.between(14, 19), luhn(digits)).otherwise(False)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", found.rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))
        .when(kind == "card", card)
        .when(kind == "phone", n.between(10, 15))
        .otherwise(False)
    )


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of ``(kind, gap, before, found)`` in text order: length and end of the stretch before each match."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    return F.zip_with(
        gaps,
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, found: F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.lower(F.right(gap, F.lit(CONTEXT))).alias("before"), found.alias("found")),
    )


def gated(text: Column, kind: str, pattern: str) -> Column:
    """:func:`matches`, but only where a cheap test finds the pattern's rarest character."""
    cheap = {"email": text.contains("@"), "phone": text.contains("+"), "email_hidden": text.rlike(r"[\[({]\x20?at"), "ipv6": text.rlike(r"[0-9a-fA-F]:[0-9a-fA-F]{1,4}:")}
    return F.when(cheap.get(kind, text.rlike("[0-9]")), matches(text, kind, pattern))


FEATURES = ("digits", "letters", "length", "groups", "plus_or_paren", "dots", "spaces", "slashes", "checks", "says_call", "says_mail", "says_bank", "says_id", "says_other", "is_local", "is_hidden", "is_iban", "is_ssn", "is_ipv6", "leading_zero", "says_card", "is_card", "bad_area", "looks_like_date")


def features(kind: Column, found: Column, before: Column) -> list[Column]:
    """The trees' inputs, in the order of :data:`FEATURES`."""
    n = lambda pattern: F.length(F.regexp_replace(found, pattern, ""))
    says = lambda words: before.rlike(rf"(?:{words})[^0-9\n]{{0,12}}$")
    parts = [
        n("[^0-9]"),
        n("[^A-Za-z]"),
        F.length(found),
        F.size(F.split(found, r"[^0-9A-Za-z]+")),
        found.rlike(r"[+(]"),
        n("[^.]"),
        n(r"[^\x20]"),
        n("[^/]"),
        F.length(digits_of(found)).between(10, 15),
        says("call|phone|tel|mobile|fax|dial|cell|rufnummer|téléphone|teléfono|number is"),
        says("mail|contact|write to|reach me|schreib|courriel|correo"),
        says("iban|account|bank|konto|compte|cuenta"),
        says("ssn|social|security|insurance"),
        says("order|invoice|version|page|isbn|date|ref|id|build|on|from|section|part"),
        kind == "phone_local",
        kind == "email_hidden",
        kind == "iban",
        kind == "ssn",
        kind == "ipv6",
        found.rlike(r"^\(?0"),
        says("card|visa|mastercard|credit|karte|carte|tarjeta"),
        kind == "card_like",
        (kind == "ssn") & found.rlike(r"^(?:000|666|9[0-9]{2})-|-00-|-0000$"),
        found.rlike(r"^(?:0?[1-9]|[12][0-9]|3[01])[./-](?:0?[1-9]|1[0-2])[./-](?:19|20)?[0-9]{2}$"),
    ]
    return [p.cast("double") for p in parts]


def examples(spark: SparkSession, n: int = EXAMPLES) -> DataFrame:
    """Generated candidates ``(kind, found, before, label)``: personal data and look-alikes, by fixed hashes.

    Of the true ones, 15 % are without a cue and 5 % behind a word that speaks against them; of the look-alikes, 25 % are
    without a word before them and 0.5 % behind a cue. Half of the look-alikes have a format of true ones.
    """
    h = lambda i, size: F.pmod(F.xxhash64(F.col("id"), F.lit(i)), F.lit(size))
    num = lambda i, width: F.lpad(h(i, 10**width).cast("string"), width, "0")
    pick = lambda i, *words: F.element_at(F.array(*[F.lit(w) for w in words]), (h(i, len(words)) + 1).cast("int"))
    hexa = lambda i: F.lower(F.hex(h(i, 65536)))
    good, alike = h(1, 2) == 1, h(16, 2) == 1
    sep = pick(2, " ", ".", "-", "/")
    number = F.when(h(3, 2) == 0, F.concat(F.lit("("), num(4, 3), F.lit(") "), num(5, 3), F.lit("-"), num(6, 4))).otherwise(F.concat(F.lit("0"), num(4, 2), sep, num(5, 3), sep, num(6, 4)))
    date = F.concat(F.lpad((h(4, 31) + 1).cast("string"), 2, "0"), sep, F.lpad((h(5, 12) + 1).cast("string"), 2, "0"), sep, F.lit("20"), num(6, 2))
    version = F.concat(num(4, 2), F.lit("."), num(5, 2), F.lit("."), num(6, 3))
    words = F.concat(pick(7, "anna.b", "jo_lee", "info", "max.m"), pick(8, " [at] ", "(at)", " {at} "), pick(9, "example", "mail", "post"), pick(10, ".com", " [dot] org", "(dot)net"))
    iban = F.concat(pick(7, "DE", "FR", "GB", "CH"), num(8, 2), F.lit(" "), num(9, 4), F.lit(" "), num(10, 4), F.lit(" "), num(11, 4), F.lit(" "), num(12, 4))
    serial = F.concat(pick(7, "AB", "XZ", "SN"), num(8, 2), num(9, 4), num(10, 4))
    ssn = F.concat(F.lpad((h(7, 665) + 1).cast("string"), 3, "0"), F.lit("-"), F.lpad((h(8, 99) + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((h(9, 9999) + 1).cast("string"), 4, "0"))
    bad_ssn = F.concat(pick(7, "000", "666", "901", "987"), F.lit("-"), num(8, 2), F.lit("-"), num(9, 4))
    fours = [num(9 + i, 4) for i in range(4)]
    card = F.when(h(2, 2) == 0, F.concat_ws(" ", *fours)).otherwise(F.concat_ws("-", *fours))
    six = F.concat_ws(":", *[hexa(20 + i) for i in range(8)])
    clock = F.concat_ws(":", *[num(30 + i, 2) for i in range(6)])
    kind = pick(13, *PROPOSED)
    found = (
        F.when(kind == "phone_local", F.when(good | alike, number).otherwise(F.when(h(17, 2) == 0, date).otherwise(version)))
        .when(kind == "email_hidden", F.when(good | alike, words).otherwise(F.concat(pick(7, "left", "met", "seen"), F.lit(" (at) "), pick(8, "home", "noon"), F.lit(".then"))))
        .when(kind == "iban", F.when(good | alike, iban).otherwise(serial))
        .when(kind == "ssn", F.when(good | alike, ssn).otherwise(bad_ssn))
        .when(kind == "card_like", card)
        .otherwise(F.when(good | alike, six).otherwise(clock))
    )
    cue = (
        F.when(kind == "phone_local", pick(15, "call ", "phone: ", "tel. ", "mobile "))
        .when(kind == "email_hidden", pick(15, "mail ", "contact ", "write to ", "reach me "))
        .when(kind == "iban", pick(15, "iban ", "account ", "bank "))
        .when(kind == "ssn", pick(15, "ssn ", "social security ", "insurance "))
        .when(kind == "card_like", pick(15, "card ", "visa ", "credit card: "))
        .otherwise(pick(15, "host ", "address ", "from "))
    )
    other = pick(14, "order no ", "invoice ", "version ", "page ", "isbn ", "date ", "the build ", "of the ", "section ")
    draw = h(18, 1000)
    before = F.when(good, F.when(draw < 800, cue).when(draw < 950, F.lit("so the ")).otherwise(other)).otherwise(F.when(draw < 745, other).when(draw < 995, F.lit("so the ")).otherwise(cue))
    return spark.range(n).select(kind.alias("kind"), found.alias("found"), before.alias("before"), good.cast("int").alias("label"))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3) -> list[list[tuple]]:
    """Trees of the logistic loss; a tree is a list of nodes ``(feature, cut, left, right)`` or ``(value,)``."""
    margin, trees = np.zeros(len(y)), []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 24))) for j in range(x.shape[1])]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        nodes: list[tuple] = []

        def grow(rows: np.ndarray, left: int, nodes=nodes, g=g, h=h) -> int:
            at = len(nodes)
            nodes.append(())
            gain, chosen = 1e-6, None
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            if left:
                for j, borders in enumerate(cuts):
                    for cut in borders:
                        low = x[rows, j] <= cut
                        if 10 <= low.sum() <= len(rows) - 10:
                            a, b = rows[low], rows[~low]
                            found = g[a].sum() ** 2 / (h[a].sum() + 1) + g[b].sum() ** 2 / (h[b].sum() + 1) - whole
                            if found > gain:
                                gain, chosen = found, (j, float(cut), a, b)
            if chosen is None:
                nodes[at] = (float(rate * g[rows].sum() / (h[rows].sum() + 1)),)
            else:
                j, cut, a, b = chosen
                nodes[at] = (j, cut, grow(a, left - 1), grow(b, left - 1))
            return at

        grow(np.arange(len(y)), depth)
        trees.append(nodes)
        margin += np.array([value(nodes, row) for row in x])
        if np.abs(g).max() < 0.05:
            break
    return trees


def value(nodes: list[tuple], row: np.ndarray, at: int = 0) -> float:
    while len(nodes[at]) > 1:
        j, cut, low, high = nodes[at]
        at = low if row[j] <= cut else high
    return nodes[at][0]


def tree_column(nodes: list[tuple], inputs: list[Column], at: int = 0) -> Column:
    """A tree as nested conditions."""
    if len(nodes[at]) == 1:
        return F.lit(nodes[at][0])
    j, cut, low, high = nodes[at]
    return F.when(inputs[j] <= cut, tree_column(nodes, inputs, low)).otherwise(tree_column(nodes, inputs, high))


def train(spark: SparkSession, n: int = EXAMPLES, precision: float = PRECISION) -> tuple[list[list[tuple]], float]:
    """The trees and the smallest margin at which held-out examples reach the wanted precision."""
    trees, x, y = fitted(spark, n)
    margins = np.array([sum(value(t, row) for t in trees) for row in x])
    return trees, smallest_cut(margins, y, precision)


def fitted(spark: SparkSession, n: int) -> tuple[list[list[tuple]], np.ndarray, np.ndarray]:
    """Trees fitted on three quarters of the examples, and the held-out quarter."""
    made = examples(spark, n)
    rows = made.select("label", *features(F.col("kind"), F.col("found"), F.col("before"))).collect()  # bounded: ``n`` rows
    data = np.array([[float(v) for v in r] for r in rows])
    x, y = data[:, 1:], data[:, 0]
    held = np.arange(len(y)) % 4 == 0
    return boost(x[~held], y[~held]), x[held], y[held]


def smallest_cut(margins: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The smallest margin from which on the share of true ones reaches ``precision``; infinite if none does."""
    order = np.argsort(-margins, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(labels) + 1)
    ends = np.append(np.diff(margins[order]) != 0, True)  # equal margins are taken together
    enough = np.flatnonzero((right >= precision) & ends)
    return float(margins[order][enough[-1]]) if len(enough) else float("inf")


def find_spans(docs: DataFrame, text: str = "text", id_column: str = "doc_id", model: tuple | None = None) -> DataFrame:
    """``(row_id, id, spans)`` a row: array of ``(start, rank, end, kind, base, margin, taken)`` in order, code points, end exclusive."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_column), candidates(F.col(text)).alias("found"))
    return spans_of(rows, ["row_id", id_column], model or train(docs.sparkSession))


def candidates(text: Column) -> Column:
    """All matches of all patterns in one text."""
    whole = F.coalesce(text, F.lit(""))
    return F.flatten(F.array_compact(F.array(*[gated(whole, k, p) for k, p in {**BASE, **PROPOSED}.items()])))


def spans_of(rows: DataFrame, keys: list[str], model: tuple) -> DataFrame:
    """``keys`` (the first names the row) and ``spans`` from ``keys`` and ``found``.

    Places are running sums of gaps and matches of a row and kind. A proposed span stays if no base span overlaps it (told
    by the furthest end before and the nearest start behind it), and no overlapping proposed one has a larger margin, or
    an equal one and an earlier place. ``taken``: how far the spans before this one reach.
    """
    trees, cut = model
    row = keys[0]
    each = rows.select(*keys, F.posexplode_outer("found").alias("place", "x"))
    order = Window.partitionBy(row, "x.kind").orderBy("place")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("x.gap") + F.length("x.found")).over(run)).withColumn("start", F.col("end") - F.length("x.found"))
    kind, base = F.col("x.kind"), F.col("x.kind").isin(*KINDS)
    # computed once a proposed span, as the trees name them some hundred times
    placed = placed.withColumn("inputs", F.when(~base, F.array(*features(kind, F.col("x.found"), F.col("x.before")))))
    inputs = [F.col("inputs")[j] for j in range(len(FEATURES))]
    margin = sum((tree_column(t, inputs) for t in trees), F.lit(0.0))
    placed = placed.withColumn("margin", F.when(base, F.lit(1e9)).otherwise(margin))
    kept = F.when(kind.isNull(), False).when(base, valid(kind, F.col("x.found"))).otherwise(F.col("margin") >= cut)
    rank = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, *PROPOSED)]), kind)
    scored = placed.select(*keys, "start", "end", rank.alias("rank"), kind.alias("kind"), base.alias("base"), "margin", kept.alias("kept"))
    fixed = F.col("kept") & F.col("base")
    ahead = Window.partitionBy(row).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy(row).orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = Window.partitionBy(row).orderBy("start").rangeBetween(-LONGEST, LONGEST)
    hit = (F.coalesce(F.max(F.when(fixed, F.col("end"))).over(ahead), F.lit(-1)) > F.col("start")) | (F.coalesce(F.min(F.when(fixed, F.col("start"))).over(behind), F.col("end")) < F.col("end"))
    own = F.struct("start", "end", "margin", "rank")
    free = scored.withColumn("free", F.col("kept") & ~F.col("base") & ~hit)
    rivals = free.withColumn("rivals", F.collect_list(F.when(F.col("free"), own)).over(near))  # bounded by the frame's length
    better = lambda o: (o["margin"] > F.col("margin")) | ((o["margin"] == F.col("margin")) & (F.struct(o["start"], o["rank"]) < F.struct("start", "rank")))
    beaten = F.exists("rivals", lambda o: (o["start"] < F.col("end")) & (F.col("start") < o["end"]) & better(o))
    chosen = rivals.withColumn("stays", F.coalesce(fixed | (F.col("free") & ~beaten), F.lit(False)))
    reach = Window.partitionBy(row).orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("taken", F.coalesce(F.max(F.when(F.col("stays"), F.col("end"))).over(reach), F.lit(0)))
    span = F.struct("start", "rank", "end", "kind", "base", "margin", "taken")
    return chosen.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("stays"), span))).alias("spans"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The contract's columns from :func:`find_spans`' output."""
    fixed = F.filter("spans", lambda s: s["base"])
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(id_column, *counts, F.sha2(written(fixed), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", model: tuple | None = None) -> DataFrame:
    """``docs`` with each span replaced by ``[KIND]``; overlapping spans become one of the first's kind. Other columns stay.

    Spans belong to the text, so they are found once for equal texts and joined by its digest.
    """
    keyed = docs.withColumn("__key", F.unhex(F.md5(F.col(text).cast("binary"))))
    matched = keyed.select("__key", candidates(F.col(text)).alias("found")).where(F.size("found") > 0)
    each = spans_of(matched.groupBy("__key").agg(F.any_value("found").alias("found")), ["__key"], model or train(docs.sparkSession))
    found = each.where(F.size("spans") > 0).withColumnRenamed("spans", "__spans")
    between = lambda s: F.substr(F.col(text), (s["taken"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - s["taken"]).cast("int"))
    parts = F.transform("__spans", lambda s: F.when(s["start"] < s["taken"], F.lit("")).otherwise(F.concat(between(s), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
    rest = F.substr(F.col(text), (F.array_max(F.transform("__spans", lambda s: s["end"])) + 1).cast("int"))
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.concat(F.array_join(parts, ""), rest))
    return keyed.join(found, "__key", "left").withColumn(text, clean).select(*docs.columns)
