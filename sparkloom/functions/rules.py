"""Ordered rule tables as conditions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(x: Column, rules: Iterable[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first pattern found in ``x`` (case-blind, also beyond ASCII)."""
    chain = None
    for pattern, label in rules:
        found = x.rlike(f"(?iu){pattern}")
        chain = F.when(found, label) if chain is None else chain.when(found, label)
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def reasons(*tests: tuple[str, Column]) -> Column:
    """Names of all tests that hold, in order (F16)."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def first_reason(*tests: tuple[str, Column]) -> Column:
    """Name of the first test that holds, else null."""
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests])


def route(confidence: Column, valid: Column, least: float = 0.75) -> Column:
    """'auto' for confident valid rows, else 'needs_review' (C8)."""
    return F.when((confidence >= least) & valid, "auto").otherwise("needs_review")


def run_status(done: Column, total: Column, least: float = 0.7) -> Column:
    """ok, partial or failed by the share that is done."""
    return F.when(done == total, "ok").when(done >= least * total, "partial").otherwise("failed")


def enum_or(x: Column, allowed: list[str], default: str) -> Column:
    """``x`` if it is one of ``allowed``, else ``default``."""
    return F.when(x.isin(allowed), x).otherwise(default)


def fill_if_empty(old: Column, new: Column) -> Column:
    """``old`` unless it is null or blank."""
    return F.when(old.isNull() | (F.trim(old) == ""), new).otherwise(old)


def within_vocabulary(labels: Column, allowed: Column) -> Column:
    """True if every label is in the list."""
    return F.size(F.array_except(labels, allowed)) == 0


#: Patterns of property types in notices and their names, in the order in which they count; codes are matched as written.
PROPERTY_TYPES = (
    (r"(?-i)\bPPE\b", "PPE"),
    (r"(?-i)\bCOP\b", "COP"),
    (r"(?-i)\bB-F\b", "B-F"),
    (r"\bterrain\s+b[aâ]ti\b", "terrain bati"),
    (r"\bterrain\s+non\s+b[aâ]ti\b", "terrain non bati"),
    (r"\bhabitation\s+individuelle\b", "habitation individuelle"),
    (r"\bappartement\b", "appartement"),
    (r"\bvilla\b", "villa"),
    (r"\bimmeuble\b", "immeuble"),
    (r"\brurale?\b", "rural"),
    (r"\bgarage\b", "garage"),
    (r"\bplace\s+de\s+parc\b", "place de parc"),
    (r"\bchalet\b", "chalet"),
    (r"\bparcelle\b", "parcelle"),
    (r"\bpart\s+de\s+copropri[eé]t[eé]\b", "COP"),
    (r"\bEigentumswohnung\b", "PPE"),
    (r"\bStockwerkeigentum\b", "PPE"),
)
#: Cantons whose language is German.
GERMAN_CANTONS = ("ZH", "BE", "AG", "BL", "BS", "GR", "LU", "SG", "SH", "SO", "SZ", "TG", "UR", "ZG", "OW", "NW", "GL", "AR", "AI")
#: Words that no label of a legend holds.
SKIPPED_LABELS = ("echelle", "legende", "légende", "commune de", "plan directeur", "urbaplan")
#: Connectors at the end of a label that goes on elsewhere.
CONNECTORS = "à|de|du|des|et|en|au|aux|par|pour|sur|sous|la|le|les|liée?s?\\s+à"
#: A sentence break, a colon at the end, a bullet, a number or range alone, two sentences.
PARAGRAPHS = (
    r"\.\s+[A-ZÉÈÊÀÂÎÔÛÇ]",
    r":\s*$",
    r"^\s*(?:[>•·]|-\s|–\s|—\s)",
    r"^\s*\d+(?:\.\d+)?(?:\s*[-–]\s*\d+(?:\.\d+)?)?\s*$",
    r"[.!?]\s+[\p{L}\p{N}_]+.*[.!?]",
)


def property_type(x: Column) -> Column:
    """The first of :data:`PROPERTY_TYPES` in a text, null without one; letters with marks are letters, also at a word's end."""
    return first_match(x, [(f"(?U){pattern}", label) for pattern, label in PROPERTY_TYPES])


def portal(ref: Column, default: str) -> Column:
    """Where an id comes from by its form: ``mig-`` ahead, or two groups of four and one of three digits; ``unknown`` without an id."""
    return F.when(F.coalesce(ref, F.lit("")) == "", "unknown").when(ref.startswith("mig-"), "migrated").when(ref.rlike(r"^[A-Z0-9]{4}-[A-Z0-9]{4}-[0-9]{3}\z"), "newhome").otherwise(default)


def canton_language(language: Column, canton: Column) -> Column:
    """A stated language's first two letters, else the canton's language, French by default."""
    stated = F.lower(F.left(F.nullif(language, F.lit("")), F.lit(2)))
    return F.coalesce(stated, F.when(canton == "TI", "it").when(canton.isin(*GERMAN_CANTONS), "de"), F.lit("fr"))


def extra_properties(items: Column) -> Column:
    """A struct of what a listing's free remarks say, by substring, the last of a kind; each remark counts as its first kind (M9)."""
    kinds = {"floor": ("floor", "étage"), "availability": ("available", "disponible"), "parcel_m2": ("surface propriété",), "usable_m2": ("surface utilisable",), "built": ("construit en",)}

    def kind_of(x: Column) -> Column:
        low = F.lower(x)
        chain = F.lit(None).cast("string")
        for name, words in reversed(kinds.items()):
            found = low.contains(words[0])
            for word in words[1:]:
                found = found | low.contains(word)
            chain = F.when(found, name).otherwise(chain)
        return chain

    last = lambda name: F.try_element_at(F.filter(items, lambda x: kind_of(x) == name), F.lit(-1))
    number = lambda name: F.nullif(F.regexp_extract(last(name), "[0-9]+", 0), F.lit("")).try_cast("bigint")
    return F.struct(last("floor").alias("floor"), last("availability").alias("availability"), *[number(k).alias(k) for k in ("parcel_m2", "usable_m2", "built")])


def truncated_label(label: Column) -> Column:
    """True for a label that ends with one of :data:`CONNECTORS` behind a blank."""
    return F.coalesce(label.rlike(rf"(?iu)\s+(?:{CONNECTORS})\s*$"), F.lit(False))


def noise_label(label: Column) -> Column:
    """True for what is no label: a skipped word, a scale bar, fewer than three characters between blanks and dashes; null is noise."""
    low = F.lower(F.regexp_replace(label, "^[ /–—-]+|[ /–—-]+$", ""))
    # one pattern, as inside a lambda each use of a column is computed again
    return F.coalesce(low.rlike(rf"(?s)^.{{0,2}}\z|^[0-9\s'’.,m]+$|{'|'.join(SKIPPED_LABELS)}"), F.lit(True))


def paragraph_label(label: Column) -> Column:
    """True for a text with one of the five shapes of running text in :data:`PARAGRAPHS` (F8)."""
    return F.coalesce(label.rlike("|".join(PARAGRAPHS)), F.lit(False))
