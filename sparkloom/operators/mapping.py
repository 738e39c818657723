"""Declared mappings of nested records, compiled to one projection over VARIANT.

A mapping names target columns and says where each comes from: paths in order of preference, type, default, languages. Every kind of
field compiles to a Column, so a mapping is as many expressions over a document that is parsed once; lists become arrays of structs.
Blank texts count as missing everywhere, a record without any filled field is null, and so is an empty list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at(document: Column, path: str, kind: str) -> Column:
    """What stands at a path as ``kind``, null if it is absent or of another kind; a path without ``$`` is one key, whatever its characters."""
    path = path if path.startswith("$") else f'$["{path}"]'
    return F.try_variant_get(document, path, kind)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def plain(document: Column, path: str) -> Column:
    """Trimmed text of what stands at a path, null if that is blank, a list or an object."""
    # an object or a list reads as JSON text: only what looks like it is asked for its kind
    # an object or a list reads as JSON text: only what looks like it is asked for its kind
    is_text = F.schema_of_variant(at(document, path, "variant")) == "STRING"
    return let(F.trim(at(document, path, "string")), lambda t: F.when(F.substring(t, 1, 1).isin("{", "["), F.when(is_text, t)).when(t != "", t))


class Field:
    """A field of a mapping."""

    def column(self, document: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Value(Field):
    """The first of ``paths`` with a value; ``clean`` is applied to its text (before the type, if that isn't text), ``default`` fills what is missing."""

    paths: tuple[str, ...]
    kind: str = "string"
    default: object = None
    clean: Callable[[Column], Column] | None = None

    def column(self, document: Column) -> Column:
        found = F.coalesce(*[plain(document, p) for p in self.paths])
        found = self.clean(found) if self.clean else found
        typed = found if self.kind == "string" else found.try_cast(self.kind)
        return typed if self.default is None else F.coalesce(typed, F.lit(self.default).cast(self.kind))


@dataclass(frozen=True)
class Constant(Field):
    """The same value in every row."""

    value: object
    kind: str = "string"

    def column(self, document: Column) -> Column:
        return F.lit(self.value).cast(self.kind)


@dataclass(frozen=True)
class Text(Field):
    """A text by language: the first of ``languages`` that is filled, else any, else the value itself where it isn't an object."""

    paths: tuple[str, ...]
    languages: tuple[str, ...] = ("en", "fr", "de", "it")

    def column(self, document: Column) -> Column:
        found = []
        for path in self.paths:
            texts = F.map_filter(at(document, path, "map<string,string>"), lambda _, v: F.trim(v) != "")
            found += [F.try_element_at(texts, F.lit(language)) for language in self.languages]
            found += [F.try_element_at(F.map_values(texts), F.lit(1)), plain(document, path)]
        return F.coalesce(*found)


@dataclass(frozen=True)
class Record(Field):
    """A struct of fields, read below ``path``; null if all its fields are."""

    fields: dict[str, Field] = field(hash=False)
    path: str = "$"

    def column(self, document: Column) -> Column:
        inner = document if self.path == "$" else at(document, self.path, "variant")
        made = {name: f.column(inner) for name, f in self.fields.items()}
        filled = [name for name, f in self.fields.items() if not isinstance(f, Constant)]
        return let(F.struct(*[c.alias(n) for n, c in made.items()]), lambda r: F.when(any_filled([r[n] for n in filled]), r))


def any_filled(columns: list[Column]) -> Column:
    """True if one of the columns isn't null."""
    out = F.lit(False)
    for c in columns:
        out = out | c.isNotNull()
    return out


@dataclass(frozen=True)
class Many(Field):
    """A list: ``item`` for each element of the first of ``paths`` that is a list; empty elements are left out, an empty list is null."""

    paths: tuple[str, ...]
    item: Field

    def column(self, document: Column) -> Column:
        lists = [F.filter(F.transform(at(document, p, "array<variant>"), self.item.column), lambda x: x.isNotNull()) for p in self.paths]
        return F.coalesce(*[let(x, lambda found: F.when(F.size(found) > 0, found)) for x in lists])


@dataclass(frozen=True)
class Joined(Field):
    """Texts of the fields that are filled, with ``separator`` between them; null if none is."""

    parts: tuple[Field, ...]
    separator: str = ", "

    def column(self, document: Column) -> Column:
        return F.nullif(F.concat_ws(self.separator, *[p.column(document).cast("string") for p in self.parts]), F.lit(""))


@dataclass(frozen=True)
class Either(Field):
    """The first field with a value."""

    fields: tuple[Field, ...]

    def column(self, document: Column) -> Column:
        return F.coalesce(*[f.column(document) for f in self.fields])


@dataclass(frozen=True)
class Json(Field):
    """A record or list as JSON text; keys without value are left out."""

    of: Field

    def column(self, document: Column) -> Column:
        return F.to_json(self.of.column(document))


def map_records(df: DataFrame, json: str, fields: dict[str, Field], keep: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and one for each field of the documents in ``json``; rows without a ``required`` field go.

    Text that isn't JSON, and null, is a document without fields.
    """
    # generated, so that neither a filter nor a field repeats the parsing
    parsed = df.select(*keep, F.explode(F.array(F.try_parse_json(json))).alias("__document"))
    document = F.col("__document")
    mapped = parsed.select(*keep, *[f.column(document).alias(name) for name, f in fields.items()])
    return mapped.dropna(subset=list(required)) if required else mapped
