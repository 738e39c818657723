"""Alignment of the tokens of two vocabularies by divide and conquer at shared cuts (op 11).

Both vocabularies cut a text's bytes into tokens. Offsets where tokens of both end cut them into groups: a common end
near the middle is looked for by bisect, both halves are taken alike, and an interval without a common end is a leaf
group. All intervals of a block of texts advance in lockstep, so a level costs a few numpy calls.

A block (texts of about ``BLOCK`` characters of one partition) aligns each distinct stretch between two safe cuts once: a single
space or line break between characters that aren't white space starts a token in either vocabulary. Links (overlapping pairs of
tokens) are counted a block, summed in Spark, and each block fetches the sums of its own distinct pairs,
so what moves is a block's dictionary and never a row for each link.

Null and empty texts, and texts whose tokens don't give back the bytes of space and text (those with U+2581), have no
tokens: zeros and an empty ``groups``. Repeated rows and null ids stay rows of their own. Extra columns aren't read. An
empty table gives no rows. A text of any length is whole; without white space it is one stretch.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Workspace, by_size, few

#: Characters of a block, and of new stretches that are encoded together; blocks of a row group.
BLOCK, PIECE, ROWS = 3_000_000, 100_000, 8
SPACE = "▁"
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")
LONGS = ("n_a", "n_b", "n_groups", "n_links")


def byte_symbols() -> dict[str, int]:
    """Characters of byte-level tokens: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def shared_ends(a: np.ndarray, b: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray) -> np.ndarray:
    """All values that increasing ``a`` and ``b`` share inside the intervals ``a[a_lo:a_hi]``, ``b[b_lo:b_hi]``.

    Each round, every open interval bisects ``b`` for one candidate of ``a``, from its middle outwards. A common end splits
    the interval in two; one whose candidates are used up is a leaf.
    """
    found, tried = [np.empty(0, a.dtype)], np.zeros(len(a_lo), np.int64)
    while True:
        is_open = (a_lo < a_hi) & (b_lo < b_hi) & (tried <= a_hi - a_lo + 1)
        if not is_open.any():
            return np.concatenate(found)
        a_lo, a_hi, b_lo, b_hi, tried = (x[is_open] for x in (a_lo, a_hi, b_lo, b_hi, tried))
        at = (a_lo + a_hi) // 2 + np.where(tried & 1, (tried + 1) // 2, -(tried // 2))
        inside = (at >= a_lo) & (at < a_hi)
        value = a[np.where(inside, at, a_lo)]
        place = np.searchsorted(b, value)
        hit = inside & (place < b_hi)
        hit &= b[np.where(hit, place, 0)] == value
        found.append(value[hit])
        miss = ~hit
        at, place, again = at[hit], place[hit], np.zeros(2 * int(hit.sum()), np.int64)
        a_lo, a_hi = np.concatenate([a_lo[miss], a_lo[hit], at + 1]), np.concatenate([a_hi[miss], at, a_hi[hit]])
        b_lo, b_hi = np.concatenate([b_lo[miss], b_lo[hit], place + 1]), np.concatenate([b_hi[miss], place, b_hi[hit]])
        tried = np.concatenate([tried[miss] + 1, again])


class Vocabularies:
    """A byte-level vocabulary (A, reads space and text) beside a piece vocabulary with byte fallback (B, adds the space)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols = byte_symbols()
        pieces = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(pieces.values()) + 1)
        for piece, i in pieces.items():
            self.a_bytes[i] = bytes(symbols[c] for c in piece) if all(c in symbols for c in piece) else piece.encode()
        spell = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(SPACE, " ").encode()
        self.b_bytes = [spell(i) for i in range(self.b.get_piece_size())]
        for p in map(self.b.id_to_piece, range(self.b.get_piece_size())):
            if SPACE in p.lstrip(SPACE) or "\n" in p:
                raise ValueError("pieces that run across a word start or a line break are not supported")
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.spelling = np.array([f"{i}{mark}" for mark in ",|;" for i in range(most)], object).reshape(3, most)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both for texts that begin with a space, and whether both give back the bytes."""
        out = []
        for text, encoded in zip(texts, self.a.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            a, b, data = encoded.ids, self.b.encode(text[1:], num_threads=1), text.encode()
            right = b"".join([self.a_bytes[i] for i in a]) == data and b"".join([self.b_bytes[i] for i in b]) == data
            out.append((np.array(a, np.int32), np.array(b, np.int32), right))
        return out


@functools.lru_cache(2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


class Stretches:
    """Tokens, groups and links of a list of stretches, by their place in it."""

    #: Before each text that is encoded; its end is a safe cut.
    LEAD = " x"

    def __init__(self, both: Vocabularies, stretches: list[str], alone: list[bool]):
        self.bad = np.zeros(len(stretches), bool)
        ids: list[tuple[np.ndarray, np.ndarray]] = []
        owner: list[int] = []  # -1: the lead
        lengths: list[int] = []
        todo = list(self.together(stretches, alone))
        while todo:
            batch, todo = todo[:16], todo[16:]
            encoded = both.encode([self.LEAD + "".join([stretches[i] for i in part]) for part in batch])
            for part, (a, b, right) in zip(batch, encoded, strict=True):
                if right:
                    ids.append((a, b))
                    owner += [-1, *part]
                    lengths += [len(self.LEAD), *[len(stretches[i].encode()) for i in part]]
                elif len(part) > 1:
                    todo += [[i] for i in part]
                else:
                    self.bad[part[0]] = True
        a, b = (np.concatenate([np.empty(0, np.int32), *[x[side] for x in ids]]) for side in (0, 1))
        del ids
        ends_a, ends_b = np.cumsum(both.a_length[a]), np.cumsum(both.b_length[b])
        borders, place = np.cumsum(np.array(lengths, np.int64)), np.array(owner, np.int64)
        last_a, last_b = np.searchsorted(ends_a, borders), np.searchsorted(ends_b, borders)
        if len(borders) and not (np.array_equal(ends_a[last_a], borders) and np.array_equal(ends_b[last_b], borders)):
            raise ValueError("a token runs across a cut that should be safe")
        first_a, first_b = np.concatenate([[0], last_a[:-1] + 1])[: len(last_a)], np.concatenate([[0], last_b[:-1] + 1])[: len(last_b)]
        cuts = np.sort(np.concatenate([borders, shared_ends(ends_a, ends_b, first_a, last_a, first_b, last_b)]))
        both_ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        both_ends = both_ends[np.diff(both_ends, prepend=-1) > 0]
        codes = a[np.searchsorted(ends_a, both_ends)].astype(np.int64) << 32 | b[np.searchsorted(ends_b, both_ends)] if len(a) else np.empty(0, np.int64)
        n = len(stretches)

        def per_stretch(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            of = place[np.searchsorted(borders, ends)] if len(ends) else np.empty(0, np.int64)
            return of, np.bincount(of[of >= 0], minlength=n)

        self.n_a, self.n_b, self.n_groups = (per_stretch(x)[1] for x in (ends_a, ends_b, cuts))
        of, self.n_links = per_stretch(both_ends)
        order = np.argsort(of, kind="stable")[int((of < 0).sum()) :]
        self.codes = codes[order]  # by stretch, in the order of the text
        self.texts = self.spelled(both, a, b, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), last_a, last_b, place)

    @staticmethod
    def together(stretches: list[str], alone: list[bool]) -> Iterator[list[int]]:
        part: list[int] = []
        size = 0
        for i, stretch in enumerate(stretches):
            if alone[i]:
                yield [i]
                continue
            part.append(i)
            size += len(stretch)
            if size > PIECE:
                yield part
                part, size = [], 0
        if part:
            yield part

    def spelled(self, both, a, b, group_a, group_b, last_a, last_b, place) -> list[str]:
        """``a1,a2|b1;a3|b2`` for each stretch."""
        key = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(key, kind="stable")
        key, ids = key[order], np.concatenate([a, b])[order]
        del order
        ends = np.ones(len(key), bool)
        ends[:-1] = key[1:] != key[:-1]
        mark = (ends * (1 + (key & 1))).astype(np.int8)
        del key, ends
        parts = both.spelling[mark, ids].tolist()
        texts, at = [""] * len(self.bad), 0
        for i, end in zip(place.tolist(), (last_a + last_b + 2).tolist(), strict=True):
            if i >= 0:
                texts[i] = "".join(parts[at:end])[:-1]
            at = end
        return texts


def block_of(both: Vocabularies, part: pa.RecordBatch, as_text: bool) -> list[pa.Array]:
    """One row: the texts' own counts, the block's distinct pairs with their links, and what leads from texts to pairs."""
    table: dict = defaultdict()
    table.default_factory = table.__len__
    rows: list[list[int]] = []
    for text in part.column(1).to_pylist():
        if not text or SPACE in text:
            rows.append([])
        elif " ".join(text.split()) == text.replace("\n", " "):  # single spaces and line breaks between words, nothing else
            rows.append([table[w] for w in text.replace("\n", " \n").split(" ")])
        else:
            # a tuple stands for a stretch that holds more white space, so that it is encoded alone
            rows.append([table[s[1:] if s[0] == " " and s[1:2] != "\n" else s] if not re.search(r"\s", s[1:]) else table[(s,)] for s in SAFE.split(" " + text)])
    keys = list(table)
    table.default_factory = None  # else the table holds itself, and a worker keeps the stretches of all its blocks until a full collection
    found = Stretches(both, [k[0] if isinstance(k, tuple) else k if k[0] == "\n" else " " + k for k in keys], [isinstance(k, tuple) for k in keys])
    if found.bad.any():
        rows = [[] if found.bad[np.array(r, np.int64)].any() else r for r in rows]
    unit_ends = np.cumsum([len(r) for r in rows])
    units = np.fromiter(itertools.chain.from_iterable(rows), np.int32, int(unit_ends[-1]) if rows else 0)
    used = np.bincount(units, minlength=len(keys))
    pairs, pair_of = np.unique(found.codes, return_inverse=True)
    counts = np.bincount(pair_of, weights=np.repeat(used, found.n_links), minlength=len(pairs)).astype(np.int64)
    starts = np.concatenate([[0], unit_ends[:-1]])
    longs = []
    for name in LONGS:
        total = np.concatenate([[0], np.cumsum(getattr(found, name)[units])])
        longs.append(pa.array((total[unit_ends] - total[starts]).astype(np.int64)))
    texts = found.texts
    joined = (";".join([texts[i] for i in r]) for r in rows)
    groups = pa.array(joined if as_text else [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in joined], pa.string())
    documents = pa.StructArray.from_arrays([part.column(0), *longs, groups], names=["id", *LONGS, "groups"])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    raw = lambda values, kind: pa.array([values.astype(kind).tobytes()], pa.binary())
    return [
        pa.array([uuid.uuid4().hex]), one(documents), one(pa.array(pairs)), one(pa.array(counts)),
        raw(pair_of, np.int32), raw(np.cumsum(found.n_links), np.int64), raw(units, np.int32), raw(unit_ends, np.int64),
    ]


BLOCK_COLUMNS = ["block", "docs", "pairs", "counts", "pair_of", "link_ends", "units", "unit_ends"]


def between(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that end at ``ends``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[ends], prepend=0)


def score_block(block: pa.Table, scores: pa.Table, id_column: str) -> pa.Table:
    """Per document of a block the sum of its links' counts and the number of its best links."""
    row = {name: block.column(name)[0] for name in ("docs", "pair_of", "link_ends", "units", "unit_ends")}
    pair_of, units = np.frombuffer(row["pair_of"].as_py(), np.int32), np.frombuffer(row["units"].as_py(), np.int32)
    link_ends, unit_ends = (np.frombuffer(row[x].as_py(), np.int64) for x in ("link_ends", "unit_ends"))
    at, made = scores.column("at").to_numpy(), []
    for name in ("best", "count"):
        values = np.zeros(len(at), np.int64)
        values[at] = scores.column(name).to_numpy()
        made.append(pa.array(between(between(values[pair_of], link_ends)[units], unit_ends)))
    docs = row["docs"].values
    fields = [docs.field(x) for x in ("id", *LONGS)] + made + [docs.field("groups")]
    return pa.Table.from_arrays(fields, names=[id_column, *LONGS, "n_best", "count_sum", "groups"])


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", id_column: str = "doc_id", as_text: bool = True) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` a row of ``docs``.

    ``groups`` spells the groups (``a1,a2|b1;a3|b2``), or with ``as_text=False`` is the SHA-256 of that, so that the
    text needn't be stored. ``count_sum`` adds up, over the row's links, how many links of the whole table hold the same pair of ids;
    ``n_best`` counts the links whose pair is the most frequent one of its B id, ties included.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    space = Workspace(docs.sparkSession, "alignment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        for part in by_size(batches, 1, BLOCK):
            yield pa.RecordBatch.from_arrays(block_of(both, part, as_text), names=BLOCK_COLUMNS)

    longs = ", ".join(f"{x}: bigint" for x in LONGS)
    schema = f"block string, docs array<struct<id: {kind}, {longs}, groups: string>>, pairs array<bigint>, counts array<bigint>, pair_of binary, link_ends binary, units binary, unit_ends binary"
    # a few rows a row group: each is some megabytes, and a row group is written and read as a whole
    blocks = space.keep(docs.select(id_column, text).mapInArrow(run, schema), "blocks", codec="zstd", **{"parquet.block.row.count.limit": ROWS})
    counted = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("count"))
    counted = space.keep(counted.withColumn("b", F.expr("pair & 4294967295")), "counted")
    highest = counted.groupBy("b").agg(F.max("count").alias("most"))
    scores = space.keep(counted.join(few(highest, 24), "b").select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best")), "scores")
    # each block fetches the sums of its own pairs; a task scores one block after the other
    wanted = blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(few(scores, 40), "pair").select(F.col("block").alias("of"), "at", "count", "best")
    whole = blocks.select("block", "docs", "pair_of", "link_ends", "units", "unit_ends").groupBy("block").cogroup(wanted.groupBy("of"))
    out = f"{id_column} {kind}, {', '.join(f'{x} bigint' for x in LONGS)}, n_best bigint, count_sum bigint, groups string"
    return whole.applyInArrow(lambda block, scores: score_block(block, scores, id_column), out)
