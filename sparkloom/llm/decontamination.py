"""Passages of benchmark items inside documents by a prefix-filtered set join (op 12).

1. An item's windows (runs of ``size`` words; all its words if it has fewer) are sets of shingles (runs of three words, or of the
   window's words if it has fewer). How many documents hold each shingle is counted over the whole table.
2. A document that contains a window contains all its shingles, so the necessary prefix is one token: the window's
   rarest shingle, ties by hash. Documents are read once more, and only places of such prefix shingles are candidates.
3. The shingle's offset in its window gives the start there; starts before the first word or too close to the last
   one go (positional and length bound), and so do starts whose window hash is no item's.
4. What is left joins the items' windows on the words themselves, so hashes decide nothing.

What the tasks hold are two bitmaps of ``2 ** BITS`` bits, made by Spark: their size doesn't depend on the benchmark; a fuller
bitmap only lets more candidates through to the exact join. Results are by the text's digest, so copies of a document are joined once.

Null, empty and blank texts have no words and are clean. Repeated rows and null doc_ids are rows of their own. Items without words
have no windows; items that share an id count as one; a null item_id hits words but isn't listed. Extra columns aren't
read. Without items nothing is hit; without documents there are no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Workspace, by_size, few
from sparkloom.llm.minhash import GOLDEN, mix

SHINGLE = 3
BITS = 26
#: Bytes of text that are taken together.
SLICE = 2_000_000
#: Letters and digits of ASCII and all bytes of other characters make words.
WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
STEP = 0x9E3779B97F4A7C15 | 1


def powers(step: int, n: int) -> np.ndarray:
    """``step ** i`` modulo 2 ** 64 for ``i < n``."""
    found = np.full(n, step, np.uint64)
    found[:1] = 1
    return np.multiply.accumulate(found)


class Words:
    """The words of a slice of texts: hashes, places in the lower-cased bytes, and the first and last of each text."""

    UP, DOWN = powers(STEP, SLICE), powers(pow(STEP, -1, 1 << 64), SLICE)

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
        ends = ends - ends[0]
        self.data = LOWER[whole]
        inside = WORD[whole]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        filled = ends[:-1] < ends[1:]  # words don't run on into the next text
        begins[ends[:-1][filled]] = inside[ends[:-1][filled]]
        stops[ends[1:][filled] - 1] = inside[ends[1:][filled] - 1]
        self.starts, self.stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = (self.UP, self.DOWN) if len(whole) <= SLICE else (powers(STEP, len(whole)), powers(pow(STEP, -1, 1 << 64), len(whole)))
        total = np.zeros(len(whole) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up[: len(whole)], out=total[1:])
        self.hashes = mix((total[self.stops] - total[self.starts]) * down[self.starts]) if len(self.starts) else np.empty(0, np.uint64)
        self.first = np.searchsorted(self.starts, ends[:-1])
        self.last = np.searchsorted(self.starts, ends[1:])

    def runs(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` words that begin at ``at``, all of which must end in time."""
        out = np.full(len(at), size, np.uint64)
        for i in range(size):
            out = mix(out * GOLDEN + self.hashes[at + i])
        return out

    def shingled(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings of all runs of ``size`` words inside one text, and the number of that text."""
        text = np.repeat(np.arange(len(self.first)), self.last - self.first)
        at = np.flatnonzero(np.arange(len(text)) + size <= self.last[text])
        return at, text[at]

    def spelled(self, at: int, size: int) -> str:
        """The words of a run, lower-cased, with one space between them."""
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.starts[at : at + size].tolist(), self.stops[at : at + size].tolist(), strict=True)]).decode()


def item_windows(items: DataFrame, text: str, id_column: str, size: int) -> DataFrame:
    """``(item, words, k, window, shingles)`` for each window of each item: its words, their number, hash, and shingles with offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(iter([batch]), 1, SLICE):
                words = Words(part.column(1))
                rows: list[dict] = []
                for i, (first, last) in enumerate(zip(words.first.tolist(), words.last.tolist(), strict=True)):
                    k = min(size, last - first)
                    if not k:
                        continue
                    starts = np.arange(first, last - k + 1)
                    m = min(SHINGLE, k)
                    tokens = words.runs(np.arange(first, last - m + 1), m).astype(np.int64).tolist()
                    for at, window in zip(starts.tolist(), words.runs(starts, k).astype(np.int64).tolist(), strict=True):
                        found = [{"token": tokens[at - first + o], "offset": o} for o in range(k - m + 1)]
                        rows.append({"item": part.column(0)[i].as_py(), "words": words.spelled(at, k), "k": k, "window": window, "shingles": found})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("item", part.schema.field(0).type), ("words", pa.string()), ("k", pa.int32()), ("window", pa.int64()), ("shingles", pa.list_(pa.struct([("token", pa.int64()), ("offset", pa.int32())])))]))

    kind = items.schema[id_column].dataType.simpleString()
    return items.select(id_column, text).mapInArrow(run, f"item {kind}, words string, k int, window bigint, shingles array<struct<token: bigint, offset: int>>")


def bitmap(hashes: DataFrame, column: str) -> bytes:
    """``2 ** BITS`` bits, of which those that the column's hashes name are set; at most 2 ** (BITS - 3) bytes reach the driver."""
    bit = F.shiftrightunsigned(column, 64 - BITS)
    # bitmap buckets count from 1 and hold 32768 bits each
    parts = hashes.groupBy(F.bitmap_bucket_number(bit + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("bits"))
    out = bytearray(1 << (BITS - 3))
    for row in parts.toLocalIterator():
        at = (row.bucket - 1) * 4096
        out[at : at + 4096] = row.bits
    return bytes(out)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    place = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def document_counts(docs: DataFrame, text: str, sizes: list[int], known) -> DataFrame:
    """``(token, df)``: documents that hold each shingle which the bitmap lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8)
        for part in by_size(batches, 0, SLICE):
            words, found = Words(part.column(0)), [np.empty(0, np.uint64)]
            for m in sizes:
                at, of = words.shingled(m)
                tokens = words.runs(at, m)
                hit = marked(bits, tokens)
                order = np.lexsort((tokens[hit], of[hit]))
                of, tokens = of[hit][order], tokens[hit][order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (tokens[1:] != tokens[:-1])
                found.append(tokens[new])
            tokens, df = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), pa.array(df.astype(np.int64))], names=["token", "df"])

    return docs.select(text).mapInArrow(run, "token bigint, df bigint").groupBy("token").agg(F.sum("df").alias("df"))


def candidates(docs: DataFrame, text: str, id_column: str, shapes: dict[int, list[tuple[int, int]]], prefixes, windows) -> DataFrame:
    """``(id, n_words, digest, found)`` a row: what may be an item's window, with the places where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, whole = np.frombuffer(prefixes.value, np.uint8), np.frombuffer(windows.value, np.uint8)
        for part in by_size(batches, 1, SLICE):
            words = Words(part.column(1))
            found: dict[int, dict[tuple[str, int], set[int]]] = defaultdict(lambda: defaultdict(set))
            for m, placed in shapes.items():
                at, of = words.shingled(m)
                hit = marked(rare, words.runs(at, m))
                at, of = at[hit], of[hit]
                for offset, k in placed:
                    start = at - offset
                    fits = (start >= words.first[of]) & (start + k <= words.last[of])
                    start, owner = start[fits], of[fits]
                    kept = marked(whole, words.runs(start, k))
                    for s, i in zip(start[kept].tolist(), owner[kept].tolist(), strict=True):
                        found[i][words.spelled(s, k), k].add(s - int(words.first[i]))
            rows = [[{"words": w, "k": k, "starts": sorted(s)} for (w, k), s in found[i].items()] if i in found else None for i in range(part.num_rows)]
            digests = [hashlib.sha256(part.column(1)[i].as_py().encode()).digest() if i in found else None for i in range(part.num_rows)]
            kind = pa.list_(pa.struct([("words", pa.string()), ("k", pa.int32()), ("starts", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array((words.last - words.first).astype(np.int64)), pa.array(digests, pa.binary()), pa.array(rows, kind)],
                names=["id", "n_words", "digest", "found"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"id {kind}, n_words bigint, digest binary, found array<struct<words: string, k: int, starts: array<int>>>")


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", id_column: str = "doc_id", item_text: str = "text", item_id: str = "item_id", size: int = 10) -> DataFrame:
    """``(id, n_words, n_hit, items, contaminated)`` a row of ``docs``: words inside items' windows, and the sorted ids of these items as strings."""
    spark = docs.sparkSession
    space = Workspace(spark, "decontamination")
    of_items = space.keep(item_windows(items, item_text, item_id, size), "windows")
    distinct = space.keep(of_items.dropDuplicates(["words"]).drop("item"), "distinct")
    tokens = distinct.select("words", "k", F.explode("shingles").alias("x")).select("words", "k", "x.token", "x.offset")
    sizes = [r.m for r in distinct.select(F.least("k", F.lit(SHINGLE)).alias("m")).distinct().collect()]
    share = spark.sparkContext.broadcast
    counted = space.keep(document_counts(docs, text, sizes, share(bitmap(tokens.select("token"), "token"))), "counted")
    # the rarest shingle of each window; one that no document holds can't be in any
    ranked = tokens.join(few(counted, 16), "token", "left").groupBy("words", "k").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "offset")).alias("rarest"))
    prefixes = space.keep(ranked.where("rarest.df > 0").select("words", "k", "rarest.token", "rarest.offset"), "prefixes")
    # offset and number of words of windows: at most size * (size + 1) / 2 of them
    shapes: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in prefixes.select("offset", "k").distinct().collect():
        shapes[min(SHINGLE, r.k)].append((r.offset, r.k))
    live = distinct.join(prefixes.select("words"), "words", "left_semi")
    seen = candidates(docs, text, id_column, dict(shapes), share(bitmap(prefixes, "token")), share(bitmap(live, "window")))
    seen = space.keep(seen, "seen")
    # exact: the words themselves are the key
    copies = seen.where("digest IS NOT NULL").groupBy("digest").agg(F.first("found").alias("found"))
    placed = copies.select("digest", F.explode("found").alias("x")).select("digest", "x.words", "x.k", "x.starts")
    verified = space.keep(placed.join(few(live.select("words"), 200), "words", "left_semi"), "verified")
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("k") - 1)))
    hit = verified.select("digest", F.explode(F.array_distinct(covered)).alias("place")).distinct().groupBy("digest").agg(F.count("*").alias("n_hit"))
    named = few(space.keep(of_items.select("words", F.col("item").cast("string").alias("item")).distinct(), "named"), 200)
    listed = verified.select("digest", "words").join(named, "words").select("digest", "item").distinct().groupBy("digest").agg(F.sort_array(F.collect_list("item")).alias("items"))
    results = few(space.keep(hit.join(listed, "digest", "left"), "results"), 400)
    nothing = F.array().cast("array<string>")
    clean = seen.where("digest IS NULL").select("id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), nothing.alias("items"))
    others = seen.where("digest IS NOT NULL").drop("found").join(results, "digest", "left")
    both = clean.union(others.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", nothing).alias("items")))
    return both.select(F.col("id").alias(id_column), "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))
