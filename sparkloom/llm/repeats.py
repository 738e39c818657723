"""Removal of repeated passages by distributed prefix doubling over sampled positions (op 7).

Every byte of a string of ``LENGTH`` bytes that starts at two or more places goes. Sorting the
suffixes of all positions at every doubling would shuffle the input many times over, so the
doubling runs on positions that the content itself chooses: each window of ``LENGTH`` bytes
names one place in it (its anchor: the least hash of the few bytes that begin there). Equal windows
have equal anchors at equal places, so a window whose anchor's string is unique is unique itself.

Spark ranks and reranks, and each round keeps only what isn't unique yet:

1. Rank of the ``FIRST`` bytes at each anchor. Windows next to each other share an anchor, so a row is an anchor with its
   run of windows. Runs whose whole stretch of text is there twice are settled as repeats; of each different stretch one
   row goes on, and only where another stretch has the same rank.
2. Each run is halved on and on (by ``STEP``), so that what its windows have in common grows at both ends. A row is a
   pair: the rank so far, and what the growing offsets add. Equal pairs are one new rank; unique ones are dropped, runs
   of equal stretches settled, the rest goes on, until runs are single windows and ranks have reached ``LENGTH`` bytes.

Ranks are 128-bit digests of the bytes, so no accidental match is to be expected in any corpus; Spark groups equal ones,
counts, and gathers no group's rows. A document's own runs that repeat without a gap (periods) are one row from the
start, so a hot passage gives one row a document.

The same runs over words instead of bytes (``Words``, ``PlainWords``): then a string of so many words is the unit,
whatever its bytes, and white space between words doesn't count. Searches for both kinds of strings go through the same
tables (``Search``), so that texts are read and dealt once.

Null texts count as empty; texts under ``LENGTH`` bytes are kept whole. Equal texts share a key, as they lose the same
bytes; repeated rows are places like any others, so all copies lose their repeats. Extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Workspace, by_size
from sparkloom.llm.minhash import GOLDEN, mix

LENGTH, FIRST, STEP = 400, 100, 8
#: Passages of over 50 words: strings of so many that are there twice are counted beside the bytes.
WORDS, FIRST_WORDS = 51, 8
#: Windows that are looked at together; a longer text is taken in stretches of so many.
STRETCH = 1 << 20
PLACE_BITS = np.uint64(22)
#: Rows that a task holds before it hands them on.
ROWS = 50_000


def digest(data: bytes, salt: bytes = b"") -> bytes:
    """A rank: 128 bits of the content."""
    return hashlib.blake2b(data, digest_size=16, salt=salt).digest()


class Bytes:
    """Bytes as units."""

    width = 1

    def read(self, text: str) -> tuple[bytes, np.ndarray]:
        """The units in one string of bytes, and for each place a hash of the 8 bytes from there."""
        data = text.encode()
        eight = np.zeros(max(0, len(data) - 7), np.uint64)
        for at in range(min(8, len(eight))):
            eight[at::8] = np.frombuffer(data, "<u8", (len(data) - at) // 8, at)
        return data, mix(eight)


class Words:
    """Words as units: what stands between white space; in scripts without spaces, each character."""

    width = 8
    MOST = 400_000
    # Thai to Tibetan, Burmese, Khmer, then kana, Han and their forms of full width
    SPACELESS = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
    ANY = re.compile(f"[{SPACELESS}]")
    WORD = re.compile(rf"[{SPACELESS}]|[^\s{SPACELESS}]+")

    def __init__(self):
        self.known: dict[str, int] = {}

    def read(self, text: str) -> tuple[bytes, np.ndarray]:
        """64 bits a word in one string of bytes, and for each place a hash of the two words from there."""
        words = text.split() if text.isascii() or not self.ANY.search(text) else self.WORD.findall(text)
        known = self.known
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        out = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > self.MOST:
            known.clear()
        return out.tobytes(), mix(out[:-1] * GOLDEN + out[1:])

    def places(self, text: str) -> list[int]:
        """Where each word starts, and the end of the text."""
        return [m.start() for m in self.WORD.finditer(text)] + [len(text)]


ANCHORS = ["kind", "key", "first", "whole", "n", "place", "low", "high", "stop"]
ANCHOR_KINDS = [pa.int8(), *[pa.binary()] * 3, *[pa.int32()] * 5]


class PlainWords:
    """Words as op 4 takes them (what stands between ASCII white space), hashed for a whole batch of texts at once."""

    width = 8
    #: Bytes of texts that are taken together.
    TOGETHER = 1 << 20
    SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
    LETTER = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    BASE = 0xD1342543DE82EF95
    LANES = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def hashes(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits a word of the texts between ``borders``, and where each word starts."""
        n = len(data)
        if len(self.up) < n:
            self.up, self.down = (np.multiply.accumulate(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.LETTER[data] * self.up[:n], out=total[1:])
        space, border = self.SPACE[data], np.zeros(n + 1, bool)
        border[borders] = True
        starts = np.flatnonzero((np.append(True, space[:-1]) | border[:-1]) & ~space)
        ends = np.flatnonzero((np.append(space[1:], True) | border[1:]) & ~space) + 1
        return mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * GOLDEN), starts

    def read(self, text: str) -> tuple[bytes, None]:
        """64 bits a word in one string of bytes."""
        data = np.frombuffer(text.encode(), np.uint8)
        return self.hashes(data, np.array([0, len(data)]))[0].tobytes(), None

    def anchor_table(self, kind: int, batch: pa.RecordBatch, length: int, first: int) -> pa.RecordBatch | None:
        """What ``anchor_rows`` gives for bytes; ``first`` is a power of two."""
        column = batch.column(1).cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        words, starts = self.hashes(np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0])
        if len(words) < length:
            return None
        at = np.searchsorted(starts, offsets - offsets[0])
        text_of = np.repeat(np.arange(len(column)), np.diff(at))
        place, low, high = (np.concatenate(x) for x in zip(*anchor_runs(mix(words[:-1] * GOLDEN + words[1:]), len(words), length, first), strict=True))
        text = text_of[place]
        low, high = np.maximum(low, at[text]), np.minimum(high, at[text + 1] - length)  # windows don't cross texts
        text, place, low, stop = (x[low <= high] for x in (text, place, low, high + length))
        firsts, wholes = [], []
        for lane in self.LANES:
            ranks, size = mix(words ^ lane), 1
            while size < first:
                ranks = mix(ranks[:-size] * lane + ranks[size:])
                size *= 2
            whole = mix((stop - low).astype(np.uint64) + lane)
            for ahead in range(0, 2 * length - first, first):
                whole = mix(whole * lane + ranks[np.minimum(low + ahead, stop - first)])
            firsts.append(ranks[place])
            wholes.append(whole)
        # equal runs of a text that touch are one row that counts for all
        order = np.lexsort((low, *firsts, *wholes, text))
        text, place, low, stop, *ranks = (x[order] for x in (text, place, low, stop, *firsts, *wholes))
        new = np.append(True, low[1:] > stop[:-1])[: len(low)]
        for x in (text, *ranks):
            new[1:] |= x[1:] != x[:-1]
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(new)))
        last, begin = stop[head + n - 1], at[text[head]]
        binary = lambda a, b: pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(np.arange(len(head) + 1, dtype=np.int32) * 16), pa.py_buffer(np.stack([a[head], b[head]], 1).tobytes())])
        numbers = [pa.array(x.astype(np.int32)) for x in (n, place[head] - begin, low[head] - begin, stop[head] - length - begin, last - begin)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(head), kind, np.int8)), batch.column(0).take(pa.array(text[head])), binary(*ranks[:2]), binary(*ranks[2:]), *numbers], names=ANCHORS)


class Search(NamedTuple):
    """Strings of ``length`` units; ``first``: the part at an anchor that is ranked at once."""

    unit: type
    length: int
    first: int


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(order: np.ndarray, size: int, length: int, first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor places and the first and last window of each run of windows that share one, a stretch at a time."""
    for at in range(0, size - length + 1, STRETCH):
        windows = min(STRETCH, size - length + 1 - at)
        places = windows + length - first
        packed = order[at : at + places] >> PLACE_BITS << PLACE_BITS | np.arange(places, dtype=np.uint64)
        place = (sliding_least(packed, length - first + 1) & np.uint64((1 << 22) - 1)).astype(np.int64) + at
        cut = np.flatnonzero(np.diff(place)) + 1
        low, high = np.concatenate([[0], cut]), np.concatenate([cut - 1, [windows - 1]])
        yield place[low], low + at, high + at


def joined_runs(rows: list[list]) -> list[list]:
    """Rows ``[first, whole, n, place, low, high, stop]`` of one text, where equal runs that touch are one row that counts for all."""
    out: list[list] = []
    latest: dict[tuple[bytes, bytes], list] = {}
    for row in rows:
        own = latest.get((row[0], row[1]))
        if own is not None and row[4] <= own[6]:
            own[2], own[6] = own[2] + 1, row[6]
            continue
        latest[row[0], row[1]] = row
        out.append(row)
    return out


def table_of(rows: list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def entries(lists: pa.Array) -> tuple[list[int], list[list]]:
    """Lists of records as columns: where each row's records begin and where the last ones end, and the records' fields."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    return [0, *ends.tolist()], [field.to_numpy(zero_copy_only=False).tolist() for field in lists.flatten().flatten()]


def anchor_rows(texts: DataFrame, searches: list[Search]) -> DataFrame:
    """An anchor with its windows a row; ``stop``: end of the text that its ``n`` equal runs cover; ``kind``: the search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers, rows = [s.unit() for s in searches], []
        for batch in by_size(batches, 1, PlainWords.TOGETHER):
            for kind, (units, (unit, length, first)) in enumerate(zip(readers, searches, strict=True)):
                if unit is PlainWords:
                    if (table := units.anchor_table(kind, batch, length, first)) is not None:
                        yield table
                    continue
                w = units.width
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data, order = units.read(text.as_py() or "")
                    for places, lows, highs in anchor_runs(order, len(data) // w, length, first):
                        found = zip(places.tolist(), lows.tolist(), highs.tolist(), strict=True)
                        own = [[digest(data[w * p : w * (p + first)]), digest(data[w * a : w * (b + length)]), 1, p, a, b, b + length] for p, a, b in found]
                        rows += [[kind, key, *row] for row in joined_runs(own)]
                        if len(rows) > ROWS:
                            yield table_of(rows, ANCHOR_KINDS, ANCHORS)
                            rows = []
        if rows:
            yield table_of(rows, ANCHOR_KINDS, ANCHORS)

    return texts.mapInArrow(run, "kind tinyint, key binary, first binary, whole binary, n int, place int, low int, high int, stop int")


def context_rows(texts: DataFrame, searches: list[Search]) -> DataFrame:
    """The listed anchors with the text around them: ``base`` is the place where it begins; places count from there."""
    kinds = [pa.int8(), pa.binary(), pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["kind", "key", "rank", "single", "base", "place", "high", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [s.unit() for s in searches]
        for batch in batches:
            rows, done = [], set()
            at, found = entries(batch.column(2))
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                if key in done:  # an equal text
                    continue
                done.add(key)
                whole, read = text.as_py(), {}
                for first, kind, place, low, high, n in zip(*(field[at[i] : at[i + 1]] for field in found), strict=True):
                    if kind not in read:
                        read[kind] = readers[kind].read(whole)[0]
                    data, w, length = read[kind], searches[kind].unit.width, searches[kind].length
                    rows.append((kind, key, first, n == 1, low, place - low, high - low, data[w * low : w * (high + length)]))
                if len(rows) > ROWS // 10:
                    yield table_of(rows, kinds, names)
                    rows = []
            if rows:
                yield table_of(rows, kinds, names)

    return texts.mapInArrow(run, "kind tinyint, key binary, rank binary, single boolean, base int, place int, high int, context binary")


def pair_rows(runs: DataFrame, size: int, befores: list[int], searches: list[Search]) -> DataFrame:
    """Runs ``(id, kind, place, context, parts)`` cut into runs of ``size`` windows at most, each with its pair of ranks.

    Cuts lie at multiples of ``size`` before the anchor, so equal windows fall into equal runs. ``befores``: a kind's
    size of the parts: what their windows share is ranked already, and the second of the pair ranks what this round adds.
    """
    kinds = [pa.int64(), pa.int8(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    names = ["id", "kind", "single", "rank", "next", "whole", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            at, parts = entries(batch.column(4))
            for i, (own, kind, place, context) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                (unit, length, first), before = searches[kind], befores[kind]
                w, most = unit.width, length - first
                for rank, low, high, single in zip(*(field[at[i] : at[i + 1]] for field in parts), strict=True):
                    far = (place - high) // before * before
                    old, old_end = place - far, place - min(far + before - 1, most) + length
                    for j in range((place - high) // size, (place - low) // size + 1):
                        near, last = j * size, min(j * size + size - 1, most)
                        a, b = max(low, place - last), min(high, place - near)
                        added = digest(context[w * (place - near) : w * old] + context[w * old_end : w * (place - last + length)], (near - far).to_bytes(4, "little"))
                        rows.append((own, kind, single, rank, added, digest(context[w * a : w * (b + length)]), a, b))
                if len(rows) > ROWS:
                    yield table_of(rows, kinds, names)
                    rows = []
        if rows:
            yield table_of(rows, kinds, names)

    return runs.mapInArrow(run, "id bigint, kind tinyint, single boolean, rank binary, next binary, whole binary, low int, high int")


def sizes_of_rounds(windows: int) -> list[int]:
    """Run sizes of the rounds: powers of ``STEP`` below a whole run's, the largest first; the last is one window."""
    sizes = [1]
    while sizes[0] * STEP < windows:
        sizes.insert(0, sizes[0] * STEP)
    return sizes


def repeated_spans(texts: DataFrame, work: Workspace, searches: list[Search]) -> DataFrame:
    """``(key, spans)``: for each text key with repeats, overlapping ranges of units that cover all of them.

    ``spans``: ``kind`` (the search's place in ``searches``), ``low``, ``high``. Ranks of different kinds never meet.
    """
    found = work.keep(anchor_rows(texts, searches), "anchors")
    again = found.groupBy("first").agg(F.sum("n").alias("times")).where("times > 1").select("first")
    shared = work.keep(found.join(again, "first"), "shared")
    work.drop("anchors")
    at = F.struct("key", "kind", "place", "low", "high")
    groups = work.keep(shared.groupBy("first", "whole").agg(F.sum("n").alias("n"), F.min(at).alias("at")), "groups")
    equal = shared.join(groups.where("n > 1").select("first", "whole"), ["first", "whole"], "left_semi")
    settled = work.keep(equal.select("key", "kind", "low", F.col("stop").alias("high")), "settled")
    several = groups.groupBy("first").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("first")
    listed = groups.join(several, "first").groupBy("at.key").agg(F.collect_list(F.struct("first", "at.kind", "at.place", "at.low", "at.high", "n")).alias("anchors"))
    listed = work.keep(listed, "listed")
    work.drop("shared", "groups")
    around = context_rows(texts.join(listed, "key").select("key", "text", "anchors"), searches)
    runs = work.keep(around.withColumn("id", F.monotonically_increasing_id()), "runs")
    work.drop("listed")
    whole_run = F.struct("rank", F.lit(0).alias("low"), "high", "single")
    befores = [s.length - s.first + 1 for s in searches]
    rounds = [sizes_of_rounds(windows) for windows in befores]
    sizes, open_runs, ends = max(rounds, key=len), None, []
    for size in sizes:
        begin = [kind for kind, own in enumerate(rounds) if own[0] == size]
        if begin:
            new = runs.where(F.col("kind").isin(begin)).select("id", "kind", "place", "context", F.array(whole_run).alias("parts"))
            open_runs = open_runs.unionByName(new) if open_runs else new
        rows = work.keep(pair_rows(open_runs, size, befores, searches), f"pairs-{size}")
        own = F.struct("id", "low", "high", "single")
        ranked = work.keep(rows.groupBy("rank", "next", "whole").agg(F.count("*").alias("n"), F.min(own).alias("at"), F.max("single").alias("single")), f"ranked-{size}")
        twice = ranked.where("n > 1 AND single").select("rank", "next", "whole")
        ends.append(work.keep(rows.where("single").join(twice, ["rank", "next", "whole"], "left_semi").select("id", "low", "high"), f"ends-{size}"))
        still = (F.col("n") == 1) & F.col("single")
        several = ranked.groupBy("rank", "next").agg(F.count("*").alias("kinds"), F.max(still).alias("still")).where("kinds > 1 AND still").select("rank", "next")
        new_rank = F.unhex(F.md5(F.concat("rank", "next")))
        parts = ranked.join(several, ["rank", "next"]).select("at.id", F.struct(new_rank.alias("rank"), "at.low", "at.high", still.alias("single")).alias("part"))
        parts = work.keep(parts.groupBy("id").agg(F.collect_list("part").alias("parts")), f"parts-{size}")
        work.drop(f"pairs-{size}", f"ranked-{size}")
        open_runs = runs.select("id", "kind", "place", "context").join(parts, "id").select("id", "kind", "place", "context", "parts")
        befores = [size if size in own else before for own, before in zip(rounds, befores, strict=True)]
    last = ends[0]
    for more in ends[1:]:
        last = last.union(more)
    length = F.array(*[F.lit(s.length) for s in searches])[F.col("kind")]
    last = last.join(runs.select("id", "kind", "key", "base"), "id").select("key", "kind", (F.col("base") + F.col("low")).alias("low"), (F.col("base") + F.col("high") + length).alias("high"))
    spans = work.keep(settled.union(last).groupBy("key").agg(F.collect_set(F.struct("kind", "low", "high")).alias("spans")), "spans")
    work.drop("settled", "runs", *[f"{name}-{size}" for name in ("ends", "parts") for size in sizes])
    return spans


def content_key(text: str):
    """128 bits of the text, which equal texts share."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept, n_repeated_words)`` a row.

    ``kept``: the remaining bytes; ``n_repeated_words``: words in strings of ``WORDS`` words that start at two or more
    places, also where these are too short to be removed. White space between words doesn't count for those.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(content_key(text).alias("key"), F.col(text).alias("text"), F.col(id_column).alias("own_id"))
    long = texts.where(F.octet_length("text") >= min(length, 2 * WORDS - 1)).select("key", "text")
    spans = repeated_spans(long, Workspace(docs.sparkSession, "repeats"), [Search(Bytes, length, first), Search(PlainWords, WORDS, FIRST_WORDS)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [], [], [])
            at_row, (kinds, lows, highs) = entries(batch.column(2))
            for i, text in enumerate(batch.column(1)):
                data, found = (text.as_py() or "").encode(), ([], [])
                for j in range(at_row[i], at_row[i + 1]):
                    found[kinds[j]].append((lows[j], highs[j]))
                runs, words = map(united, found)
                kept, at = [], 0
                for low, high in runs:
                    kept.append(data[at:low])
                    at = high
                kept.append(data[at:])
                for column, value in zip(rows, (len(data), sum(h - lo for lo, h in runs), len(runs), b"".join(kept), sum(h - lo for lo, h in words)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in rows[:3]], pa.array(rows[3], pa.binary()), pa.array(rows[4], pa.int64())], names=[id_column, "n_bytes", "n_removed", "n_spans", "kept", "n_repeated_words"])

    joined = texts.join(spans, "key", "left")
    return joined.select("own_id", "text", "spans").mapInArrow(cut, f"{id_column} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, n_repeated_words bigint")


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, first: int = FIRST, unit: type = Bytes) -> DataFrame:
    """``docs`` with the repeats cut out of the texts and their ``n_chars`` set anew; rows that lose all go.

    A cut inside a character of several bytes drops what is left of that character. Words go with the
    white space behind them.
    """
    names, at = docs.columns, docs.columns.index(text)
    keyed = docs.withColumn("__key", content_key(text))
    texts = keyed.where(F.octet_length(text) >= length).select(F.col("__key").alias("key"), F.col(text).alias("text"))
    spans = repeated_spans(texts, Workspace(docs.sparkSession, "repeats"), [Search(unit, length, first)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words() if unit is Words else None
        for batch in batches:
            kept, alive = [], []
            for value, found in zip(batch.column(at), batch.column(len(names)), strict=True):
                runs = merged(found.as_py()) if found.is_valid else []
                if runs and words:
                    whole, parts, place = value.as_py(), [], 0
                    at_word = words.places(whole)
                    for low, high in runs:
                        parts.append(whole[place : at_word[low]])
                        place = at_word[high]
                    left = "".join([*parts, whole[place:]])
                    kept.append(left)
                    alive.append(bool(left.strip()))
                elif runs:
                    data, parts, place = value.as_py().encode(), [], 0
                    for low, high in runs:
                        parts.append(data[place:low])
                        place = high
                    parts.append(data[place:])
                    left = b"".join(parts).decode("utf-8", "ignore")
                    kept.append(left)
                    alive.append(bool(left))
                else:
                    kept.append(value.as_py())
                    alive.append(True)
            columns = [pa.array(kept, batch.column(at).type) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(alive, pa.bool_()))

    joined = keyed.join(spans.toDF("__key", "__spans"), "__key", "left").select(*names, "__spans")
    out = joined.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast("bigint")).select(*names) if "n_chars" in names else out


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """``united`` for records."""
    return united([(x["low"], x["high"]) for x in spans])


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def removed_by_brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The same by counting every window, for small tests."""
    counts: dict[bytes, int] = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            counts[d[i : i + length]] = counts.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        runs = merged([{"low": i, "high": i + length} for i in range(len(d) - length + 1) if counts[d[i : i + length]] > 1])
        gone = {i for low, high in runs for i in range(low, high)}
        kept = bytes(b for i, b in enumerate(d) if i not in gone)
        out.append((len(d), len(gone), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


def words_left_by_brute_force(texts: list[str], length: int, word: re.Pattern = Words.WORD) -> list[list[str]]:
    """Words outside all strings of ``length`` words that start at two or more places, for small tests."""
    counts: dict[tuple[str, ...], int] = {}
    data = [word.findall(t) for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            counts[tuple(d[i : i + length])] = counts.get(tuple(d[i : i + length]), 0) + 1
    out = []
    for d in data:
        gone = {j for i in range(len(d) - length + 1) if counts[tuple(d[i : i + length])] > 1 for j in range(i, i + length)}
        out.append([w for j, w in enumerate(d) if j not in gone])
    return out
