"""Mixture-controlled packing by deficit round-robin over source queues (op 3).

Every document is one stretch of its source's queue. Block ``b`` of ``n`` takes from the
queue of a source with ``T`` tokens what lies between ``T*b/n`` and ``T*(b+1)/n``, rounded
down to whole quanta; what the rounding withholds is the deficit that the next block starts
with. So blocks are independent tasks, and yet deficits carry across them. Inside a block a
round-robin fills one window after the other: each window adds a source's share to its
credit, sources with a credit of a quantum or more are served, and the rest is carried on.
Windows run across block ends, so only the last sequence of all can be short; it is cut
into powers of two, which need no padding.

Null texts and sources count as empty text and as a source of their own; an empty text
still has its end id. Repeated rows and repeated doc_ids are packed each for itself. An empty table gives no
pieces. Very long texts are cut over as many windows as they need.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import by_size, materialize

WINDOW = 4096
END_ID = 2
#: Smallest stretch of a source that a window is filled with, where the source has as much.
QUANTUM = 128
#: Windows a block: a block's plan is made by one task, which sees lengths only.
BLOCK_WINDOWS = 64


class WordIds:
    """Words to their ids. Ids never cross a space or line break, so a text's ids are its words' ids in a row.

    Texts of Latin letters are taken in lower case, as the vocabulary's normalizer does, and full stops and commas
    behind words as words of their own, so that fewer different words are met. A batch's words are numbered by Arrow,
    each different one is looked up once, and Arrow lays the ids out. A word of letters, the common case, goes to the
    library's merge model as the library's own steps before it would hand it over (bytes as letters); marks behind
    letters are a piece of their own; all other words go through the library whole. When half the table is full, the
    other half goes, and words met since stay. The table serves all tasks of a worker process.
    """

    MOST, LONGEST = 240_000, 80
    LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    #: Letters with marks behind them; an apostrophe may take letters into its piece, and "<" may begin a special token.
    MARKED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]+)")
    #: A mark behind another: these are one piece, which a space would part.
    MARKS_MEET = re.compile(r"[.,] (?<=[^\w\s].\x20)")
    #: Characters of the texts that are laid out together.
    CHARACTERS = 4_000_000
    shared: dict[str, WordIds] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        letters = [chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha()]
        self.as_bytes = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        probe = ["haus", "été", "straße", "a", "niño", "word", "zoë"]
        self.direct = self.of_letters(probe) == [self.whole(w) for w in probe] == [self.whole(w.title()) for w in probe]
        self.parted = self.direct and self.of_marked([(w, "$.!") for w in probe]) == [self.whole(f"{w}$.!") for w in probe]

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls.shared:
            cls.shared[path] = cls(path)
        return cls.shared[path]

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters."""
        tokenize = self.tokenizer.model.tokenize
        ready = "\n".join(words).lower()
        if not ready.isascii():
            for letter, pair in self.as_bytes.items():  # no pair holds a letter of these
                ready = ready.replace(letter, pair)
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in ready.split("\n")]

    def of_marked(self, parts: list[tuple[str, str]]) -> list[bytes]:
        """Ids of words of Latin letters with marks behind them."""
        if len(self.marks) > self.MOST // 10:
            self.marks.clear()
        for marks in {m for _, m in parts}.difference(self.marks):
            self.marks[marks] = self.whole(marks)
        return [ids + self.marks[m] for ids, (_, m) in zip(self.of_letters([w for w, _ in parts]), parts, strict=True)]

    def ready(self, text: str) -> str:
        """A text whose words stand between single spaces."""
        text = text.replace("\n", " ")
        if self.direct and is_latin(text) and "<|" not in text:
            text = text.lower()
            if not self.MARKS_MEET.search(text):
                text = text.replace(". ", " . ").replace(", ", " , ")
        return text

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of different words."""
        if len(self.known) > self.MOST // 2:
            self.older, self.known = self.known, {}
        out = list(map(self.known.get, words))
        missed = [w for w, ids in zip(words, out, strict=True) if ids is None]
        fresh = {w: ids for w, ids in zip(missed, map(self.older.get, missed), strict=True) if ids is not None}
        new = [w for w in missed if w not in fresh] if fresh else missed
        if self.direct:
            plain = [w for w in new if w.isascii() and w.isalpha()]
            other = [w for w in new if not (w.isascii() and w.isalpha())]
            letters = [w for w in other if self.LETTERS.fullmatch(w)]
            for some in (plain, letters):  # apart, as only the second ones need their bytes replaced
                fresh.update(zip(some, self.of_letters(some), strict=True) if some else ())
            new = [w for w in other if w not in fresh] if letters else other
        if self.parted:
            marked = {w: found.groups() for w in new if (found := self.MARKED.fullmatch(w))}
            fresh.update(zip(marked, self.of_marked(list(marked.values())), strict=True) if marked else ())
            new = [w for w in new if w not in marked]
        fresh.update((w, self.whole(w)) for w in new)
        self.known.update(fresh if max(map(len, missed), default=0) <= self.LONGEST else {w: ids for w, ids in fresh.items() if len(w) <= self.LONGEST})
        return [fresh[w] if ids is None else ids for w, ids in zip(words, out, strict=True)]

    def encode(self, texts: list[str], end: int) -> pa.Array:
        """Little-endian 32-bit ids of each whole text, with the id ``end`` behind."""
        ready = [self.ready(t) for t in texts]
        words = pc.split_pattern(pa.array([" ".join(ready)], pa.large_string()), " ").values.dictionary_encode()
        # one string that Python splits: a word at a time takes longer than its lookup
        different = pc.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary), pa.scalar(" ", pa.large_string()))
        ids = self.learn(different[0].as_py().split(" "))
        stops = np.cumsum([t.count(" ") + 1 for t in ready])
        code = np.insert(words.indices.to_numpy(), stops, len(ids))
        laid = pa.array([*ids, array("I", [end]).tobytes()], pa.large_binary()).take(pa.array(code))
        places = np.frombuffer(laid.buffers()[1], np.int64)[: len(code) + 1]
        offsets = places[np.concatenate([[0], stops + np.arange(1, len(texts) + 1)])].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), laid.buffers()[2]])


def is_latin(text: str) -> bool:
    """True if all characters are below 256: none of them combines with another, or changes with its place in lower case."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def tokenize(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", source: str = "source") -> DataFrame:
    """``(id, source, n, ids)`` a row: the little-endian 32-bit ids with the end id, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        for batch in by_size(batches, 2, words.CHARACTERS):
            ids = words.encode([x or "" for x in batch.column(2).to_pylist()], END_ID)
            n = pc.cast(pc.divide(pc.binary_length(ids), 4), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n, ids], names=[id_column, "queue", "n", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(id_column, F.coalesce(F.col(source).cast("string"), F.lit("\0")).alias("queue"), text)
    return chosen.mapInArrow(run, f"{id_column} {kind}, queue string, n bigint, ids binary")


def block_start(total: int, b: int, blocks: int) -> int:
    """Tokens of a queue of ``total`` that lie before block ``b``: whole quanta, but all at the end."""
    return total if b >= blocks else total * b // (blocks * QUANTUM) * QUANTUM


def segments(batches: Iterator[pd.DataFrame], total: int, blocks: int) -> Iterator[pd.DataFrame]:
    """Cuts documents at block borders: a row for each block that a document lies in."""
    for batch in batches:
        out = []
        for uid, queue, queued, start, n in zip(batch["uid"], batch["queue"], batch["queued"], batch["start"], batch["n"], strict=True):
            at, end = int(start), int(start + n)
            b = min(blocks - 1, (at // QUANTUM + 1) * QUANTUM * blocks // int(queued))
            while b > 0 and block_start(int(queued), b, blocks) > at:
                b -= 1
            while at < end:
                while block_start(int(queued), b + 1, blocks) <= at:
                    b += 1
                stop = min(end, block_start(int(queued), b + 1, blocks))
                out.append((b, uid, queue, int(queued), at, at - int(start), stop - at))
                at = stop
        yield pd.DataFrame(out, columns=["block", "uid", "queue", "queued", "at", "start", "length"])


def round_robin(block: int, rows: pd.DataFrame, before: int, total: int, blocks: int, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(uid, start, length, sequence_id, offset)`` of one block; ``before``: tokens in the blocks before it."""
    rows = rows.sort_values(["queue", "at"], kind="stable")
    queues = []
    columns = zip(*(rows[c].tolist() for c in ("queue", "queued", "uid", "start", "length")), strict=True)
    for (_, queued), part in groupby(columns, itemgetter(0, 1)):
        documents = [x[2:] for x in part]
        share = queued / total
        credit = queued * block / blocks - block_start(queued, block, blocks)
        queues.append([share, credit, sum(x[2] for x in documents), documents, 0, 0])
    pieces, place, left = [], before, sum(q[2] for q in queues)

    def serve(q: list, tokens: int) -> None:
        nonlocal place, left
        q[1] -= tokens
        q[2] -= tokens
        left -= tokens
        while tokens:
            uid, start, length = q[3][q[4]]
            take = min(tokens, length - q[5])
            if pieces and pieces[-1][0] == uid and pieces[-1][1] + pieces[-1][2] == start + q[5] and pieces[-1][3] == place // window:
                pieces[-1] = (*pieces[-1][:2], pieces[-1][2] + take, *pieces[-1][3:])
            else:
                pieces.append((uid, start + q[5], take, place // window, place % window))
            place, tokens, q[5] = place + take, tokens - take, q[5] + take
            if q[5] == length:
                q[4], q[5] = q[4] + 1, 0

    while left:
        room = min(window - place % window, left)
        for q in queues:
            q[1] += q[0] * room
        for q in sorted(queues, key=lambda q: -q[1]):
            amount = min(int(q[1]), q[2], room)
            if amount >= min(QUANTUM, q[2]) and amount > 0:
                serve(q, amount)
                room -= amount
        while room:  # what rounding and short queues leave goes to the largest credit
            q = max((q for q in queues if q[2]), key=lambda q: q[1])
            amount = min(room, q[2])
            serve(q, amount)
            room -= amount
    return pieces


def pack(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", source: str = "source", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of all rows: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue)``, and ``ids`` if asked."""
    spark = docs.sparkSession
    tokens = materialize(tokenize(docs, path, text, id_column, source).withColumn("uid", F.monotonically_increasing_id()), "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    kind = docs.schema[id_column].dataType.simpleString()
    columns = f"{id_column} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, queue string" + ", ids binary" * with_ids
    if not total:
        return spark.createDataFrame([], columns)
    blocks = max(1, -(-total // (window * BLOCK_WINDOWS)))
    # places in the queues: sums of salted stretches of a queue first, so that a large source isn't one group
    stretches = 4 * math.isqrt(blocks) + 1
    lengths = tokens.select("uid", "queue", "n").withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(stretches)))
    sums = lengths.groupBy("queue", "salt").agg(F.sum("n").alias("in_salt"))
    in_queue = Window.partitionBy("queue").orderBy("salt")
    sums = sums.select("queue", "salt", (F.sum("in_salt").over(in_queue) - F.col("in_salt")).alias("salt_start"))
    queued = lengths.groupBy("queue").agg(F.sum("n").alias("queued"))
    in_salt = Window.partitionBy("queue", "salt").orderBy("uid")
    placed = (
        lengths.withColumn("in_salt", F.sum("n").over(in_salt) - F.col("n"))
        .join(sums, ["queue", "salt"])
        .join(queued, "queue")
        .select("uid", "queue", "queued", (F.col("salt_start") + F.col("in_salt")).alias("start"), "n")
    )
    cut = materialize(
        placed.mapInPandas(lambda x: segments(x, total, blocks), "block bigint, uid bigint, queue string, queued bigint, at bigint, start bigint, length bigint"),
        "segments",
    )
    # tokens before each block: sums over groups of blocks first, then inside a group
    sizes = cut.groupBy("block").agg(F.sum("length").alias("size")).withColumn("group", F.floor(F.col("block") / (math.isqrt(blocks) + 1)))
    in_order = Window.orderBy("group")  # a row for each group of blocks only
    groups = sizes.groupBy("group").agg(F.sum("size").alias("in_group")).select("group", (F.sum("in_group").over(in_order) - F.col("in_group")).alias("group_start"))
    in_group = Window.partitionBy("group").orderBy("block")
    per_block = sizes.withColumn("inside", F.sum("size").over(in_group) - F.col("size")).join(groups, "group").select("block", (F.col("group_start") + F.col("inside")).alias("before"))

    def plan(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = round_robin(int(key[0]), group, int(group["before"].iloc[0]), total, blocks, window)
        return pd.DataFrame(found, columns=["uid", "start", "length", "sequence_id", "offset"])

    pieces = cut.join(per_block, "block").groupBy("block").applyInPandas(plan, "uid bigint, start bigint, length bigint, sequence_id bigint, offset bigint")
    by_row = pieces.groupBy("uid").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    last = total // window  # the last window, if it isn't full, falls into powers of two
    tail = total % window

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, queues, sizes, ids, found = (batch.column(i) for i in range(5))
            flat = found.flatten()
            rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(found).to_numpy())
            start, length, sequence, offset = (flat.field(i).to_numpy() for i in range(4))
            if (sequence == last).any():
                cut = [(i, *part) for i, *piece in zip(*(x.tolist() for x in (rows, start, length, sequence, offset)), strict=True) for part in powers(*piece, last, tail)]
                rows, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*cut, strict=True))
            data = memoryview(ids.buffers()[2])
            begin = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset :][rows] + 4 * start
            chunks = [data[low:high] for low, high in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
            take, crc = pa.array(rows), pa.array(map(zlib.crc32, chunks), pa.int64())
            arrays = [keys.take(take), pa.array(start), pa.array(length), crc, sizes.take(take), pa.array(sequence), pa.array(offset), queues.take(take)]
            arrays += [pa.array(map(bytes, chunks), pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split(" ")[0] for c in columns.split(", ")])

    return tokens.join(by_row, "uid").select(id_column, "queue", "n", "ids", "pieces").mapInArrow(emit, columns)


def powers(start: int, length: int, sequence: int, offset: int, last: int, tail: int) -> Iterator[tuple[int, int, int, int]]:
    """A piece as it is, or cut where the last, short window falls into powers of two."""
    if sequence != last:
        yield start, length, sequence, offset
        return
    base, number = 0, last
    for bit in sorted((1 << i for i in range(tail.bit_length()) if tail >> i & 1), reverse=True):
        low, high = max(offset, base), min(offset + length, base + bit)
        if low < high:
            yield start + low - offset, high - low, number, low - base
        base, number = base + bit, number + 1
