"""Spelling variants of words by an index of variable-length grams (op 13).

1. Words are counted over the whole table (a task adds up its own words first).
2. Gram dictionary: substrings of the padded words from ``SHORTEST`` to ``LONGEST`` characters are counted over all words; what more than
   ``share`` of all places hold is kept, so the dictionary has at most ``GRAMS`` entries however many words there are.
3. At each place a word has the shortest gram that isn't in the dictionary (of ``LONGEST`` characters at most). Which one that is
   depends on the gram's own characters alone, so an edit affects the grams that hold its place and no others.
4. Affected grams: the fewest distinct grams that any edit leaves are what a word shares with each word one edit away, at the
   same place from the beginning (before the edit) or the end (behind it). Of its grams, rarest first, a word is listed
   under as many as can be affected, and one more: then any two such words meet in a list.
5. Lists are merged by a join on gram, place and length, so only words whose lengths fit meet; both must have enough grams left
   behind the shared one, and the edit distance decides. A pair that meets in several lists counts once.
A gram out of reach of an edit exists in every word of seven characters: no pair is lost, and none is left to a comparison of all.

Null and empty texts have no words; a null doc_id counts as an empty string before the colon. Repeated rows count again. Extra
columns aren't read. An empty table gives no rows. Runs of any length are whole.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import Workspace, by_size

SHORTEST, LONGEST = 3, 5
#: Most entries of the gram dictionary, and the fewest words that hold one.
GRAMS, FREQUENT = 100_000, 40
#: A word's form has at least so many times its occurrences.
FACTOR = 10
START, END = "<<<", ">>"
#: Characters of text that are taken together.
SLICE = 4_000_000


def word_counts(docs: DataFrame, text: str, id_column: str, least: int, every: int) -> DataFrame:
    """``(word, n)``: runs of letters, lower-cased in A to Z, of at least ``least`` characters once a character of some is left out.

    Of a run whose checksum with the document's id is divisible by ``every``, the character that the checksum names is left out.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, 1, SLICE):
            found: Counter[str] = Counter()
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    check = zlib.crc32(run.encode(), seed)
                    if check % every == 0:
                        at = check % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    found[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return docs.select(id_column, text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, shortest: int, longest: int, most: int, frequent: int) -> dict[str, int]:
    """Grams with the number of their places, of those that are frequent; ``most`` at most, as each needs that share of all places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word in batch.column(0).to_pylist():
                padded = START + word + END
                for q in range(shortest, longest + 1):
                    found.update([padded[at : at + q] for at in range(len(padded) - q + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "df"])

    length = len(START) + len(END) + 1
    places = words.agg(F.sum((F.length("word") + length) * (longest - shortest + 1))).first()[0] or 0
    least = max(frequent, -(-places // most))
    counted = words.select("word").mapInArrow(count, "gram string, df bigint").groupBy("gram").agg(F.sum("df").alias("df"))
    return {r.gram: r.df for r in counted.where(F.col("df") > least).toLocalIterator()}


def decompose(word: str, dictionary: dict[str, int], shortest: int, longest: int) -> tuple[list[tuple[str, int]], int]:
    """The grams of a padded word with their places, and the least number of distinct ones that an edit leaves unaffected."""
    grams, n = [], len(word)
    covered = [0] * (n + 1)
    for at in range(n - shortest + 1):
        end = at + shortest
        while end < n and end - at < longest and word[at:end] in dictionary:
            end += 1
        grams.append((word[at:end], at))
        covered[at] += 1
        covered[end] -= 1
    edits = range(len(START), n - len(END))
    if len({g for g, _ in grams}) == len(grams):
        depth = list(itertools.accumulate(covered))
        return grams, len(grams) - max(depth[i] for i in edits)
    return grams, min(len({g for g, at in grams if at > i or at + len(g) <= i}) for i in edits)


def listed(words: DataFrame, dictionary, shortest: int, longest: int) -> DataFrame:
    """``(gram, place, word, length, rest, least)``: the lists that a word is in; ``rest`` of its grams are no rarer than this one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = dictionary.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for word in batch.column(0).to_pylist():
                grams, least = decompose(START + word + END, common, shortest, longest)
                order = sorted({g for g, _ in grams}, key=lambda g: (common.get(g, 0), g))
                rest = {g: len(order) - i for i, g in enumerate(order[: len(order) - least + 1])}
                for gram, at in grams:
                    if gram in rest:
                        for column, value in zip(columns, (gram, at, word, len(word), rest[gram], least), strict=True):
                            column.append(value)
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["gram", "place", "word", "length", "rest", "least"])

    return words.select("word").mapInArrow(split, "gram string, place int, word string, length int, rest int, least int")


def near_words(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, most: int = GRAMS, frequent: int = FREQUENT) -> DataFrame:
    """``(a, b)``: all pairs of words of at least seven characters that differ by one inserted, deleted or replaced character, each once."""
    dictionary = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, shortest, longest, most, frequent))
    lists = listed(words, dictionary, shortest, longest)
    # places from the beginning for words of equal length, and for either side of the edit where one is longer by one
    front, back = F.col("place"), F.col("place") - F.col("length") - 1000
    key = lambda place, length: F.xxhash64("gram", place, length)
    mine = lists.select(F.explode(F.array(key(front, F.col("length")), key(back, F.col("length")))).alias("key"), "word", "rest", "least")
    shorter = F.col("length") - 1
    theirs = lists.select(
        F.explode(F.array(key(front, F.col("length")), key(front, shorter), key(F.col("place") - shorter - 1001, shorter))).alias("key"),
        F.col("word").alias("word_b"), F.col("rest").alias("rest_b"), F.col("least").alias("least_b"),
    )
    twice = (F.length("word") < F.length("word_b")) | (F.col("word") < F.col("word_b"))
    enough = F.least("rest", "rest_b") >= F.greatest("least", "least_b")
    met = mine.join(theirs, "key").where(twice & enough & (F.levenshtein("word", "word_b", 1) == 1))
    return met.select(F.col("word").alias("a"), F.col("word_b").alias("b")).distinct()


def spelling_variants(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least: int = 7, every: int = 31, occurrences: int = 2, factor: int = FACTOR) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: each word's most frequent near word if that has ``factor`` times its occurrences, and the last form."""
    if least < 7:
        raise ValueError("the bound of affected grams needs words of seven characters")
    space = Workspace(docs.sparkSession, "spelling")
    words = space.keep(word_counts(docs, text, id_column, least, every).where(F.col("n") >= occurrences), "words")
    pairs = space.keep(near_words(words), "pairs")
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    nearest = ranked.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("minus"), "b")).alias("best"))
    is_form = -F.col("best.minus") >= factor * F.col("n")
    formed = words.join(nearest, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.b")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n"))
    formed = space.keep(formed, "formed")
    # each step multiplies the occurrences by ``factor``: chains are short, and jumps double what they span
    roots, step = space.keep(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step += 1
        jumped = space.keep(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{step}")
        space.drop(f"roots-{step - 1}")
        if not jumped.where("moved").limit(1).count():
            break
        roots = jumped.drop("moved")
    return formed.join(jumped.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
