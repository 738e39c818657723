"""Quality classifier: averaged hashed word and character n-gram vectors with a softmax (op 1).

Training is numpy gradient descent on a bounded sample of labelled rows (``SAMPLE`` rows by
hash order, whole texts); scoring covers every row. As the document vector is
an average and the softmax is linear in it, a word's n-gram vectors reduce to one number
after training, which scoring keeps in a bounded per-task table.

Null and empty texts have no features and get the score of the output bias alone (clipped to 0..1),
ties and repeated rows get equal scores, and extra columns are not read.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a model is fitted on at most; the labelled rows with the smallest hashes.
SAMPLE = 3000
BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 17, 8, 8, 0.4
NGRAMS = (2, 3, 4)
#: Stands for a word that repeats the word before it.
AGAIN = "\u0001again"


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams between boundary marks."""
    return list(buckets_of(word))


def buckets_of(word: str) -> Iterator[int]:
    """The buckets one by one, as a word without spaces can be as long as its text."""
    if word == AGAIN:
        yield zlib.crc32(AGAIN.encode()) % BUCKETS
        return
    marked = f"<{word}>"
    yield zlib.crc32(marked.encode("utf-8", "replace")) % BUCKETS
    for n in NGRAMS:
        for i in range(len(marked) - n + 1):
            yield zlib.crc32(marked[i : i + n].encode("utf-8", "replace")) % BUCKETS


class WordTable(dict):
    """Word to what ``value`` makes of its features; cleared when it has grown too large."""

    MOST = 350_000

    def __init__(self, value):
        self.value = value

    LONGEST = 64  # longer words are taken whole too, but not kept

    def __missing__(self, word: str):
        if len(word) > self.LONGEST:
            return self.value(np.fromiter(buckets_of(word), np.int32))
        found = self.value(word_features(word))
        if len(self) >= self.MOST:
            self.clear()
        self[word] = found
        return found


def words_of(text: str | None) -> tuple[list[str], int]:
    """Words of a text, and how many of them repeat the word before them."""
    words = (text or "").split()
    return words, sum(map(operator.eq, words, words[1:]))


def sample_features(labelled: DataFrame, text: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature counts of the training rows as flat arrays: row, bucket, weight, and the rows' labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(lambda f: f)
        for batch in batches:
            sizes, features = [], []
            for value in batch.column(0):
                words, again = words_of(value.as_py())
                flat = np.fromiter((x for w in words for x in table[w]), np.int32)
                flat = np.concatenate([flat, np.full(again, table[AGAIN][0], np.int32)])
                found, counts = np.unique(flat, return_counts=True)
                sizes.append(len(found))
                features.append(packed(found, counts))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(features, pa.binary()), batch.column(1)], names=["size", "features", "label"])

    rows = labelled.select(text, F.col(label).cast("int").alias("label")).mapInArrow(run, "size int, features binary, label int").collect()
    starts = np.cumsum([0, *[r["size"] for r in rows]])
    labels = np.array([r["label"] for r in rows])
    ids, weights = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.float32)
    for i in range(len(rows) - 1, -1, -1):  # each row is let go as it is read
        at = slice(starts[i], starts[i + 1])
        ids[at], counts = unpacked(rows.pop()["features"])
        weights[at] = counts / max(1, counts.sum())
    return starts, ids, weights, labels


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending ids and their counts, compressed: both are held by the driver several times on their way to it."""
    return zlib.compress(np.concatenate([np.diff(ids, prepend=0), counts]).astype("<i4").tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.split(np.frombuffer(zlib.decompress(data), "<i4"), 2)
    return np.cumsum(steps), counts


def train(starts: np.ndarray, ids: np.ndarray, weights: np.ndarray, labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, output matrix and bias by stochastic gradient descent with a falling rate."""
    rng = np.random.default_rng(seed)
    embeddings = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    n, step = len(labels), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(n):
            rate = RATE * (1 - step / (EPOCHS * n))
            step += 1
            at = slice(starts[i], starts[i + 1])
            own, share = ids[at], weights[at, None]
            hidden = (embeddings[own] * share).sum(0)
            logits = output @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output.T @ p
            output -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            # a document's average spreads its gradient thinly, so the rate of the embeddings is larger
            embeddings[own] -= rate * 20 * share * back
    return embeddings, output, bias


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """A weight per bucket (one logit) and the bias, from labelled rows outside the held-out fold."""
    chosen = (
        labels.select(id_column, label)
        .where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & (F.crc32(F.col(id_column).cast("string")) % 5 != 0))
        .groupBy(id_column)
        .agg(F.max(label).alias(label))
        .orderBy(F.xxhash64(F.col(id_column)), id_column)
        .limit(sample)
    )
    labelled = docs.select(id_column, text).join(F.broadcast(chosen), id_column)  # at most ``sample`` rows
    starts, ids, weights, found = sample_features(labelled, text, label)
    if len(set(found.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), float(20.0 * (2 * found.mean() - 1)) if len(found) else 0.0
    embeddings, output, bias = train(starts, ids, weights, found)
    return embeddings @ (output[1] - output[0]), float(bias[1] - bias[0])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``(id, held_out, score)`` of every row."""
    weights, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(lambda f: (float(weights[f].sum()), len(f)))
        for batch in batches:
            found = [1 / (1 + np.exp(-logit(x.as_py(), table, bias))) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_column, "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    scored = docs.select(id_column, text).mapInArrow(run, f"{id_column} {kind}, score double")
    return scored.select(id_column, (F.crc32(F.col(id_column).cast("string")) % 5 == 0).alias("held_out"), "score")


def keep(docs: DataFrame, model: tuple[np.ndarray, float], least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with their columns."""
    weights, bias = model
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(lambda f: (float(weights[f].sum()), len(f)))
        for batch in batches:
            chosen = [logit(value.as_py(), table, bias) for value in batch.column(at)]
            yield batch.filter(pa.array([1 / (1 + np.exp(-x)) >= least for x in chosen], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def logit(text: str | None, table: WordTable, bias: float) -> float:
    """Log odds of label 1, clipped to 30."""
    words, again = words_of(text)
    pairs = [table[w] for w in words] + [table[AGAIN]] * again
    size = sum([n for _, n in pairs])
    return float(np.clip(bias + (sum([v for v, _ in pairs]) / size if size else 0.0), -30, 30))
