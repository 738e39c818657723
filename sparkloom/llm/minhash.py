"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find (op 4).

Rows with the same shingle set form one class, named by the 128-bit digest of the set; links are looked for between
classes only, so several rows of one doc_id with different texts keep all their links.
1. Signatures (SuperMinHash with Fisher-Yates ranks, all documents of a batch at a time) fall
   into bands; a bucket is a band value that several classes share.
2. Each class is verified against the most central class of its buckets (the one with most bucket mates).
3. Buckets that still span several components are settled exactly: small ones pair by pair,
   large ones by rare shingles: two sets that overlap enough share one of the rarest
   shingles of each, so only classes of different components meeting at one are verified.
Verification is always on full sets. A pair of similarity 0.8 misses all bands with a chance
of about 3e-6; that is the method's only loss.

Null, empty and blank texts have an empty set, no links, and a component of their own. Repeated
rows of one doc_id stay separate rows with the same result. Null doc_ids link nothing and keep
a null component. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.llm.common import connected_components, few, materialize

BANDS, BAND_ROWS = 24, 4
SLOTS = BANDS * BAND_ROWS
#: Buckets of at most so many classes are settled pair by pair, larger ones by their rare shingles.
PAIRWISE = 24
#: Pairs whose signatures agree less than this are more than five standard deviations below 0.8.
LEAST_AGREEMENT = 0.58

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """Word to a 64-bit hash; bounded."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


def shingles(text: str | None, hashes: WordHash, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; of the whole text if it has fewer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    runs = max(1, n - size + 1)
    out = np.full(runs, min(n, size), np.uint64)
    for i in range(min(n, size)):
        out = mix(out * GOLDEN + values[i : i + runs])
    return np.unique(out)


def superminhash(elements: np.ndarray, owner: np.ndarray, owners: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures ``(owners, slots)``: per element a random permutation of ranks, the least rank and
    fraction per slot. Rank by rank; an owner stops once every slot holds a smaller rank."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    best = np.full(owners * slots, top, np.uint64)
    state, index = elements.copy(), owner.astype(np.int64)
    places = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
    for rank in range(slots):
        state = state + GOLDEN
        drawn = mix(state)
        pick = rank + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - rank) >> np.uint64(32)).astype(np.int64)
        row = np.arange(len(state))
        slot = places[row, pick]
        places[row, pick] = places[:, rank]
        np.minimum.at(best, index * slots + slot, (np.uint64(rank) << np.uint64(32)) | (drawn >> np.uint64(32)))
        highest = best.reshape(owners, slots).max(1)
        going = (highest >> np.uint64(32)) > np.uint64(rank)
        live = going[index]
        if not live.any():
            break
        if live.mean() < 0.7:
            state, index, places = state[live], index[live], places[live]
    return best.reshape(owners, slots)


def signatures(docs: DataFrame, text: str, id_column: str, size: int) -> DataFrame:
    """``(id, n, set_key, signature)``: set size, a 128-bit name of the set, and band-ready slots as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingles(x.as_py(), hashes, size) for x in part.column(1)]
                signed = np.empty((len(sets), SLOTS), "<u4")
                start = 0
                while start < len(sets):  # so many sets that their rank tables stay small
                    stop, total = start, 0
                    while stop < len(sets) and (stop == start or total + len(sets[stop]) <= 150_000):
                        total += len(sets[stop])
                        stop += 1
                    group = sets[start:stop]
                    if total:
                        best = chunked(group)
                        signed[start:stop] = mix(best).astype("<u4")
                    start = stop
                keys = [hashlib.md5(s.tobytes()).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([x.tobytes() if len(s) else None for x, s in zip(signed, sets, strict=True)], pa.binary())],
                    names=[id_column, "n", "set_key", "signature"],
                )
            if len(hashes) > hashes.MOST:
                hashes.clear()

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"{id_column} {kind}, n bigint, set_key binary, signature binary")


def chunked(group: list[np.ndarray]) -> np.ndarray:
    """Signatures of a few sets; one very large set is taken in pieces, whose slot minima are the set's."""
    if len(group) == 1 and len(group[0]) > 150_000:
        parts = [superminhash(p, np.zeros(len(p)), 1) for p in np.array_split(group[0], -(-len(group[0]) // 150_000))]
        return np.minimum.reduce(parts)
    return superminhash(np.concatenate(group), np.repeat(np.arange(len(group)), [len(s) for s in group]), len(group))


def sets_of(docs: DataFrame, wanted: DataFrame, text: str, id_column: str, size: int) -> DataFrame:
    """``(rep, elements)``: the full set of each wanted class as sorted 64-bit bytes; read from rows with the class's smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            found = [shingles(x.as_py(), hashes, size) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(s.tobytes()).digest() for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], names=["rep", "elements"])
            if len(hashes) > hashes.MOST:
                hashes.clear()

    chosen = docs.select(F.col(id_column).alias("low_id"), text).join(few(wanted.select("low_id").distinct(), 16), "low_id", "left_semi")
    made = chosen.select(text).mapInArrow(run, "rep binary, elements binary")
    # an id may stand on several rows of different classes
    return made.join(few(wanted.select("rep"), 40), "rep", "left_semi").dropDuplicates(["rep"])


def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal slots of two columns of signatures."""
    return pd.Series([float((np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")).mean()) for x, y in zip(a, b, strict=True)])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = 0
                if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                    common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(bool(len(p)) and 100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("elements").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("elements").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def components_of(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(rep, component)`` of all nodes under the links so far."""
    found = connected_components(links, "a", "b")
    return nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` a row; sets of runs of ``size`` words, links from ``percent``."""
    from pyspark.sql.functions import pandas_udf

    kind = docs.schema[id_column].dataType
    docs = docs.withColumn(id_column, F.col(id_column).cast("bigint"))
    rows = materialize(signatures(docs, text, id_column, size), "signatures")
    classes = rows.where(F.col("n") > 0).where(F.col(id_column).isNotNull()).groupBy(F.col("set_key").alias("rep")).agg(F.min(id_column).alias("low_id"), F.min("n").alias("n"), F.min("signature").alias("signature"))
    width = 4 * BAND_ROWS
    bands = [F.struct(F.lit(i).alias("band"), F.substring("signature", i * width + 1, width).alias("value")) for i in range(BANDS)]
    banded = classes.select("rep", F.explode(F.array(*bands)).alias("x")).select("rep", F.xxhash64("x.band", "x.value").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("mates")).where("mates > 1")
    shared = materialize(banded.join(sizes, "bucket"), "buckets")
    central = shared.groupBy("rep").agg(F.sum("mates").alias("mates_of_rep"))
    ranked = shared.join(central, "rep")
    best = F.struct("mates_of_rep", "rep")
    pivots = ranked.groupBy("bucket").agg(F.max(best).alias("pivot"))
    stars = (
        ranked.join(pivots, "bucket")
        .groupBy("rep")
        .agg(F.max("pivot").alias("pivot"))
        .select(F.col("rep").alias("a"), F.col("pivot.rep").alias("b"))
        .where("a <> b")
    )
    involved = materialize(classes.join(central.select("rep"), "rep", "left_semi"), "involved")
    sets = materialize(sets_of(docs, involved, text, id_column, size), "sets")
    links = materialize(verify(stars, sets, percent), "links")
    placed = materialize(components_of(involved.select("rep"), links), "placed")

    # buckets that still span several components
    in_bucket = shared.join(placed, "rep")
    spread = in_bucket.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    open_rows = materialize(in_bucket.join(spread, "bucket").select("bucket", "rep", "component", "mates"), "open")
    small = open_rows.where(F.col("mates") <= PAIRWISE)
    other = small.select("bucket", F.col("rep").alias("b"), F.col("component").alias("component_b"))
    near = small.withColumnRenamed("rep", "a").join(other, "bucket").where("a < b AND component <> component_b").select("a", "b").distinct()
    # rare shingles of the classes in large buckets
    large = open_rows.where(F.col("mates") > PAIRWISE).select("rep", "component").distinct()
    elements = large.join(sets, "rep").mapInArrow(_explode, "rep binary, component binary, n bigint, element bigint")
    elements = materialize(elements, "elements")
    counted = elements.groupBy("element").agg(F.count("*").alias("df"))
    order = Window.partitionBy("rep").orderBy("df", "element")
    prefix = (
        elements.join(counted.where("df > 1"), "element", "left")
        .withColumn("df", F.coalesce("df", F.lit(1)))
        .withColumn("place", F.row_number().over(order))
        .where((F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & (F.col("df") > 1))
        .select("element", "rep", "component", "n", "place")
    )
    meeting = prefix.groupBy("element").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("element")
    prefix = materialize(prefix.join(meeting, "element"), "prefix")
    partner = prefix.select("element", F.col("rep").alias("b"), F.col("component").alias("component_b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"))
    # at the first shingle that two sets share, in the order of rarity, what is left of either still reaches the overlap
    left_over = 1 + F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    rare = (
        prefix.withColumnRenamed("rep", "a")
        .join(partner, "element")
        .where((F.col("a") < F.col("b")) & (F.col("component") != F.col("component_b")) & ((100 + percent) * left_over >= percent * (F.col("n") + F.col("n_b"))))
        .select("a", "b")
        .distinct()
    )
    agree = pandas_udf(agreement, "double")
    signed = involved.select("rep", "signature")
    candidates = (
        near.union(rare)
        .distinct()
        .join(signed.toDF("a", "signature_a"), "a")
        .join(signed.toDF("b", "signature_b"), "b")
        .where(agree("signature_a", "signature_b") >= LEAST_AGREEMENT)
        .select("a", "b")
    )
    more = verify(candidates, sets, percent)
    links = materialize(links.union(more), "links")
    final = involved.select("rep", "low_id").join(components_of(involved.select("rep"), links), "rep")
    lowest = final.groupBy("component").agg(F.min("low_id").alias("least"))
    final = final.join(lowest, "component").select("rep", "least")
    named = classes.join(final, "rep", "left").select(F.col("rep").alias("set_key"), F.coalesce("least", "low_id").alias("component_id"))
    out = rows.select(id_column, F.col("n").alias("n_shingles"), "set_key").join(named, "set_key", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col(id_column).isNotNull(), F.col("component_id")).otherwise(F.col(id_column))
    out = out.select(id_column, "n_shingles", own.alias("component_id"))
    return out.select(F.col(id_column).cast(kind), "n_shingles", "component_id", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)).alias("kept"))


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each element of the sets."""
    for batch in batches:
        for rep, component, data in zip(*(batch.column(i) for i in range(3)), strict=True):
            found = np.frombuffer(data.as_py(), np.int64)
            n = len(found)
            yield pa.RecordBatch.from_arrays([pa.repeat(rep, n), pa.repeat(component, n), pa.array(np.full(n, n)), pa.array(found)], names=["rep", "component", "n", "element"])
