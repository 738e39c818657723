"""Nearest neighbours by a hierarchical k-means tree with best-bin-first traversal (op 2).

The tree is fitted on a bounded sample (``SAMPLE`` vectors by hash order), so it has a bounded
size and travels with the tasks. Every row is put into a leaf; a leaf's rows fall into blocks of
bounded size, and so do its queries, so that many equal vectors don't meet in one task. A query visits leaves in the order of a
priority queue over lower distances to centres; how many is calibrated: a bounded set of
queries (``AUDIT``) is compared with all rows, and the smallest number of visits that reaches
``RECALL`` is taken, widening up to all leaves, and for each query until its leaves hold enough candidates.

Vectors that are null or zero, or hold null or non-finite components, take no part; those of each length are searched among
themselves, with a tree of their own. Repeated ids stay separate candidates, but for the query's own id. A query that is there
several times is asked once; several vectors of one query id are queries of their own, each with its ranks. An empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import materialize

SAMPLE, BRANCHES, LEAF, AUDIT, RECALL = 16_000, 8, 64, 128, 0.97
BLOCK_ROWS = 4096
#: Queries of a leaf that meet a block in one task.
BLOCK_QUERIES = 1024


def usable(vectors: DataFrame, vector: str, id_column: str) -> DataFrame:
    """``(id, v)`` with v as doubles, of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(id_column).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col(id_column).cast("bigint").alias("id"), v.alias("v"))


class Tree:
    """Centres of a k-means hierarchy over a sample; nodes are numbered, leaves too."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a child below zero is leaf ``-child - 1``
        self.leaves = 0
        self.rng = np.random.default_rng(seed)
        self.root = self.grow(sample)

    def grow(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF or len(np.unique(rows[:256], axis=0)) < 2:
            self.leaves += 1
            return -self.leaves
        centres = rows[self.rng.choice(len(rows), BRANCHES, replace=False)]
        for _ in range(8):
            near = nearest(rows, centres)
            centres = np.array([rows[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
        near = nearest(rows, centres)
        used = [j for j in range(len(centres)) if (near == j).any()]
        if len(used) < 2:
            self.leaves += 1
            return -self.leaves
        at = len(self.centres)
        self.centres.append(centres[used])
        self.children.append([])
        self.children[at] = [self.grow(rows[near == j]) for j in used]
        return at

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest centre at every level."""
        out = np.zeros(len(rows), np.int64)
        stack = [(self.root, np.arange(len(rows)))]
        while stack:
            node, own = stack.pop()
            if node < 0:
                out[own] = -node - 1
                continue
            near = nearest(rows[own], self.centres[node])
            stack += [(child, own[near == j]) for j, child in enumerate(self.children[node]) if (near == j).any()]
        return out

    def visit(self, query: np.ndarray, most: int, sizes: dict[int, int] | None = None, rows: int = 0) -> list[int]:
        """Leaves in best-bin-first order: always on to the open branch with the nearest centre; more than ``most`` until they hold ``rows`` rows."""
        queue, out, held = [(0.0, self.root)], [], 0
        while queue and (len(out) < most or held < rows):
            _, node = heapq.heappop(queue)
            while node >= 0:
                apart = ((self.centres[node] - query) ** 2).sum(1)
                order = np.argsort(apart, kind="stable")
                for j in order[1:]:
                    heapq.heappush(queue, (float(apart[j]), self.children[node][j]))
                node = self.children[node][order[0]]
            out.append(-node - 1)
            held += sizes.get(-node - 1, 0) if sizes else 0
        return out


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def closest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest of ``rows``, exact in double precision, own id left out."""
    out = []
    x, ids = np.stack(rows["v"].to_list()), rows["id"].to_numpy()
    for query, name, v in zip(queries["query_id"], queries["name"], queries["v"], strict=True):
        apart = np.sqrt(((x - np.asarray(v)) ** 2).sum(1))
        apart[ids == query] = np.inf
        pick = np.lexsort((ids, apart))[:k] if len(ids) <= 4 * k else (lambda p: p[np.lexsort((ids[p], apart[p]))][:k])(np.flatnonzero(apart <= np.partition(apart, k)[k]))
        out += [(query, name, ids[p], apart[p]) for p in pick if np.isfinite(apart[p])]
    return pd.DataFrame(out, columns=["query_id", "name", "vec_id", "score"])


def top(found: DataFrame, k: int) -> DataFrame:
    """The k nearest per query out of the tasks' lists; a list has k entries at most."""
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    return found.groupBy("query_id", "name").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def search(vectors: DataFrame, queries: DataFrame, vector: str = "embedding", id_column: str = "vec_id", k: int = 10, recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: nearest rows of ``vectors`` for every row of ``queries``."""
    rows, asked = usable(vectors, vector, id_column), usable(queries, vector, id_column)
    asked = asked.select(F.col("id").alias("query_id"), F.md5(F.array_join(F.col("v").cast("array<string>"), ",")).alias("name"), "v").dropDuplicates(["query_id", "name"])
    # a query's own rows are passed over, so its leaves must hold so many more
    own = rows.join(asked.select(F.col("query_id").alias("id")).distinct(), "id", "left_semi").groupBy(F.col("id").alias("query_id")).agg(F.count("*").alias("own"))
    asked = asked.join(own, "query_id", "left").select("query_id", "name", "v", F.coalesce("own", F.lit(0)).alias("own"))
    widths = [r["w"] for r in rows.select(F.size("v").alias("w")).distinct().orderBy("w").collect()]  # lengths of vectors: one, as a rule
    found = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for width in widths:
        found = found.union(search_length(*(df.where(F.size("v") == width) for df in (rows, asked)), k, recall))
    return found


def search_length(rows: DataFrame, asked: DataFrame, k: int, recall: float) -> DataFrame:
    """:func:`search` over ``(id, v)`` for ``(query_id, name, v, own)``, all of one length."""
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).collect()])  # bounded
    tree = Tree(sample)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.assign(np.stack(batch["v"].to_list())))

    placed = materialize(rows.mapInPandas(assign, "id bigint, v array<double>, leaf bigint"), "leaves")
    in_leaf = placed.groupBy("leaf").agg(F.count("*").alias("rows"))
    sizes = {r["leaf"]: r["rows"] for r in in_leaf.collect()}  # bounded by the tree, which is fitted on a bounded sample
    blocks = in_leaf.select("leaf", F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"))
    placed = placed.join(blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))

    # calibration: the true neighbours' leaves against the order of visits
    audit = asked.orderBy(F.xxhash64("query_id"), "query_id", "name").limit(AUDIT).toPandas()  # bounded

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = closest(audit, batch, k)
                yield found.merge(batch[["id", "leaf"]].drop_duplicates(), left_on="vec_id", right_on="id")[["query_id", "name", "vec_id", "score", "leaf"]]

    lists = placed.select("id", "v", "leaf").mapInPandas(scan, "query_id bigint, name string, vec_id bigint, score double, leaf bigint")
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id", "leaf"))), 1, k)
    truth = lists.groupBy("query_id", "name").agg(best.alias("best")).collect()  # bounded: AUDIT rows of k
    ranks = []
    vector_of = dict(zip(audit["name"], audit["v"], strict=True))
    for row in truth:
        order = {leaf: i + 1 for i, leaf in enumerate(tree.visit(np.asarray(vector_of[row["name"]]), tree.leaves))}
        ranks += [order[b["leaf"]] for b in row["best"]]
    ranks.sort()
    visits = ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))] if ranks else tree.leaves

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["query_id", "name", "v"]].assign(leaf=[tree.visit(np.asarray(v), visits, sizes, k + own) for v, own in zip(batch["v"], batch["own"], strict=True)])

    routed = asked.mapInPandas(route, "query_id bigint, name string, v array<double>, leaf array<bigint>").select("query_id", "name", "v", F.explode("leaf").alias("leaf"))
    routed = materialize(routed, "routed")
    parts = routed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("parts"))
    routed = routed.join(blocks, "leaf").join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
    routed = routed.select("query_id", "name", "v", "leaf", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = placed.join(parts, "leaf").select("id", "v", "leaf", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return closest(left, right, k) if len(left) and len(right) else pd.DataFrame({"query_id": [], "name": [], "vec_id": [], "score": []})

    found = routed.groupBy("leaf", "block", "part").cogroup(met.groupBy("leaf", "block", "part")).applyInPandas(meet, "query_id bigint, name string, vec_id bigint, score double")
    return top(found, k)
