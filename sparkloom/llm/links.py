"""Near-duplicate vectors by navigable small-world graphs per shard (op 9).

Rows are dealt by hash into shards of bounded size; each shard's vectors form a hierarchical graph (layers
halving by a fixed factor, links chosen by nearness), which one task builds and stores with the vectors. The task also
queries the shard with its own vectors, which gives the shard's linked groups. Then every shard queries every shard
behind it with the stored graph: a greedy descent through the layers, then a beam at the bottom, all queries in
lockstep, and from the links that it finds on over neighbours near the threshold, so that large
groups need no wide beam. A task audits queries against the whole
shard until it has seen a fixed number that have links there (rare links: all queries, which settles them), and
widens beams until the audit finds every link; where it still doesn't, the block is computed exactly. Cosines are in
double precision; the graph only proposes. A link is found once and counts at both ends.

A task returns link counts of its rows and which groups of two shards are linked, so a large group gives as many rows as
it has members, not their square. Equal vectors are one node that counts
for all its rows, whatever their ids; rows that share an id stay rows of their own, each with the links of its own vector. Vectors that are null or zero, or hold null or non-finite components, are
components of their own without links. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.ann import usable
from sparkloom.llm.common import Workspace, connected_components, materialize

SHARD, SHARDS_AT_LEAST, DEGREE, BEAM, WIDEST, AUDIT = 50_000, 4, 16, 32, 512, 64


class Graph:
    """Layers of neighbour tables over unit vectors; nodes go in by blocks, each linked to what is there."""

    def __init__(self, x: np.ndarray, seed: int = 3):
        self.x, self.rough = x, x.astype(np.float32)  # beams only propose
        n = len(x)
        level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int), 6)
        order = np.argsort(-level, kind="stable")
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # nodes of a layer (global), neighbour rows
        top = level.max() if n else 0
        for at in range(top, -1, -1):
            nodes = order[: (level >= at).sum()]
            self.layers.append((nodes, self.link(nodes)))

    def stored(self) -> list[bytes]:
        """For each node its place in the order of insertion and its neighbour rows, from the bottom layer up."""
        order = self.layers[-1][0] if self.layers else np.empty(0, np.int64)
        rows = [[np.array([i], "<i4")] for i in range(len(order))]
        for _, table in reversed(self.layers):
            for i, row in enumerate(table):
                rows[i].append(row.astype("<i4"))
        out = [b""] * len(order)
        for node, parts in zip(order.tolist(), rows, strict=True):
            out[node] = np.concatenate(parts).tobytes()
        return out

    @classmethod
    def restored(cls, x: np.ndarray, stored: list[bytes]) -> "Graph":
        """The graph of :meth:`stored`'s rows, in the order of ``x``."""
        graph, parts = cls.__new__(cls), [np.frombuffer(s, "<i4") for s in stored]
        order = np.argsort([p[0] for p in parts])
        heights = np.array([(len(parts[i]) - 1) // (2 * DEGREE) for i in order])
        graph.x, graph.rough, graph.layers = x, x.astype(np.float32), []
        for at in range(heights.max(), 0, -1):
            count = int((heights >= at).sum())  # higher nodes come first
            rows = [parts[i][1 + (at - 1) * 2 * DEGREE : 1 + at * 2 * DEGREE] for i in order[:count]]
            graph.layers.append((order[:count], np.stack(rows).astype(np.int64)))
        return graph

    def link(self, nodes: np.ndarray) -> np.ndarray:
        """Neighbour table of one layer: by beam search in the part that stands, and links back."""
        n, most = len(nodes), 2 * DEGREE
        table = np.full((n, most), -1, np.int64)
        x = self.rough[nodes]
        begun = min(n, 256)
        near = x[:begun] @ x[:begun].T
        np.fill_diagonal(near, -2)
        k = min(DEGREE, begun - 1)
        if k > 0:
            table[:begun, :k] = np.argsort(-near, axis=1, kind="stable")[:, :k]
        at = begun
        while at < n:
            stop = min(n, 2 * at, at + 2048)
            block = np.arange(at, stop)
            found, _ = beam(x, table, x[block], np.zeros((len(block), 1), np.int64), BEAM)
            chosen = found[:, :DEGREE]
            within = x[block] @ x[block].T  # nodes of one block see each other too
            np.fill_diagonal(within, -2)
            k = min(DEGREE // 2, len(block) - 1)
            mates = block[np.argpartition(-within, k - 1, axis=1)[:, :k]] if k else np.empty((len(block), 0), np.int64)
            both = np.concatenate([chosen, mates], axis=1)
            score = np.where(both >= 0, np.einsum("bd,bkd->bk", x[block], x[both]), -3)
            best = np.take_along_axis(both, np.argsort(-score, axis=1, kind="stable")[:, : DEGREE + DEGREE // 2], 1)
            table[block, : best.shape[1]] = best
            # links back, in the free places; a full row keeps its nearest
            for node, row in zip(block, chosen, strict=True):
                for other in row[row >= 0][:8]:
                    own = table[other]
                    free = np.flatnonzero(own < 0)
                    if len(free):
                        own[free[0]] = node
                    else:
                        far = np.argmin(x[own] @ x[other])
                        if x[own[far]] @ x[other] < x[node] @ x[other]:
                            own[far] = node
            at = stop
        return table

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes and their cosines in single precision, best first, by descent and a beam of ``width``."""
        queries = queries.astype(np.float32)
        entry = np.zeros((len(queries), 1), np.int64)
        for depth, (nodes, table) in enumerate(self.layers):
            last = depth == len(self.layers) - 1
            found, score = beam(self.rough[nodes], table, queries, entry, width if last else 4)
            entry = found[:, : 4 if not last else width]
            if last:
                return np.where(found >= 0, nodes[found], -1), score
        return np.empty((len(queries), 0), np.int64), np.empty((len(queries), 0))


    def reach(self, queries: np.ndarray, seeds: list[np.ndarray], least: float, slack: float) -> list[np.ndarray]:
        """All nodes within the threshold that links lead to from each query's seeds, over nodes within it less ``slack``."""
        nodes, table = self.layers[-1]
        n, x = len(nodes), self.x[nodes]
        place = np.empty(n, np.int64)
        place[nodes] = np.arange(n)
        # links count both ways, so that no node lacks a way in
        here, there = np.nonzero(table >= 0)[0], table[table >= 0]
        start, stop = np.concatenate([here, there]), np.concatenate([there, here])
        stop = stop[np.argsort(start, kind="stable")]
        begin = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=n))])
        out, seen = [], np.zeros(64 * n, bool)
        for at in range(0, len(queries), 64):
            part, own = queries[at : at + 64], seeds[at : at + 64]
            front = np.concatenate([i * n + place[s] for i, s in enumerate(own)])
            seen[front] = True
            touched, near = [front], [front]
            while len(front):
                at_node = front % n
                many = begin[at_node + 1] - begin[at_node]
                ahead = np.repeat(begin[at_node] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                key = np.unique(np.repeat(front - at_node, many) + stop[ahead])
                key = key[~seen[key]]
                seen[key] = True
                touched.append(key)
                score = np.einsum("kd,kd->k", part[key // n], x[key % n])
                near.append(key[score >= least])
                front = key[score >= least - slack]
            seen[np.concatenate(touched)] = False
            key = np.sort(np.concatenate(near))
            out += [nodes[k - i * n] for i, k in enumerate(np.split(key, np.searchsorted(key, np.arange(1, len(part)) * n)))]
        return out


def beam(x: np.ndarray, table: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in lockstep: each step opens every query's best unopened nodes."""
    m = len(queries)
    ids = np.full((m, width), -1, np.int64)
    score = np.full((m, width), -4, x.dtype)
    opened = np.ones((m, width), bool)
    k = min(entry.shape[1], width)
    ids[:, :k] = entry[:, :k]
    score[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("bd,bkd->bk", queries, x[ids[:, :k]]), -4)
    opened[:, :k] = ids[:, :k] < 0
    live = np.arange(m)
    while len(live):
        want = np.where(opened[live], -9.0, score[live])
        at = want.argmax(1)
        go = want[np.arange(len(live)), at] > -4
        live, at = live[go], at[go]
        if not len(live):
            break
        opened[live, at] = True
        fresh = table[ids[live, at]]
        seen = (fresh[:, :, None] == ids[live][:, None, :]).any(2) | (fresh < 0)
        fresh = np.where(seen, -1, fresh)
        row, column = np.nonzero(~seen)
        got = np.full(fresh.shape, -4, score.dtype)
        got[row, column] = np.einsum("kd,kd->k", queries[live[row]], x[fresh[row, column]])
        both_ids, both = np.concatenate([ids[live], fresh], 1), np.concatenate([score[live], got], 1)
        both_open = np.concatenate([opened[live], seen], 1)
        order = np.argpartition(-both, width - 1, axis=1)[:, :width]  # the last step sorts
        ids[live] = np.take_along_axis(both_ids, order, 1)
        score[live] = np.take_along_axis(both, order, 1)
        opened[live] = np.take_along_axis(both_open, order, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)


def exact(x: np.ndarray, queries: np.ndarray, least: float) -> list[np.ndarray]:
    """Nodes with a cosine of at least ``least`` for each of a few queries, by comparing all."""
    row, node = np.nonzero(queries @ x.T >= least - 1e-9)
    fine = np.einsum("kd,kd->k", queries[row], x[node]) >= least
    return np.split(node[fine], np.searchsorted(row[fine], np.arange(1, len(queries))))


def linked(graph: Graph, queries: np.ndarray, least: float, seed: int = 1, own: bool = False) -> list[np.ndarray]:
    """Nodes with a cosine of at least ``least`` for each query; ``own``: the queries are the nodes themselves.

    A beam finds the first of them; from these the search goes on over neighbours within the threshold, less a
    slack. Nodes start from their own place, and need a beam only if that isn't enough. Beam and slack widen until the audited queries have all their links; else all are compared.
    """
    n, width, slack = len(graph.x), 0 if own else BEAM, 0.05
    truth: dict[int, np.ndarray] = {}
    seen, order = 0, np.random.default_rng(seed).permutation(len(queries))
    for at in range(0, len(order), 64):
        part = order[at : at + 64]
        for q, row in zip(part.tolist(), exact(graph.x, queries[part], least), strict=True):
            truth[q] = row
            seen += len(row) > own  # a node's link to itself is no link
        if seen >= AUDIT:
            break
    while len(truth) < len(queries):
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        step = max(16, 400_000 // (width + 64))
        for at in range(0, len(queries), step):
            some_queries = np.arange(at, min(at + step, len(queries)))
            seeds = [np.array([q])[: int(own)] for q in some_queries]
            if width:
                ids, score = graph.search(queries[some_queries], min(width, n))
                row, at_rank = np.nonzero((score >= least - 1e-5) & (ids >= 0))
                node = ids[row, at_rank]
                fine = np.einsum("kd,kd->k", queries[some_queries[row]], graph.x[node]) >= least
                found = np.split(node[fine], np.searchsorted(row[fine], np.arange(1, len(some_queries))))
                seeds = [np.union1d(s, more) for s, more in zip(seeds, found, strict=True)]
            some = np.flatnonzero([len(s) for s in seeds])
            for q, row in zip(some_queries[some], graph.reach(queries[some_queries[some]], [seeds[i] for i in some], least, slack), strict=True):
                out[q] = row
        if all(len(np.intersect1d(out[q], t)) == len(t) for q, t in truth.items()):
            return [truth.get(q, row) for q, row in enumerate(out)]
        if width >= min(n, WIDEST):
            for at in range(0, len(queries), 64):
                truth.update(enumerate(exact(graph.x, queries[at : at + 64], least), at))
        width, slack = max(BEAM, width * 4), slack * 2
    return [truth[q] for q in range(len(queries))]


def both_ways(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """The same links of nodes among themselves, each at both of its ends."""
    n = len(pairs)
    row, other = np.repeat(np.arange(n), [len(p) for p in pairs]), np.concatenate([*pairs, np.empty(0, np.int64)]).astype(np.int64)
    keys = np.unique(np.concatenate([row * n + other, other * n + row]))
    return np.split(keys % max(n, 1), np.searchsorted(keys // max(n, 1), np.arange(1, n)))


def groups_of(pairs: list[np.ndarray]) -> np.ndarray:
    """Smallest node of each node's linked group; links stand at both ends. Labels sink over links and over themselves."""
    n = len(pairs)
    label = np.arange(n)
    flat = np.concatenate([np.append(p, i) for i, p in enumerate(pairs)]).astype(np.int64) if n else label
    begin = np.cumsum([0, *[len(p) + 1 for p in pairs]])[:-1]
    while n:
        low = np.minimum.reduceat(label[flat], begin)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return label


def units(rows: pd.DataFrame) -> np.ndarray:
    x = np.stack(rows["v"].to_list()).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", least: float = 0.9) -> DataFrame:
    """``(id, n_links, component_id, kept)`` a row."""
    work = Workspace(vectors.sparkSession, "links")
    name = lambda v: F.md5(F.array_join(v.cast("array<string>"), ",", "null"))
    fine = usable(vectors, vector, id_column).withColumn("name", name(F.col("v")))
    # a node's key is its least id, made positive, and its name: in order of ids, and of its own where vectors share an id
    placed_id = F.lpad((F.min("id").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    nodes = work.keep(fine.groupBy("name").agg(F.any_value("v").alias("v"), F.concat(placed_id, "name").alias("key"), F.count("*").alias("n")), "nodes")
    count = nodes.count()
    shards = max(SHARDS_AT_LEAST, -(-count // SHARD))
    dealt = nodes.select("key", "v", "n", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("w"))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        x, keys, n = units(rows), rows["key"].to_numpy(), rows["n"].to_numpy()
        graph = Graph(x)
        found = both_ways(linked(graph, x, least, own=True))
        others = [int(n[row].sum() - n[i] * (row == i).sum()) for i, row in enumerate(found)]
        return rows.assign(family=keys[groups_of(found)], links=others, graph=graph.stored())

    grown = work.keep(dealt.groupBy("w", "shard").applyInPandas(grow, "key string, v array<double>, n bigint, shard int, w int, family string, links bigint, graph binary"), "graphs")
    behind = F.explode(F.sequence(F.col("shard") + 1, F.lit(shards - 1)))
    before = F.explode(F.sequence(F.lit(0), F.col("shard") - 1))
    asked = grown.where(F.col("shard") < shards - 1).select("key", "v", "n", "w", "family", F.col("shard").alias("block"), behind.alias("shard"))
    held = grown.where("shard > 0").select("key", "v", "n", "w", "family", "graph", "shard", before.alias("block"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"key": [], "links": [], "family": [], "other": []}, dtype=object)
        left, right = left.sort_values("key"), right.sort_values("key")
        graph = Graph.restored(units(right), right["graph"].to_list())
        found = linked(graph, units(left), least)
        many, other = left["n"].to_numpy(), right["n"].to_numpy()
        here, there, pairs = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64), set()
        families, their = left["family"].to_numpy(), right["family"].to_numpy()
        for i, row in enumerate(found):
            if len(row):
                here[i] = other[row].sum()
                there[row] += many[i]
                pairs.update((families[i], f) for f in set(their[row]))
        counts = pd.DataFrame({"key": np.concatenate([left["key"], right["key"]]), "links": np.concatenate([here, there])})
        counts, joined = counts[counts["links"] > 0], sorted(pairs)
        empty, none = [None] * len(counts), [None] * len(joined)
        columns = {"key": [*counts["key"], *none], "links": [*counts["links"].tolist(), *none], "family": [*empty, *(a for a, _ in joined)], "other": [*empty, *(b for _, b in joined)]}
        return pd.DataFrame(columns, dtype=object)

    found = asked.groupBy("w", "block", "shard").cogroup(held.groupBy("w", "block", "shard")).applyInPandas(meet, "key string, links bigint, family string, other string")
    found = work.keep(found, "found")
    more = found.where("key IS NOT NULL").groupBy("key").agg(F.sum("links").alias("more"))
    named = connected_components(found.where("family IS NOT NULL").select("family", "other"), "family", "other")
    placed = grown.select("key", "links", "family").join(more, "key", "left").join(named.withColumnRenamed("node", "family"), "family", "left")
    placed = nodes.select("name", "key", "n").join(placed, "key")
    component = (F.substring(F.coalesce("component", "family"), 1, 20).cast("decimal(20,0)") - F.lit(str(2**63)).cast("decimal(20,0)")).cast("bigint")
    placed = placed.select("name", component.alias("component"), (F.col("links") + F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("links"))
    placed = materialize(placed, "linked")
    work.drop("nodes", "graphs", "found")
    rows = vectors.select(F.col(id_column), name(F.col(vector).cast("array<double>")).alias("name"))
    ids = F.col(id_column).cast("bigint")
    joined = rows.join(placed, "name", "left")
    part = F.col("links").isNotNull() & ids.isNotNull()
    component = F.when(part, F.col("component")).otherwise(ids)
    return joined.select(id_column, F.when(part, F.col("links")).otherwise(0).alias("n_links"), component.alias("component_id"), F.coalesce(component == ids, F.lit(True)).alias("kept"))
