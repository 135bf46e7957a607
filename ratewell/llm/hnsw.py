"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Equal vectors are one node with its smallest ids, as many as a result can name. Nodes are dealt into shards of a bounded
size; a task builds the shard's graph once as flat arrays (one row of neighbours per node and level), which is written in
rows of PART nodes. Queries are dealt into blocks of about BLOCK; a search task reads one shard's graph and one block, so
that neither the queries nor the results of a task grow with the table. Vectors get one more component that makes their norms equal, so that the largest inner product is the
shortest distance. The shards' results are merged and scored in double precision on the original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id. Repeated rows
of one id and vector count once. Vectors of different lengths only meet their own kind. Ties go to the smaller id. A query
with fewer candidates than asked for gets all of them. No vectors: no rows. Only vec_id and embedding are read, so other
columns can have any name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TOP, EVERY = 20, 20
SHARD, DEGREE, BUILD, BEAM, FANOUT = 4096, 20, 64, 96, 16
BLOCK, PART = 1024, 256


class Graph:
    """A small-world graph over unit-norm rows of x: levels[l] has the neighbours of every node at level l (-1: none)."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x, n = x, len(x)
        draw = np.random.RandomState(seed).random_sample(n)
        self.height = np.minimum((-np.log(draw) / np.log(FANOUT)).astype(int), 4)
        self.order = np.argsort(-self.height, kind="stable")  # upper levels first: node order[0] is the entry
        self.levels = [np.full((n, (2 if l == 0 else 1) * DEGREE), -1, np.int32) for l in range(int(self.height.max(initial=0)) + 1)]
        done = 1
        while done < n:
            batch = self.order[done:done + max(1, min(256, done // 2))]
            self._insert(batch, done)
            done += len(batch)

    @classmethod
    def read(cls, x: np.ndarray, entry: int, links: np.ndarray) -> Graph:
        """A graph that was built before: its entry and the neighbours of all levels side by side, the lowest first."""
        graph = cls.__new__(cls)
        graph.x, graph.order = x, np.array([entry])
        graph.levels = [links[:, :2 * DEGREE], *[links[:, lo:lo + DEGREE] for lo in range(2 * DEGREE, links.shape[1], DEGREE)]]
        return graph

    def _insert(self, batch: np.ndarray, done: int) -> None:
        """Search the graph of the nodes so far for the whole batch, then link it, also among itself."""
        entry = np.repeat(self.order[:1], len(batch))
        for level in range(len(self.levels) - 1, -1, -1):
            found, close = self._beam(self.x[batch], entry[:, None], level, BUILD if level <= self.height[batch].max() else 1)
            entry = found[:, 0]
            mine = np.flatnonzero(self.height[batch] >= level)
            if not len(mine):
                continue
            peers = batch[mine]
            among = self.x[peers] @ self.x[peers].T
            np.fill_diagonal(among, -np.inf)
            ids = np.concatenate([found[mine], np.broadcast_to(peers, (len(mine), len(mine)))], axis=1)
            near = np.concatenate([close[mine], among], axis=1)
            ids = np.where(np.isfinite(near), ids, -1)
            for row, node in enumerate(peers):
                self._link(level, node, ids[row], near[row])

    def _choose(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in different directions first: one that is nearer to a chosen one than to the node waits."""
        order = np.argsort(-near, kind="stable")
        ids, near = ids[order], near[order]
        ids, near = ids[ids >= 0][:3 * most], near[ids >= 0][:3 * most]
        if len(ids) <= most:
            return ids
        between = self.x[ids] @ self.x[ids].T
        chosen: list[int] = []
        for k in range(len(ids)):
            if not chosen or between[k, chosen].max() < near[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
        rest = [k for k in range(len(ids)) if k not in set(chosen)]
        return ids[(chosen + rest)[:most]]

    def _link(self, level: int, node: int, ids: np.ndarray, near: np.ndarray) -> None:
        links = self.levels[level]
        own = self._choose(ids, near, DEGREE)
        links[node, :len(own)] = own
        for other in own:
            free = np.flatnonzero(links[other] < 0)
            if node in links[other]:
                continue
            if len(free):
                links[other, free[0]] = node
            else:
                all_ids = np.append(links[other], node)
                kept = self._choose(all_ids, self.x[all_ids] @ self.x[other], links.shape[1])
                links[other] = -1
                links[other, :len(kept)] = kept

    def _beam(self, q: np.ndarray, entry: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best `width` nodes per query, best first, by best-first search of all queries in step."""
        m, links = len(q), self.levels[level]
        seen = np.zeros((m, len(self.x)), bool)
        rows = np.arange(m)
        ids = np.full((m, width), -1, np.int64)
        near = np.full((m, width), -np.inf, np.float32)
        opened = np.ones((m, width), bool)
        ids[:, 0] = entry[:, 0]
        near[:, 0] = np.einsum("ij,ij->i", q, self.x[entry[:, 0]])
        opened[:, 0] = False
        seen[rows, entry[:, 0]] = True
        while True:
            waiting = np.where(opened, -np.inf, near)
            pick = waiting.argmax(axis=1)
            live = np.flatnonzero(np.isfinite(waiting[rows, pick]))
            if not len(live):
                return ids, near
            opened[live, pick[live]] = True
            around = links[ids[live, pick[live]]].astype(np.int64)
            new = (around >= 0) & ~seen[live[:, None], np.maximum(around, 0)]
            r, c = np.nonzero(new)
            seen[live[r], around[r, c]] = True
            worth = np.where(new, np.einsum("ijk,ik->ij", self.x[np.maximum(around, 0)], q[live]), -np.inf).astype(np.float32)
            all_near = np.concatenate([near[live], worth], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            near[live] = np.take_along_axis(all_near, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(new, around, -1)], axis=1), best, 1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], ~new], axis=1), best, 1)

    def search(self, q: np.ndarray, top: int, beam: int = BEAM) -> np.ndarray:
        entry = np.repeat(self.order[:1], len(q))
        for level in range(len(self.levels) - 1, 0, -1):
            entry = self._beam(q, entry[:, None], level, 1)[0][:, 0]
        return self._beam(q, entry[:, None], 0, max(beam, top))[0][:, :top]


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (doubles), key (digest of the vector) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    whole = rows.select("vec_id", v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0))
    # Zeros of either sign are one value.
    return whole.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).withColumn("key", F.unhex(F.md5(F.to_json("v"))))


def named(rows: DataFrame, most: int) -> DataFrame:
    """key, ids (the `most` smallest): first per key and salt, then per key, so that no key's ids meet in one task."""
    rows = rows.select("key", "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for by in (("key", "salt"), ("key",)):
        rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("n") <= most)
    return rows.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most `most`


def lifted(v: np.ndarray) -> np.ndarray:
    """Unit-norm single-precision rows: one more component makes the norms equal."""
    norms = (v * v).sum(axis=1)
    return (np.c_[v, np.sqrt(np.maximum(norms.max() - norms, 0))] / np.sqrt(norms.max())).astype(np.float32)


def graphs(nodes: DataFrame, shards: int) -> DataFrame:
    """size, shard, part and the entry, vectors, neighbours, keys and ids of PART nodes of the shard's graph."""

    def built(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("key")
        v = np.array(own.v.tolist(), np.float64)
        graph = Graph(lifted(v))
        links, rows = np.concatenate(graph.levels, axis=1), []
        for part, lo in enumerate(range(0, len(own), PART)):
            some = own.iloc[lo:lo + PART]
            rows.append((some["size"].iloc[0], some.shard.iloc[0], part, int(graph.order[0]), v[lo:lo + PART].tobytes(), links[lo:lo + PART].tobytes(), list(some.key), list(some.ids)))
        return pd.DataFrame(rows, columns=["size", "shard", "part", "entry", "v", "links", "keys", "ids"])

    dealt = nodes.withColumn("size", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return dealt.groupBy("size", "shard").applyInPandas(built, "size int, shard int, part int, entry int, v binary, links binary, keys array<binary>, ids array<array<long>>")


def searched(parts: DataFrame, distinct: DataFrame, top: int, block: int) -> DataFrame:
    """q_key, key, ids, score: the best top + 1 nodes of every shard, one task for each shard and block of queries."""

    def found(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asks):
            own, size = own.sort_values("part"), int(own["size"].iloc[0])
            v = np.frombuffer(b"".join(own.v)).reshape(-1, size)
            graph = Graph.read(lifted(v), int(own.entry.iloc[0]), np.frombuffer(b"".join(own.links), np.int32).reshape(len(v), -1))
            keys, ids = [k for some in own["keys"] for k in some], [i for some in own.ids for i in some]
            q, q_keys = np.array(asks.q.tolist(), np.float64), asks.q_key.to_numpy()
            unit = np.c_[q / np.sqrt((q * q).sum(axis=1))[:, None], np.zeros(len(q))].astype(np.float32)
            for lo in range(0, len(q), 512):
                for k, at in enumerate(graph.search(unit[lo:lo + 512], top + 1), lo):
                    at = at[at >= 0]
                    for node, s in zip(at, v[at] @ q[k]):
                        out.append((q_keys[k], keys[node], ids[node], float(s)))
        return pd.DataFrame(out, columns=["q_key", "key", "ids", "score"])

    blocks = max(1, -(-distinct.count() // block))
    asked = distinct.withColumn("size", F.size("q")).withColumn("block", F.pmod(F.xxhash64("q_key"), F.lit(blocks)).cast("int"))
    each = asked.join(parts.where("part = 0").select("size", "shard"), "size")
    copies = parts.join(asked.select("size", "block").distinct(), "size")
    keys = ("size", "shard", "block")
    # Both sides come from the same two frames: new names keep their columns apart.
    copies, each = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (copies, each))
    return copies.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInPandas(found, "q_key binary, key binary, ids array<long>, score double")


def nearest(rows: DataFrame, queries: DataFrame, top: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the `top` nearest rows other than the query's own. queries: vec_id, embedding."""
    asked = usable(queries).dropDuplicates(["vec_id", "key"])
    known = usable(rows)
    nodes = stored(known.groupBy("key").agg(F.first("v").alias("v")).join(named(known, top + 1), "key"), "ann-nodes")
    parts = stored(graphs(nodes, max(1, -(-nodes.count() // shard))), "ann-graphs")
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("key").alias("q_key")), "ann-queries")
    hits = searched(parts, asked.select("q", "q_key").dropDuplicates(["q_key"]), top, block)
    best = hits.withColumn("n", F.row_number().over(Window.partitionBy("q_key").orderBy(F.desc("score"), F.element_at("ids", 1)))).where(F.col("n") <= top + 1)
    each = asked.join(best, "q_key").select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def search_table(rows: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """Queries: the rows whose id is divisible by `every`."""
    return nearest(rows, rows.where(F.col("vec_id") % every == 0), top)
