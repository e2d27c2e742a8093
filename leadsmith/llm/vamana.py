"""Nearest neighbours by inner product over robust-pruned directed graphs, one per shard.

Equal vectors are one node of the index and carry the smallest ids that hold them, so a
vector that a third of the rows share is indexed and searched once.  Nodes are dealt to
shards by the hash of the vector.  A shard's graph grows in batches: a greedy beam search
from the entry point proposes neighbours, relaxed distance pruning (a candidate goes if a
kept neighbour is ``alpha`` times nearer to it than the point is) keeps diverse edges, reverse
edges are added and pruned in turn.  Inner products become distances by one more component
that gives all vectors of the shard the same norm.

A search runs the beam on every shard for a block of queries and merges the best by a
window per query.  Scores are exact inner products in double precision of the original
vectors.  Every row is indexed; the graph (``degree``, ``beam``, ``alpha``) decides recall only.

Defined results: null or zero vectors and vectors with a null or non-finite component take no
part; vectors of several lengths are searched length by length; rows with equal vectors tie and the
smaller id comes first; a row repeated under its own id counts once; a query never returns
its own id; fewer candidates than ``k`` are all returned; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadsmith.llm.common import staged

K = 20
SHARDS = 12
#: Nodes of one shard, at most about; more nodes make more shards.
SHARD_ROWS = 20_000
DEGREE, BEAM, ALPHA = 32, 64, 1.2
#: Queries searched in one task.
QUERY_BLOCK = 50_000
BATCH = 512
#: A query's beam is this many times the beam of building: a full shard then finds over 0.9 of the nearest.
QUERY_BEAM = 2


def _distances(points: np.ndarray, of: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances from rows ``of`` to the points numbered ``to`` (row by row)."""
    d = points[to] - of[:, None, :]
    return np.einsum("bkd,bkd->bk", d, d)


class Graph:
    """A directed graph over the rows of ``x`` with at most ``degree`` out-edges each."""

    def __init__(self, x: np.ndarray, entry: int = 0, edges: np.ndarray | None = None):
        self.x, self.entry = np.ascontiguousarray(x, np.float32), entry
        self.edges = edges  # (n, degree), -1: none

    def search(self, q: np.ndarray, beam: int, visited: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Node numbers (-1: none) and distances, nearest first; ``visited``: all expanded nodes join the answer."""
        b, n = len(q), len(self.x)
        start = np.full((b, 1), self.entry)
        node = np.full((b, beam), -1)
        dist = np.full((b, beam), np.inf, np.float32)
        node[:, :1], dist[:, :1] = start, _distances(self.x, q, start)
        done = np.zeros((b, beam), bool)
        seen = np.zeros((b, n), bool)
        seen[:, self.entry] = True
        rows = np.arange(b)
        expanded = [[], []]
        while True:
            open_ = np.where(done | (node < 0), np.inf, dist)
            best = open_.argmin(axis=1)
            live = np.isfinite(open_[rows, best])
            if not live.any():
                break
            act = rows[live]
            at = node[act, best[live]]
            done[act, best[live]] = True
            if visited:
                ids = np.full(b, -1)
                ds = np.full(b, np.inf, np.float32)
                ids[act], ds[act] = at, dist[act, best[live]]
                expanded[0].append(ids)
                expanded[1].append(ds)
            near = self.edges[at]
            fresh = (near >= 0) & ~seen[act[:, None], near]
            seen[act[:, None], np.where(fresh, near, self.entry)] = True
            d = np.where(fresh, _distances(self.x, q[act], near), np.inf).astype(np.float32)
            all_d = np.concatenate([dist[act], d], axis=1)
            all_n = np.concatenate([node[act], np.where(fresh, near, -1)], axis=1)
            all_done = np.concatenate([done[act], np.zeros(near.shape, bool)], axis=1)
            order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            dist[act] = np.take_along_axis(all_d, order, 1)
            node[act] = np.take_along_axis(all_n, order, 1)
            done[act] = np.take_along_axis(all_done, order, 1)
        if visited and expanded[0]:
            extra = np.stack(expanded[0], 1), np.stack(expanded[1], 1)
            known = (extra[0][:, :, None] == node[:, None, :]).any(axis=2)
            node = np.concatenate([node, np.where(known, -1, extra[0])], axis=1)
            dist = np.concatenate([dist, np.where(known, np.inf, extra[1])], axis=1)
        node = np.where(np.isfinite(dist), node, -1)
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(node, order, 1), np.take_along_axis(dist, order, 1)

    def prune(self, of: np.ndarray, cand: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Diverse out-edges of the points ``of`` among candidates sorted by distance."""
        b, c = cand.shape
        alive = (cand >= 0) & (cand != of[:, None])
        out = np.full((b, degree), -1)
        rows = np.arange(b)
        for slot in range(degree):
            live = alive.any(axis=1)
            if not live.any():
                break
            first = alive.argmax(axis=1)
            pick = cand[rows, first]
            out[live, slot] = pick[live]
            act = rows[live]
            between = _distances(self.x, self.x[pick[act]], np.where(cand[act] >= 0, cand[act], 0))
            alive[act] &= ~(alpha * alpha * between <= dist[act])
            alive[act, first[act]] = False
        return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 42) -> Graph:
    """Insert the rows in random order, in batches that at most double the graph."""
    n = len(x)
    g = Graph(x)
    g.entry = int(np.argmin(((g.x - g.x.mean(axis=0)) ** 2).sum(axis=1))) if n else 0
    g.edges = np.full((n, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[g.entry], order[order != g.entry]]) if n else order
    at = 1
    while at < n:
        batch = order[at:at + min(BATCH, at)]
        cand, dist = g.search(g.x[batch], beam, visited=True)
        g.edges[batch] = g.prune(batch, cand, dist, degree, alpha)
        # reverse edges, gathered per target
        src = np.repeat(batch, degree)
        dst = g.edges[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        target, first, count = np.unique(dst, return_index=True, return_counts=True)
        for t0 in range(0, len(target), BATCH):
            tt, ff, cc = target[t0:t0 + BATCH], first[t0:t0 + BATCH], count[t0:t0 + BATCH]
            wide = np.full((len(tt), int(cc.max())), -1)
            col = np.arange(cc.sum()) - np.repeat(np.cumsum(cc) - cc, cc)
            wide[np.repeat(np.arange(len(tt)), cc), col] = src[np.repeat(ff, cc) + col]
            have = g.edges[tt]
            wide = np.where((wide[:, :, None] == have[:, None, :]).any(axis=2), -1, wide)
            both = np.concatenate([have, wide], axis=1)
            d = np.where(both >= 0, _distances(g.x, g.x[tt], np.where(both >= 0, both, 0)), np.inf)
            by_d = np.argsort(d, axis=1, kind="stable")
            both, d = np.take_along_axis(both, by_d, 1), np.take_along_axis(d, by_d, 1)
            full = (both >= 0).sum(axis=1) > degree
            g.edges[tt[~full]] = both[~full, :degree]
            if full.any():
                g.edges[tt[full]] = g.prune(tt[full], both[full], d[full], degree, alpha)
        at += len(batch)
    return g


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda c: c != 0))


def _nodes(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with a content key and the ``keep`` smallest ids that hold them."""
    keyed = rows.distinct().withColumn("key", F.sha2(F.concat_ws(",", F.transform("v", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c).cast("string"))), 256))
    w = Window.partitionBy("key").orderBy("id")
    return keyed.withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep)


def nearest(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
            shards: int = SHARDS, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM,
            alpha: float = ALPHA, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query (``is_query``: a predicate of the id column).

    Vectors of each length are indexed and searched on their own: only equally long ones have an inner product."""
    rows, out = _usable(vectors, id_col, vector_col), None
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    for n in lengths or [0]:
        own = _nearest(rows.where(F.size("v") == n), is_query, k, shards, shard_rows, degree, beam, alpha, query_block)
        out = own if out is None else out.unionByName(own)
    return out


def _nearest(rows: DataFrame, is_query, k: int, shards: int, shard_rows: int, degree: int, beam: int, alpha: float, query_block: int) -> DataFrame:
    """``nearest`` over usable rows (id, v) of one length."""
    members = staged(_nodes(rows, k + 1), "ann-members")  # k others and the query itself
    nodes = members.where("n = 1").select("key", "v", F.col("id").alias("least"))
    n_nodes = nodes.count()
    shards = max(1, min(max(shards, -(-n_nodes // shard_rows)), -(-n_nodes // 64)))
    asked = rows.where(is_query(F.col("id"))).distinct()
    asked = staged(asked.withColumn("key", F.sha2(F.concat_ws(",", F.transform("v", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c).cast("string"))), 256)), "ann-queries")
    asked_vectors = asked.groupBy("key").agg(F.first("v").alias("v"))
    blocks = max(1, -(-asked.count() // query_block))

    def made(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key").reset_index(drop=True)
        x = np.stack(pdf["v"].to_numpy())
        norm = (x * x).sum(axis=1)
        g = build(np.c_[x, np.sqrt(np.maximum(norm.max() - norm, 0))], degree, beam, alpha)
        return pd.DataFrame({"shard": pdf["shard"], "node": np.arange(len(pdf)), "key": pdf["key"], "least": pdf["least"], "v": pdf["v"],
                             "entry": g.entry, "edges": list(g.edges.astype(np.int32))})
    index = staged(nodes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
                   .groupBy("shard").applyInPandas(made, "shard int, node int, key string, least long, v array<double>, entry int, edges array<int>"), "ann-graph")
    spread = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked_vectors.select(F.col("key").alias("qkey"), F.col("v").alias("qv"), spread.alias("shard"),
                                 F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))

    def searched(own: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        cols = ["qkey", "key", "least", "score"]
        if not len(own) or not len(qs):
            return pd.DataFrame({c: [] for c in cols}).astype({"qkey": str, "key": str, "least": int, "score": float})
        own = own.sort_values("node")
        x, q = np.stack(own["v"].to_numpy()), np.stack(qs["qv"].to_numpy())
        norm = (x * x).sum(axis=1)
        g = Graph(np.c_[x, np.sqrt(np.maximum(norm.max() - norm, 0))], int(own["entry"].iat[0]), np.stack(own["edges"].to_numpy()).astype(np.int64))
        key, least, qkey, out = own["key"].to_numpy(), own["least"].to_numpy(), qs["qkey"].to_numpy(), []
        for at in range(0, len(q), BATCH):
            part = q[at:at + BATCH]
            # the query may have any norm: only the order of its inner products counts
            node, _ = g.search(np.c_[part, np.zeros(len(part))].astype(np.float32), max(QUERY_BEAM * beam, k + 1))
            # the beam's nodes by exact score, ties by the smallest id that holds the vector
            score = np.where(node >= 0, np.einsum("bkd,bd->bk", x[node], part), -np.inf)
            order = np.lexsort((least[node], -score), axis=1)[:, :k + 1]
            node, score = np.take_along_axis(node, order, 1), np.take_along_axis(score, order, 1)
            r, c = np.nonzero(np.isfinite(score))
            hit = node[r, c]
            out.append(pd.DataFrame({"qkey": qkey[at + r], "key": key[hit], "least": least[hit], "score": score[r, c]})[cols])
        return pd.concat(out)
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        searched, "qkey string, key string, least long, score double")
    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "least")
    # k + 1 vectors hold the k best others of every query: at least one id each, and at most one is the query itself
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    hits = found.join(members.select("key", F.col("id").alias("vec_id"), F.col("v").alias("mv")), "key")
    per_query = (asked.select(F.col("id").alias("query_id"), F.col("key").alias("qkey"))
                 .join(_top_ids(hits, k + 1), "qkey").where("query_id <> vec_id"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (per_query.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _top_ids(hits: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` ids of every distinct query vector."""
    w = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep).select("qkey", "vec_id", "score")
