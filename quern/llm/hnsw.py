"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Vectors equal in every component are one point (a hot vector costs one node; of its members the K + 1
smallest ids suffice for any answer). Points hash into shards of about SHARD_ROWS; each shard's graph is
built in one task by inserting points in batches - a lockstep beam search finds each one's neighbours -
and is stored as flat arrays: ids, vectors, and one neighbour array a level. Queries come in blocks of
QUERY_BLOCK; every BLOCKS_TOGETHER blocks meet each shard in one task, which holds one graph and those
blocks only, and the nearest of all shards are merged by window.

Scores are exact double-precision cosines of the original vectors; the graph only proposes.

Defined results: null vectors, zero vectors, and vectors with null or non-finite components take no part;
vectors meet only vectors of the same length; rows with equal vec_id but different vectors are different
candidates, also for each other; exact repeats of a row count once; ties go to the smaller vec_id; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import store, table

K = 5
#: Links of a node (twice as many on the lowest level), width of the beam when building and when searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 64, 160
SHARD_ROWS, QUERY_BLOCK, BLOCKS_TOGETHER = 8192, 512, 32
#: Nodes inserted together; up to that many are linked by brute force.
BATCH = 256


class Graph:
    """neighbours[level] is an int32 array (nodes, width), -1 where there is none; nodes are in insertion order."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, neighbours: list[np.ndarray] | None = None, entry: int = 0):
        self.vectors, self.levels, self.entry = vectors, levels, entry
        top = int(levels.max()) if len(levels) else 0
        self.neighbours = neighbours or [np.full((len(vectors), LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]

    def nearest(self, queries: np.ndarray, starts: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Node and similarity of each query's ``beam`` best on one level (best first, -1 for none), all queries in lockstep."""
        n, width = len(queries), self.neighbours[level].shape[1]
        rows = np.arange(n)[:, None]
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, : starts.shape[1]] = starts
        known = starts >= 0
        sims[:, : starts.shape[1]] = np.where(known, np.einsum("qd,qsd->qs", queries, self.vectors[starts]), -np.inf)
        done[:, : starts.shape[1]] = ~known
        seen = np.zeros((n, len(self.vectors) + 1), bool)
        seen[rows, starts] = True
        active = np.arange(n)
        order = np.argsort(-sims, 1, kind="stable")
        ids, sims, done = (np.take_along_axis(x, order, 1) for x in (ids, sims, done))
        while len(active):
            open_ = ~done[active]
            has = open_.any(1)
            active, open_ = active[has], open_[has]
            if not len(active):
                break
            # the two best open nodes of each query are expanded at once
            first = open_.argmax(1)
            open_[np.arange(len(active)), first] = False
            second = np.where(open_.any(1), open_.argmax(1), first)
            done[active, first] = done[active, second] = True
            found = self.neighbours[level][np.stack([ids[active, first], ids[active, second]], 1)].reshape(len(active), 2 * width)
            q = active[:, None]
            fresh = (found >= 0) & ~seen[q, found]
            # a node that both expanded nodes lead to is met once
            sorted_at = np.argsort(found, 1, kind="stable")
            ordered = np.take_along_axis(found, sorted_at, 1)
            again = np.zeros_like(fresh)
            np.put_along_axis(again, sorted_at[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            fresh &= ~again
            seen[q, found] = True
            s = np.where(fresh, np.einsum("qd,qwd->qw", queries[active], self.vectors[found]), -np.inf).astype(np.float32)
            all_s = np.concatenate([sims[active], s], 1)
            best = np.argpartition(-all_s, beam - 1, 1)[:, :beam]
            picked = np.take_along_axis(all_s, best, 1)
            inner = np.argsort(-picked, 1, kind="stable")
            best = np.take_along_axis(best, inner, 1)
            sims[active] = np.take_along_axis(all_s, best, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, found, -1)], 1), best, 1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], 1), best, 1)
        return ids, sims

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Starting points on level ``to``: greedy search from the top."""
        at = np.full((len(queries), 1), self.entry, np.int32)
        for level in range(int(self.levels[self.entry]), to, -1):
            at = self.nearest(queries, at, level, 4)[0][:, :1]
        return at

    def link(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, level: int) -> None:
        """Neighbours of nodes from their candidates (-1 for none, best first).

        A candidate is taken if it is nearer to the node than to any candidate taken before it; what room is
        left goes to the best of the rest.
        """
        width = self.neighbours[level].shape[1]
        for low in range(0, len(nodes), 512):
            at = slice(low, low + 512)
            c, s = ids[at, : 2 * width], sims[at, : 2 * width]
            valid = (c >= 0) & np.isfinite(s)
            v = self.vectors[c]
            between = v @ v.transpose(0, 2, 1)
            nearest_taken = np.full(c.shape, -np.inf, np.float32)
            taken = np.zeros(c.shape, bool)
            room = np.full(len(c), width)
            for k in range(c.shape[1]):
                ok = valid[:, k] & (nearest_taken[:, k] <= s[:, k]) & (room > 0)
                taken[:, k] = ok
                room -= ok
                np.maximum(nearest_taken, np.where(ok[:, None], between[:, k], -np.inf), out=nearest_taken)
            order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), 1, kind="stable")[:, :width]
            out = np.full((len(c), width), -1, np.int32)
            out[:, : order.shape[1]] = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(c, order, 1), -1)
            self.neighbours[level][nodes[at]] = out

    def back(self, targets: np.ndarray, sources: np.ndarray, level: int) -> None:
        """Reverse links: targets choose anew among the neighbours they have and the sources."""
        if not len(targets):
            return
        order = np.argsort(targets, kind="stable")
        targets, sources = targets[order], sources[order]
        nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
        width = self.neighbours[level].shape[1]
        # nodes with about as many sources go together, so little is padding
        by_count = np.argsort(counts, kind="stable")
        for low in range(0, len(nodes), 512):
            some = by_count[low : low + 512]
            most = int(counts[some].max())
            offered = np.full((len(some), most), -1, np.int32)
            inside = np.arange(most) < counts[some][:, None]
            offered[inside] = sources[(first[some][:, None] + np.arange(most))[inside]]
            ids = np.concatenate([self.neighbours[level][nodes[some]], offered], 1)
            same = np.argsort(ids, 1, kind="stable")
            ids = np.take_along_axis(ids, same, 1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("nd,ncd->nc", self.vectors[nodes[some]], self.vectors[ids]), -np.inf).astype(np.float32)
            best = np.argsort(-sims, 1, kind="stable")[:, : 2 * width]
            self.link(nodes[some], np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1), level)

    def build(self) -> Graph:
        n = len(self.vectors)
        low = 0
        while low < n:
            high = min(n, low + min(BATCH, max(BATCH // 2, low)))
            fresh = np.arange(low, high)
            top = int(self.levels[self.entry]) if low else -1
            for level in range(int(self.levels[fresh].max()), -1, -1):
                here = fresh[self.levels[fresh] >= level]
                q = self.vectors[here]
                near = q @ q.T
                np.fill_diagonal(near, -np.inf)
                if level <= top:
                    ids, sims = self.nearest(q, self.descend(q, level), level, BUILD_BEAM if level == 0 else LINKS * 2)
                else:
                    ids, sims = np.zeros((len(here), 0), np.int32), np.zeros((len(here), 0), np.float32)
                ids = np.concatenate([ids, np.broadcast_to(here.astype(np.int32), (len(here), len(here)))], 1)
                sims = np.concatenate([sims, near], 1)
                best = np.argsort(-sims, 1, kind="stable")[:, : 2 * self.neighbours[level].shape[1]]
                self.link(here, np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1), level)
                links = self.neighbours[level][here]
                self.back(links[links >= 0], np.broadcast_to(here[:, None], links.shape)[links >= 0].astype(np.int32), level)
            best = int(fresh[np.argmax(self.levels[fresh])])
            if low == 0 or self.levels[best] > self.levels[self.entry]:
                self.entry = best
            low = high
        return self

    def search(self, queries: np.ndarray, beam: int = SEARCH_BEAM) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.vectors):
            return np.full((len(queries), beam), -1, np.int32), np.full((len(queries), beam), -np.inf, np.float32)
        return self.nearest(queries, self.descend(queries, 0), 0, beam)


def levels_of(ids: np.ndarray) -> np.ndarray:
    """Level of a node by a hash of its id: one in LINKS reaches the next."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    u = ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
    return np.minimum(6, np.floor(-np.log(u) / np.log(LINKS))).astype(np.int32)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Directions in single precision, whatever the scale of the vectors."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    scale = lambda v: v / np.abs(v).max(1, keepdims=True) if len(v) and not 1e-100 < np.abs(v).max() < 1e100 else v
    a, b = scale(a), scale(b)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) and dim of the vectors that take part, exact repeats once."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(finite).withColumn("dim", F.size("v"))


def points(vectors: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: point (its smallest id), dim, v, and its k + 1 smallest ids.

    Ids are first cut down within salts, so the rows of a hot vector don't meet before they are few.
    """
    h = F.xxhash64("v")
    small = vectors.select("vec_id", "v", "dim", h.alias("h"), F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).groupBy("h", "v", "dim", "salt", "vec_id").count()
    ranked = small.withColumn("r", F.row_number().over(Window.partitionBy("h", "v", "salt").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    return ranked.groupBy("h", "v", "dim").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("members")).select(F.col("members")[0].alias("point"), "dim", "v", "members")


INDEX = "shard int, dim int, entry int, ids binary, vectors binary, levels binary, members binary, member_ends binary, neighbours array<binary>"


def build_index(pts: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: the graph as flat arrays."""
    shards = max(1, round(pts.count() / shard_rows))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("point", kind="stable")
        ids = group["point"].to_numpy(np.int64)
        vectors = np.stack([np.asarray(v, float) for v in group["v"]])
        graph = Graph(unit(vectors), levels_of(ids)).build()
        members = [np.asarray(m, np.int64) for m in group["members"]]
        row = (int(group["shard"].iloc[0]), vectors.shape[1], graph.entry, ids.tobytes(), vectors.tobytes(), graph.levels.tobytes(), np.concatenate(members).tobytes(), np.cumsum([len(m) for m in members]).astype(np.int64).tobytes(), [x.tobytes() for x in graph.neighbours])
        return pd.DataFrame([row], columns=["shard", "dim", "entry", "ids", "vectors", "levels", "members", "member_ends", "neighbours"])

    # dealt by ranges of the shard number, which leave a task few shards; a hash would stack some
    dealt = pts.withColumn("shard", F.pmod(F.xxhash64("point", F.lit(5)), F.lit(shards)).cast("int"))
    return dealt.repartitionByRange(shards, "shard").groupBy("shard", "dim").applyInPandas(build, INDEX)


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> DataFrame:
    """One row a block of queries: block, q_dim, q_ids, q_vectors."""
    blocks = max(1, -(-queries.count() // size))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        row = (int(group["block"].iloc[0]), int(group["dim"].iloc[0]), group["vec_id"].to_numpy(np.int64).tobytes(), np.stack([np.asarray(v, float) for v in group["v"]]).tobytes())
        return pd.DataFrame([row], columns=["block", "q_dim", "q_ids", "q_vectors"])

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block", "dim").applyInPandas(pack, "block int, q_dim int, q_ids binary, q_vectors binary")


def search_blocks(index: pd.DataFrame, asked: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    """query_id, block, q (place of the query in its block), vec_id, score: one shard's k nearest for each query of some blocks."""
    read = lambda x, t, *shape: np.frombuffer(x, t).reshape(*shape) if shape else np.frombuffer(x, t)
    out = []
    for r in index.itertuples(index=False):
        ids, vectors, ends, members = read(r.ids, np.int64), read(r.vectors, float, -1, r.dim), read(r.member_ends, np.int64), read(r.members, np.int64)
        graph = Graph(unit(vectors), read(r.levels, np.int32), [read(x, np.int32, len(ids), -1) for x in r.neighbours], r.entry)
        starts = np.concatenate([[0], ends[:-1]])
        for b in asked.itertuples(index=False):
            queries = read(b.q_vectors, float, -1, r.dim)
            nodes, _ = graph.search(unit(queries), min(beam, max(8, len(ids))))
            q, c = np.nonzero(nodes >= 0)
            node = nodes[q, c]
            score, n = cosines(queries[q], vectors[node]), (ends - starts)[node]
            q, score = np.repeat(q, n), np.repeat(score, n)
            member = members[np.repeat(starts[node] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())]
            query = read(b.q_ids, np.int64)[q]
            # the query's own row has its id and its vector; other rows of that id are candidates
            other, at = query != member, np.flatnonzero(query == member)
            other[at] = (queries[q[at]] != vectors[np.repeat(node, n)[at]]).any(1)
            q, score, member, query = q[other], score[other], member[other], query[other]
            order = np.lexsort((member, -score, q))
            q, score, member, query = q[order], score[order], member[order], query[order]
            near = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append(pd.DataFrame({"query_id": query[near], "block": b.block, "q": q[near], "vec_id": member[near], "score": score[near]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "block": [], "q": [], "vec_id": [], "score": []})


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row of ``queries`` (vec_id, embedding)."""
    index = store(build_index(store(points(usable(embeddings), k), "points"), shard_rows), "hnsw")
    asked = store(query_blocks(usable(queries).dropDuplicates(["vec_id", "v"])), "queries")
    # blocks and shards are few and large: the frames below have a row for each of them
    shards, blocks = (df.agg(F.coalesce(F.max(c), F.lit(-1))).first()[0] + 1 for df, c in ((index, "shard"), (asked, "block")))
    together = F.floor(F.col("block") / BLOCKS_TOGETHER).cast("int")
    left = index.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(max(0, (blocks - 1) // BLOCKS_TOGETHER)))))
    right = asked.withColumn("lot", together).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(0, shards - 1))))).withColumnRenamed("q_dim", "dim")
    key = ["dim", "shard", "lot"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        lambda a, b: search_blocks(a, b, k, beam), "query_id long, block int, q long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "block", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest(embeddings, embeddings.where("vec_id % 50 = 0"))


QUERIES = {"op5_hnsw_shards": op5_hnsw_shards}
ORACLE: dict[str, str] = {}
