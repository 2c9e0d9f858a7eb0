"""Nearest neighbours by largest inner product over sharded, robustly pruned directed graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.near_embeddings import usable
from recspark.llm.shared import run_dir, written

DEGREE = 48  # out-edges of a node at most
BUILD_BEAM = 64
SEARCH_BEAM = 96
RELAX = 1.2  # an edge to u is dropped if some kept v is nearer to u by this factor than the node itself
SHARD_ROWS = 8_192  # vectors of a shard, about
QUERY_ROWS = 8_192  # queries that a task answers over one shard, about
BATCH = 512  # nodes added, or queries answered, at the same time
NEAREST = 20


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that makes all of them as long as ``longest``: there the largest inner product with
    a query (whose component is 0) is the smallest distance."""
    rest = np.maximum(longest * longest - np.einsum("ij,ij->i", x, x), 0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)


class Graph:
    """A directed graph over the rows of ``x``, at most ``degree`` edges a node, searched greedily from one node.

    Searches are in single, pruning is in double precision: there small distances of long vectors are compared.
    """

    def __init__(self, x: np.ndarray, degree: int = DEGREE):
        self.fine, self.degree = np.ascontiguousarray(x, np.float64), degree
        self.x = self.fine.astype(np.float32)
        self.norms = np.einsum("ij,ij->i", self.fine, self.fine)
        self.above = (self.norms - self.norms.min()).astype(np.float32) if len(x) else self.x[:0, 0]
        self.edges = np.full((len(x), degree), -1, np.int32)
        self.start = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if len(x) else -1

    def _distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances, but for a term that all nodes of a query share; infinite where there is no node."""
        at = np.maximum(nodes, 0)
        d = self.above[at] - 2 * np.matmul(self.x[at], q[:, :, None])[:, :, 0]
        return np.where(nodes < 0, np.inf, d)

    def search(self, q: np.ndarray, beam: int, seen: bool = False) -> np.ndarray:
        """The ``beam`` nearest nodes found for each query, nearest first (-1: none); with ``seen`` all nodes expanded."""
        n, rows = len(q), np.arange(len(q))
        ids = np.full((n, beam), -1, np.int32)
        ids[:, 0] = self.start
        dist = np.full((n, beam), np.inf, np.float32)
        dist[:, 0] = self._distances(q, ids[:, :1])[:, 0]
        done = np.zeros((n, beam), bool)
        trail = []
        live = rows
        while len(live):
            ahead = np.where(done[live], np.inf, dist[live])
            pick = ahead.argmin(axis=1)
            going = np.isfinite(ahead[np.arange(len(live)), pick])
            live, pick = live[going], pick[going]
            if not len(live):
                break
            done[live, pick] = True
            node = ids[live, pick]
            if seen:
                step = np.full(n, -1, np.int32)
                step[live] = node
                trail.append(step)
            near = self.edges[node]
            mine = ids[live]
            near = np.where((near[:, :, None] == mine[:, None, :]).any(axis=2), -1, near)
            d = self._distances(q[live], near)
            all_d = np.concatenate([dist[live], d], axis=1)
            keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            dist[live] = np.take_along_axis(all_d, keep, axis=1)
            ids[live] = np.take_along_axis(np.concatenate([mine, near], axis=1), keep, axis=1)
            done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1), keep, axis=1)
        order = np.argsort(dist, axis=1, kind="stable")
        ids = np.where(np.isfinite(np.take_along_axis(dist, order, axis=1)), np.take_along_axis(ids, order, axis=1), -1)
        return np.concatenate([ids, np.stack(trail, axis=1)], axis=1) if seen and trail else ids

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray, relax: float) -> np.ndarray:
        """Of every node's candidates the nearest one, then the nearest one that no kept one stands for, and so on."""
        n, width = candidates.shape
        c = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        y = self.fine[np.maximum(c, 0)]
        own = self.norms[np.maximum(c, 0)] - 2 * np.matmul(y, self.fine[nodes][:, :, None])[:, :, 0] + self.norms[nodes][:, None]
        own = np.where(c < 0, np.inf, np.maximum(own, 0))
        out = np.full((n, self.degree), -1, np.int32)
        rows, free = np.arange(n), own.copy()
        for k in range(min(self.degree, width)):
            pick = free.argmin(axis=1)
            has = np.isfinite(free[rows, pick])
            if not has.any():
                break
            out[has, k] = c[has, pick[has]]
            v = y[rows, pick]
            between = (v * v).sum(axis=1)[:, None] + self.norms[np.maximum(c, 0)] - 2 * np.matmul(y, v[:, :, None])[:, :, 0]
            free[has[:, None] & (relax * relax * between <= own)] = np.inf
            free[rows, pick] = np.inf
        return out

    def _back(self, nodes: np.ndarray, relax: float) -> None:
        """Edges back from the new neighbours of ``nodes``; a node with too many edges is pruned again."""
        source = np.repeat(nodes, self.degree)
        target = self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hubs, first, count = np.unique(target, return_index=True, return_counts=True)
        by_count = np.argsort(count, kind="stable")
        at = 0
        while at < len(hubs):
            width = int(count[by_count[at]])
            # hubs of about as many new edges together, so that the padding stays small
            to = at + int(np.searchsorted(count[by_count[at:]], max(2 * width, 8), "right"))
            to = min(to, at + max(1, 2_000_000 // (int(count[by_count[to - 1]]) + self.degree) // self.x.shape[1]))
            part = by_count[at:to]
            widest = int(count[part].max())
            place = first[part][:, None] + np.arange(widest)
            new = np.where(np.arange(widest) < count[part][:, None], source[np.minimum(place, len(source) - 1)], -1).astype(np.int32)
            old = self.edges[hubs[part]]
            new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
            both = np.concatenate([old, new], axis=1)
            fits = (both >= 0).sum(axis=1) <= self.degree
            self.edges[hubs[part][fits]] = -np.sort(-both[fits], axis=1)[:, : self.degree]
            if not fits.all():
                self.edges[hubs[part][~fits]] = self._prune(hubs[part][~fits], both[~fits], relax)
            at = to

    def build(self, beam: int = BUILD_BEAM, relax: float = RELAX) -> Graph:
        """Add the nodes in a fixed random order, as many at a time as there are already, up to a batch."""
        n = len(self.x)
        order = np.random.default_rng(7).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]]).astype(np.int32) if n else order
        at = 1
        while at < n:
            nodes = order[at : at + min(at, BATCH)]
            # a batch does not see its own members by searching: the neighbours within the batch are offered as well
            found = self.search(self.x[nodes], beam, seen=True)
            inner = self.norms[nodes][None, :] - 2 * (self.fine[nodes] @ self.fine[nodes].T)
            np.fill_diagonal(inner, np.inf)
            some = min(self.degree // 2, len(nodes) - 1)
            if some:
                found = np.concatenate([found, nodes[np.argpartition(inner, some - 1, axis=1)[:, :some]]], axis=1)
            for part in np.array_split(np.arange(len(nodes)), max(1, found.size * self.x.shape[1] // 16_000_000)):
                self.edges[nodes[part]] = self._prune(nodes[part], found[part], relax)
            self._back(nodes, relax)
            at += len(nodes)
        self._connect()
        return self

    def reached(self) -> np.ndarray:
        """Which nodes can be reached from the start."""
        seen = np.zeros(len(self.x), bool)
        front = np.array([self.start])
        seen[front] = True
        while len(front):
            front = np.unique(self.edges[front])
            front = front[(front >= 0)]
            front = front[~seen[front]]
            seen[front] = True
        return seen

    def _connect(self) -> None:
        """Give every node that cannot be reached an edge from the nearest one that can."""
        for _ in range(len(self.x)):
            missing = np.flatnonzero(~self.reached()) if len(self.x) else []
            if not len(missing):
                return
            found = self.search(self.x[missing[:BATCH]], self.degree)
            taken = set()
            for node, near in zip(missing[:BATCH].tolist(), found.tolist(), strict=True):
                free = [v for v in near if v >= 0 and v not in taken]
                if not free:
                    continue
                v = next((u for u in free if (self.edges[u] < 0).any()), None)
                if v is None:  # all full: the last edge of the nearest makes room, what it led to is looked for again
                    v = free[0]
                    self.edges[v, -1] = node
                else:
                    self.edges[v, int((self.edges[v] < 0).argmax())] = node
                taken.add(v)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("class", kind="stable")
    x = _matrix(shard["vector"]) / float(shard["scale"].iloc[0])
    graph = Graph(lifted(x, float(shard["longest"].iloc[0]))).build()
    shard = shard.assign(at=np.arange(len(shard), dtype=np.int32), start=np.int32(graph.start), edges=[e[e >= 0] for e in graph.edges])
    return shard[["dims", "shard", "at", "start", "class", "vector", "scale", "longest", "edges"]]


def build_index(vectors: DataFrame, folder: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: one row per distinct vector with the edges of its node (dims, shard, at, start, class, vector, edges...).

    ``vectors``: class (a hash), dims, vector. Vectors of one length are dealt by hash to so many shards that a shard has
    about ``shard_rows``, which bounds a task; each shard's graph is built by itself and all rows are indexed.
    """
    largest = F.aggregate("vector", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))
    scale = vectors.groupBy("dims").agg(F.count("*").alias("n"), F.max(largest).alias("scale"))
    scale = written(scale.withColumn("shards", F.ceil(F.col("n") / F.lit(shard_rows)).cast("int")), folder, "sizes")
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + (v / F.col("scale")) * (v / F.col("scale")))
    longest = vectors.join(scale, "dims").select("dims", square.alias("square")).groupBy("dims").agg(F.sqrt(F.max("square")).alias("longest"))
    sizes = written(scale.join(longest, "dims"), folder, "lengths")  # one row per length of vectors
    dealt = vectors.join(sizes, "dims").withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "class"), F.col("shards")).cast("int"))
    schema = "dims int, shard int, at int, start int, class long, vector array<double>, scale double, longest double, edges array<int>"
    return written(dealt.groupBy("dims", "shard").applyInPandas(_build, schema), folder, "index")


def _search(nearest: int, beam: int):
    def work(key, nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "class": [], "score": []}
        if len(nodes) and len(queries):
            nodes = nodes.sort_values("at")
            x = _matrix(nodes["vector"])
            scale = float(nodes["scale"].iloc[0])
            graph = Graph(lifted(x / scale, float(nodes["longest"].iloc[0])))
            for i, e in enumerate(nodes["edges"]):
                graph.edges[i, : len(e)] = e
            graph.start = int(nodes["start"].iloc[0])
            name, ids = nodes["class"].to_numpy(), queries["query"].to_numpy()
            q = _matrix(queries["vector"])
            lift = q / np.abs(q).max(axis=1, keepdims=True)
            lift = np.concatenate([lift, np.zeros((len(q), 1))], axis=1).astype(np.float32)
            for part in np.array_split(np.arange(len(q)), max(1, -(-len(q) // BATCH))):
                found = graph.search(lift[part], max(beam, nearest))
                with np.errstate(over="ignore"):
                    score = np.matmul(x[np.maximum(found, 0)], q[part][:, :, None])[:, :, 0]
                score = np.where(found < 0, -np.inf, score)
                best = np.argsort(-score, axis=1, kind="stable")[:, :nearest]
                found, score = np.take_along_axis(found, best, axis=1), np.take_along_axis(score, best, axis=1)
                row, col = np.nonzero(found >= 0)
                out["query"].append(ids[part][row])
                out["class"].append(name[found[row, col]])
                out["score"].append(score[row, col])
        kinds = {"query": np.int64, "class": np.int64, "score": np.float64}
        return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0, kinds[k]) for k, v in out.items()})

    return work


def search_index(index: DataFrame, queries: DataFrame, nearest: int, folder: str, beam: int = SEARCH_BEAM, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query, class, score): the nearest classes that each shard's beam search finds for each query.

    ``queries``: query (a hash), dims, vector. A task has one shard and one part of the queries, of about ``query_rows``;
    scores are inner products of the original vectors in double precision.
    """
    sizes = queries.groupBy("dims").agg(F.ceil(F.count("*") / F.lit(query_rows)).cast("int").alias("parts"))
    parts = index.groupBy("dims", "shard").agg(F.lit(1).alias("_one")).drop("_one").join(sizes, "dims")
    parts = written(parts, folder, "search-parts")
    # every part of the queries meets every shard of its length
    nodes = index.join(parts, ["dims", "shard"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    shards = parts.groupBy("dims", "parts").agg(F.collect_list("shard").alias("shards"))  # numbers of shards only
    asked = queries.join(shards, "dims").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    asked = asked.select("dims", F.explode("shards").alias("shard"), "part", "query", "vector")
    key = ["dims", "shard", "part"]
    found = nodes.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_search(nearest, beam), "query long, class long, score double")
    return written(found, folder, "found")


def nearest_vectors(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", every: int = 20, nearest: int = NEAREST,
    beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score. Queries are the rows whose id ``every`` divides.

    Equal vectors are one node of the index, so a vector that is found everywhere costs one; a node stands for its rows
    again when ranks are given. Of a node only the ``nearest`` + 1 smallest ids can matter to any query, which are found
    before rows move. Ranks go by descending score, then ascending id, over all rows but the query's own; rows that
    repeat a query's id are its own. Vectors that are null, empty, zero or hold null or non-finite components take no
    part, nor do rows without an id; vectors of different lengths are not compared. A query that stands in several rows
    with different vectors is answered for its smallest one. Fewer rows than ``nearest`` give as many ranks; an empty
    table gives none. The search is approximate; what it finds is ranked exactly.
    """
    folder = run_dir(df.sparkSession, "graph-search")
    base = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    base = base.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    base = base.withColumn("class", F.xxhash64("vector"))
    rows = written(base.select("vec_id", "class", F.size("vector").alias("dims"), "vector"), folder, "rows")
    classes = rows.groupBy("class").agg(F.any_value("dims").alias("dims"), F.any_value("vector").alias("vector"))
    index = build_index(written(classes, folder, "classes"), folder, shard_rows)

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min_by(F.struct("class", "dims", "vector"), "vector").alias("own"))
    asked = written(asked.select("vec_id", "own.class", "own.dims", "own.vector"), folder, "asked")
    questions = asked.groupBy("class").agg(F.any_value("dims").alias("dims"), F.any_value("vector").alias("vector")).withColumnRenamed("class", "query")
    found = search_index(index, questions, nearest + 1, folder, beam)

    of_class = Window.partitionBy("class").orderBy("vec_id")
    members = rows.select("class", "vec_id").withColumn("k", F.row_number().over(of_class)).where(F.col("k") <= nearest + 1)
    members = written(members.drop("k"), folder, "members")
    least = members.groupBy("class").agg(F.min("vec_id").alias("least"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    top = found.join(least, "class").withColumn("k", F.row_number().over(best)).where(F.col("k") <= nearest + 1)
    top = written(top.select("query", "class", "score"), folder, "top")
    near = members.join(top, "class").select("query", "vec_id", "score")
    # a query's answer is shorter than its class's by the query itself only
    by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("k", F.row_number().over(by_rank)).where(F.col("k") <= nearest + 1).withColumnRenamed("vec_id", "near_id")
    pairs = asked.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")).join(near, "query").where("query_id <> near_id")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "near_id")
    ranked = pairs.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("near_id").alias("vec_id"), "score")
