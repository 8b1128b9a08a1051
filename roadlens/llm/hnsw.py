"""Approximate nearest neighbours: one HNSW graph per shard (operator 7).

Vectors are dealt to shards by a hash of their id.  A shard's graph is built
in numpy over its different vectors (equal ones are one node that lists its
ids) and stored as flat neighbour arrays; queries visit the graph of every
shard in blocks, and the shard results are merged by a window.  Inner product
is searched as Euclidean distance after adding one coordinate that brings all
vectors of a shard to equal length.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from roadlens.llm.common import written

#: Vectors of a shard on average, queries of a block, links per node (twice as
#: many on the ground layer), and candidates held while building and searching.
SHARD_ROWS, QUERY_BLOCK = 12_000, 4_096
LINKS, EF_BUILD, EF_SEARCH = 16, 80, 160
#: Nodes per stored row of a graph.
CHUNK = 1024


def _search(vecs, links, degree, q, entry, ef, stamp, mark):
    """Best-first search of one layer by similarity (dot product): up to
    ``ef`` ``(similarity, node)`` pairs, best last."""
    sim = vecs[entry] @ q
    best = [(float(s), int(e)) for s, e in zip(sim, entry)]
    heapq.heapify(best)
    todo = [(-s, e) for s, e in best]
    heapq.heapify(todo)
    stamp[entry] = mark
    while todo:
        s, node = heapq.heappop(todo)
        if -s < best[0][0] and len(best) >= ef:
            break
        near = links[node, :degree[node]]
        near = near[stamp[near] != mark]
        if not len(near):
            continue
        stamp[near] = mark
        sims = vecs[near] @ q
        if len(best) >= ef:
            hit = sims > best[0][0]
            near, sims = near[hit], sims[hit]
        for s, e in zip(sims.tolist(), near.tolist()):
            if len(best) < ef:
                heapq.heappush(best, (s, e))
            elif s > best[0][0]:
                heapq.heapreplace(best, (s, e))
            else:
                continue
            heapq.heappush(todo, (-s, e))
    return best


def _diverse(vecs, cand, sims, most):
    """Neighbours by falling similarity, leaving out one that lies nearer to a
    chosen neighbour than to the node; filled up with the best left out."""
    order = np.argsort(-sims, kind="stable")
    cand, sims = cand[order], sims[order]
    if len(cand) <= most:
        return cand
    among = vecs[cand] @ vecs[cand].T
    chosen, left = [], []
    for i in range(len(cand)):
        if len(chosen) == most:
            break
        if not chosen or among[i, chosen].max() < sims[i]:
            chosen.append(i)
        else:
            left.append(i)
    chosen += left[: most - len(chosen)]
    return cand[chosen]


class Graph:
    """A layered graph over unit-length rows, as flat neighbour arrays: per
    layer ``links`` (node x slots) and ``degree``."""

    def __init__(self, vecs: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = 7):
        n = len(vecs)
        self.vecs, self.m = vecs, links
        level = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(links)), 6).astype(np.int64)
        self.level = level
        self.layers = []  # (links, degree); the ground layer has twice the slots
        for lv in range(int(level.max()) + 1 if n else 0):
            self.layers.append((np.zeros((n, links * (2 if lv == 0 else 1)), np.int32), np.zeros(n, np.int32)))
        self.entry, self.top = 0, int(level[0]) if n else 0
        stamp, mark = np.zeros(n, np.int64), 0
        for i in range(1, n):
            q, at = vecs[i], np.array([self.entry])
            for lv in range(self.top, int(level[i]), -1):
                mark += 1
                at = np.array([max(_search(vecs, *self.layers[lv], q, at, 1, stamp, mark))[1]])
            for lv in range(min(self.top, int(level[i])), -1, -1):
                mark += 1
                found = _search(vecs, *self.layers[lv], q, at, ef, stamp, mark)
                cand = np.array([e for _, e in found])
                sims = np.array([s for s, _ in found], np.float32)
                self._connect(lv, i, _diverse(vecs, cand, sims, self.m))
                at = cand
            if level[i] > self.top:
                self.entry, self.top = i, int(level[i])

    def _connect(self, lv: int, i: int, near: np.ndarray) -> None:
        links, degree = self.layers[lv]
        links[i, :len(near)], degree[i] = near, len(near)
        slots = links.shape[1]
        for e in near.tolist():
            d = degree[e]
            if d < slots:
                links[e, d], degree[e] = i, d + 1
            else:
                cand = np.append(links[e], np.int32(i))
                keep = _diverse(self.vecs, cand, self.vecs[cand] @ self.vecs[e], slots)
                links[e, :len(keep)], degree[e] = keep, len(keep)

    def search(self, q: np.ndarray, ef: int, stamp: np.ndarray, mark: int) -> tuple[list, int]:
        """``(similarity, node)`` pairs, best first, and the last mark used."""
        if not len(self.vecs):
            return [], mark
        at = np.array([self.entry])
        for lv in range(self.top, 0, -1):
            mark += 1
            at = np.array([max(_search(self.vecs, *self.layers[lv], q, at, 1, stamp, mark))[1]])
        mark += 1
        return sorted(_search(self.vecs, *self.layers[0], q, at, ef, stamp, mark), reverse=True), mark


def _build_shard(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """The shard's graph as rows of ``CHUNK`` nodes (flat arrays as bytes)."""
    pdf = pdf.sort_values("vec_id", kind="stable")
    raw = np.array(pdf["vec"].tolist(), np.float64).reshape(len(pdf), -1)
    nodes, member = np.unique(raw, axis=0, return_inverse=True)
    member = member.ravel()
    turn = np.random.default_rng(11).permutation(len(nodes))  # sorted input would make long detours
    nodes, place = nodes[turn], np.argsort(turn)
    ids = pdf["vec_id"].to_numpy()
    order = np.argsort(place[member], kind="stable")          # ids of a node stand together, ascending
    ids, owner = ids[order], place[member][order]
    norm2 = (nodes ** 2).sum(axis=1)
    longest = norm2.max()
    flat = np.concatenate([nodes, np.sqrt(np.maximum(longest - norm2, 0))[:, None]], axis=1) / math.sqrt(longest)
    graph = Graph(flat.astype(np.float32))
    starts = np.searchsorted(owner, np.arange(len(nodes) + 1))
    out = []
    for at in range(0, len(nodes), CHUNK):
        to = min(at + CHUNK, len(nodes))
        layers = [np.concatenate([degree[at:to, None], links[at:to]], axis=1).astype(np.int32).tobytes()
                  for links, degree in graph.layers]
        out.append({"dim": key[0], "shard": key[1], "at": at, "n": to - at, "entry": graph.entry, "top": graph.top,
                    "vecs": nodes[at:to].tobytes(), "flat": flat[at:to].astype(np.float32).tobytes(), "layers": layers,
                    "starts": np.diff(starts[at:to + 1]).astype(np.int64).tobytes(),
                    "ids": ids[starts[at]:starts[to]].astype(np.int64).tobytes()})
    return pd.DataFrame(out)


GRAPH = ("dim int, shard bigint, at bigint, n bigint, entry bigint, top int, vecs binary, flat binary, "
         "layers array<binary>, starts binary, ids binary")


def load_graph(rows: pd.DataFrame) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, original vectors, first id of each node, ids) of a shard's rows."""
    rows = rows.sort_values("at")
    n, dim = int(rows["n"].sum()), int(rows["dim"].iloc[0])
    graph = Graph.__new__(Graph)
    graph.vecs = np.frombuffer(b"".join(rows["flat"]), np.float32).reshape(n, dim + 1)
    graph.entry, graph.top, graph.layers = int(rows["entry"].iloc[0]), int(rows["top"].iloc[0]), []
    for lv in range(len(rows["layers"].iloc[0])):
        both = np.frombuffer(b"".join(x[lv] for x in rows["layers"]), np.int32).reshape(n, -1)
        graph.layers.append((both[:, 1:], both[:, 0]))
    starts = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(rows["starts"]), np.int64))])
    vecs = np.frombuffer(b"".join(rows["vecs"]), np.float64).reshape(n, dim)
    return graph, vecs, starts, np.frombuffer(b"".join(rows["ids"]), np.int64)


def _answer(k: int, ef: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            graph, vecs, starts, ids = load_graph(rows)
            stamp, mark = np.zeros(len(vecs), np.int64), 0
            for qid, q in zip(queries["vec_id"].tolist(), queries["vec"].tolist()):
                q = np.asarray(q, np.float64)
                unit = np.append(q / np.sqrt(q @ q), 0.0).astype(np.float32)
                found, mark = graph.search(unit, ef, stamp, mark)
                nodes = np.array([e for _, e in found])
                exact = vecs[nodes] @ q
                best = []
                for i in np.lexsort((nodes, -exact)):
                    node = nodes[i]
                    if len(best) >= k and exact[i] < best[k - 1][0]:
                        break
                    # the smallest ids of a node; one more, for the query itself may be among them
                    own = ids[starts[node]:starts[node + 1]][: k + 1]
                    best += [(float(exact[i]), int(v)) for v in own if v != qid]
                best.sort(key=lambda x: (-x[0], x[1]))
                out += [(qid, v, s) for s, v in best[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vec, dim)`` of the rows that take part: with an id, and a
    vector without null or non-finite components that isn't zero."""
    vec = F.col(vector).cast("array<double>")
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), vec.alias("vec"))
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
                      & F.coalesce(ok, F.lit(False)) & F.exists("vec", lambda x: x != 0)) \
        .withColumn("dim", F.size("vec"))


def search(table: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           ef: int = EF_SEARCH, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row whose id is divisible
    by ``every``, its ``k`` nearest found among all other rows by inner
    product (double precision, on the original vectors), ties to the smaller
    id.  Rows with a null id, or a null, empty, zero or partly null or
    non-finite vector take no part; vectors only meet others of the same
    length; repeated rows with one id and vector are one row (an id with
    several vectors counts with each); an empty table gives an empty result;
    other columns are ignored.

    The number of shards and of query blocks grows with the table, each shard
    and block being bounded; a (shard, block) pair is one task's group."""
    rows = written(usable(table, vec_id, vector).distinct(), "vectors")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("_n"),
                                    F.sum((F.col("vec_id") % every == 0).cast("bigint")).alias("_q"))
    sizes = sizes.select("dim", F.ceil(F.col("_n") / shard_rows).alias("_shards"), F.ceil(F.col("_q") / query_block).alias("_blocks"))
    dealt = rows.join(sizes, "dim")
    # building is much work on few bytes: as many tasks as the session shuffles to, not as few as the bytes suggest
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    graphs = written(dealt.select("dim", F.pmod(F.xxhash64(F.lit("shard"), "vec_id", "vec"), "_shards").alias("shard"), "vec_id", "vec")
                     .repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(_build_shard, GRAPH), "graphs")
    queries = dealt.where(F.col("vec_id") % every == 0).select(
        "dim", F.explode(F.expr("sequence(0, _shards - 1)")).alias("shard"),
        F.pmod(F.xxhash64(F.lit("block"), "vec_id"), "_blocks").alias("block"), "vec_id", "vec")
    spread = graphs.join(sizes, "dim").where("_blocks > 0").select(
        *graphs.columns, F.explode(F.expr("sequence(0, _blocks - 1)")).alias("block"))
    keys = ["dim", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        _answer(k, ef), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
