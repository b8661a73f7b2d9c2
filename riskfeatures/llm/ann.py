"""Nearest neighbours by hierarchical navigable small-world graphs, one for each shard.

Equal vectors are one node. Nodes are dealt to shards of bounded size; a shard's graph is
stored as flat arrays of neighbours, layer by layer. Queries visit every shard in blocks,
the nodes found are scored exactly, and the shards' results are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import small_batches, stored

SHARD = 8_192  # nodes in a shard, on average
BLOCK = 256  # queries in a block, on average
LINKS = 16  # of a node in a layer; twice as many in the lowest
NEAR = 64  # candidates for links
BEAM = 256
AT_ONCE = 8  # nodes of a beam that are expanded together


def valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def layers_of(ids: np.ndarray) -> np.ndarray:
    """Highest layer of each node: geometric, by a hash of its id."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    share = ((x ^ (x >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / 2**53
    return np.floor(-np.log(share + 2.0**-54) / math.log(LINKS)).astype(np.int64)


def nearest_in(v: np.ndarray, rows: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of `among` for each of `rows`, by exact products in blocks; -1 where fewer."""
    out = np.full((len(rows), k), -1, np.int64)
    take = min(k, len(among) - 1)
    for at in range(0, len(rows) if take > 0 else 0, 512):
        part = rows[at : at + 512]
        near = v[part] @ v[among].T
        near[part[:, None] == among[None, :]] = -2
        best = np.argpartition(-near, take - 1, axis=1)[:, :take]
        out[at : at + 512, :take] = among[best]
    return out


def linked(v: np.ndarray, rows: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` links of each row: candidates that are nearer to it than to a link before,
    then the nearest of the others. -1 fills up."""
    own = np.where(candidates >= 0, np.einsum("nd,nkd->nk", v[rows], v[np.maximum(candidates, 0)]), -3)
    order = np.argsort(-own, axis=1, kind="stable")
    candidates, own = np.take_along_axis(candidates, order, 1), np.take_along_axis(own, order, 1)
    repeated = np.zeros(candidates.shape, bool)
    for j in range(1, candidates.shape[1]):
        repeated[:, j] = (candidates[:, :j] == candidates[:, j : j + 1]).any(axis=1)
    fit = (candidates >= 0) & (candidates != rows[:, None]) & ~repeated
    n, k = candidates.shape
    links, count = np.full((n, most), -1, np.int64), np.zeros(n, np.int64)
    chosen = np.zeros((n, k), bool)
    for diverse in (True, False):
        for j in range(k):
            c = candidates[:, j]
            good = fit[:, j] & ~chosen[:, j] & (count < most)
            if diverse and j:
                i = np.flatnonzero(good)
                if len(i):
                    to = np.where(links[i] >= 0, np.einsum("nd,nmd->nm", v[c[i]], v[np.maximum(links[i], 0)]), -3)
                    good[i] = (to < own[i, j][:, None]).all(axis=1)
            i = np.flatnonzero(good)
            links[i, count[i]] = c[i]
            count[i] += 1
            chosen[i, j] = True
    return links


def build(v: np.ndarray, layers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the lowest up: their nodes, and the flat links of these nodes.

    Candidates for links are the nearest in the layer and, as for nodes that came early, the
    nearest in the sparser layers above, which span the distances between clusters.
    """
    out = []
    members = [np.flatnonzero(layers >= level) for level in range(int(layers.max()) + 1)]
    for level, nodes in enumerate(members):
        most = LINKS * (2 if level == 0 else 1)
        wanted = [nearest_in(v, nodes, nodes, NEAR)] + [nearest_in(v, nodes, upper, LINKS) for upper in members[level + 1 :]]
        links = linked(v, nodes, np.concatenate(wanted, axis=1), most // 2)
        # links also lead back; each node keeps the best of both directions
        position = np.full(len(v), -1)
        position[nodes] = np.arange(len(nodes))
        source, target = np.repeat(np.arange(len(nodes)), links.shape[1]), links.reshape(-1)
        source, target = source[target >= 0], position[target[target >= 0]]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        rank = np.arange(len(target)) - np.searchsorted(target, target)
        room = np.full((len(nodes), 2 * most), -1, np.int64)
        inside = rank < 2 * most
        room[target[inside], rank[inside]] = nodes[source[inside]]
        both = np.concatenate([links, room], axis=1)
        final = np.concatenate([linked(v, nodes[i : i + 1024], both[i : i + 1024], most) for i in range(0, len(nodes), 1024)])
        out.append((nodes, final))
    return out


def search(v: np.ndarray, graph: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, beam: int) -> np.ndarray:
    """Nodes nearest to each query, best first; -1 fills up. All queries move together."""
    top = graph[-1][0]
    best = np.repeat(top[:1][None], len(queries), axis=0)
    for level in range(len(graph) - 1, -1, -1):
        nodes, links = graph[level]
        position = np.full(len(v), -1)
        position[nodes] = np.arange(len(nodes))
        best = _beam(v, links, position, queries, best, beam if level == 0 else AT_ONCE)
    return best


def _beam(v: np.ndarray, links: np.ndarray, position: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    rows = np.arange(len(queries))[:, None]
    visited = np.zeros((len(queries), len(v) + 1), bool)  # the last place stands for -1
    score = lambda ids: np.where(ids >= 0, np.einsum("qd,qkd->qk", queries, v[np.maximum(ids, 0)]), -3).astype(np.float32)
    beam = np.full((len(queries), width), -1, np.int64)
    beam[:, : min(width, start.shape[1])] = start[:, :width]
    visited[rows, beam] = True
    near, done = score(beam), beam < 0
    while not done.all():
        open_ = np.where(done, -4, near)
        take = min(AT_ONCE, width)
        at = np.argpartition(-open_, take - 1, axis=1)[:, :take]
        live = ~np.take_along_axis(done, at, 1)
        nodes = np.where(live, np.take_along_axis(beam, at, 1), -1)
        np.put_along_axis(done, at, True, 1)
        found = np.where(nodes[:, :, None] >= 0, links[position[np.maximum(nodes, 0)]], -1).reshape(len(queries), -1)
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found = np.where(visited[rows, found], -1, found)
        visited[rows, found] = True
        beam, near = np.concatenate([beam, found], axis=1), np.concatenate([near, score(found)], axis=1)
        done = np.concatenate([done, found < 0], axis=1)
        keep = np.argpartition(-near, width - 1, axis=1)[:, :width]
        beam, near, done = (np.take_along_axis(x, keep, 1) for x in (beam, near, done))
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(beam, order, 1)


def _pack(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("node")
    ids = shard["node"].to_numpy()
    graph = build(units(np.stack(shard["vector"])), layers_of(ids))
    return pd.DataFrame(
        {
            "dim": shard["dim"].iloc[:1],
            "shard": shard["shard"].iloc[:1],
            "ids": [ids.astype(np.int64).tobytes()],
            "vectors": [np.stack(shard["vector"]).astype(np.float32).tobytes()],
            "sizes": [[len(nodes) for nodes, _ in graph]],
            "nodes": [np.concatenate([nodes for nodes, _ in graph]).astype(np.int32).tobytes()],
            "links": [np.concatenate([links.reshape(-1) for _, links in graph]).astype(np.int32).tobytes()],
        }
    )


GRAPH = "dim int, shard int, ids binary, vectors binary, sizes array<int>, nodes binary, links binary"


def _unpack(row) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    ids = np.frombuffer(row.ids, np.int64)
    vectors = np.frombuffer(row.vectors, np.float32).reshape(len(ids), -1)
    nodes, links = np.frombuffer(row.nodes, np.int32).astype(np.int64), np.frombuffer(row.links, np.int32).astype(np.int64)
    graph, n, m = [], 0, 0
    for level, size in enumerate(row.sizes):
        width = LINKS * (2 if level == 0 else 1)
        graph.append((nodes[n : n + size], links[m : m + size * width].reshape(size, width)))
        n, m = n + size, m + size * width
    return ids, vectors, graph


def nodes_of(df: DataFrame, keep: int, key: str, vector: str) -> DataFrame:
    """Each different valid vector with its `keep` smallest keys; `node` is the smallest."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector")).where(F.col("id").isNotNull() & valid(F.col("vector"))).distinct()
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= keep)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("node"), "ids", "vector", F.size("vector").alias("dim")
    )


def build_index(nodes: DataFrame, shard_nodes: int = SHARD) -> tuple[DataFrame, int]:
    """Graphs of all shards, written to the shared folder, and the number of shards."""
    shards = max(1, math.ceil(nodes.count() / shard_nodes))
    dealt = nodes.select("node", "vector", "dim", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    return stored(dealt.groupBy("dim", "shard").applyInPandas(_pack, GRAPH), "graphs"), shards


def nearest(df: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", beam: int = BEAM, shard_nodes: int = SHARD) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k nearest rows found for each query, by cosine.

    A query's own key is no result; ties go to the smaller key. Scores are exact, in double
    precision, on the vectors as given. Vectors that are null, zero, or hold a null or
    non-finite component take no part, nor do rows without key; vectors meet only those of
    their own length. Repeated rows of a query are one query, and a key counts once for it.
    """
    small_batches(df.sparkSession)
    nodes = stored(nodes_of(df, k + 1, key, vector), "nodes")
    index, shards = build_index(nodes, shard_nodes)
    asked = queries.select(F.col(f"`{key}`").alias("query_id"), F.col(f"`{vector}`").alias("asked"))
    asked = stored(asked.where(F.col("query_id").isNotNull() & valid(F.col("asked"))).distinct().withColumn("dim", F.size("asked")), "queries")
    blocks = max(1, math.ceil(asked.count() / BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    left = asked.select("dim", block, "query_id", "asked", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    width = max(beam, k + 1)

    def look(asked: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(graphs):
            ids, vectors, graph = _unpack(next(graphs.itertuples()))
            v, given = units(vectors), np.stack(asked["asked"]).astype(np.float64)
            exact = vectors.astype(np.float64)
            norms = np.sqrt((exact * exact).sum(axis=1))
            for at in range(0, len(asked), 64):
                own = given[at : at + 64]
                found = search(v, graph, units(own), min(width, len(v)))
                for query, a, row in zip(asked["query_id"][at : at + 64], own, found):
                    row = row[row >= 0][: 4 * (k + 1)]
                    score = (exact[row] * a).sum(axis=1) / (norms[row] * np.sqrt((a * a).sum()))
                    best = np.lexsort((ids[row], -score))[: k + 1]
                    out += [(query, ids[row[b]], score[b]) for b in best]
        return pd.DataFrame(out, columns=["query_id", "node", "score"])

    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(look, "query_id long, node long, score double")
    members = found.join(nodes.select("node", F.explode("ids").alias("vec_id")), "node").where("vec_id <> query_id")
    once = members.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 5) -> str:
    """DuckDB SQL for exact results, which the graph reaches where the beam spans a shard."""
    return f"""
with v as (select distinct vec_id, embedding::double[] as e, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as n from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select q.vec_id as query_id, c.vec_id, max(list_dot_product(q.e, c.e) / (q.n * c.n)) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e) group by all)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs) where rank <= {k}
"""
