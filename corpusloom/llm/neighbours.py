"""Nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

Equal vectors are one node, which holds the smallest ids of its rows, so a vector that a third of
all rows share is one node as well. Nodes are dealt to shards of about ``SHARD`` by a hash.
A shard's graph is one row of flat arrays: ids, vectors, and for each layer its nodes and
a table of ``M`` (bottom: 2 ``M``) neighbours per node, -1 for none.

Nodes enter a graph in a fixed random order with geometric levels. A node's candidates are the
nearest earlier nodes of the layer, found by matrix products over blocks; of these it
links to those that are nearer to it than to a neighbour chosen before, and they link back.
A search goes down greedily from the top layer and widens at the bottom. Queries meet all
shards in blocks, each shard gives its best, and the shards' results merge by rank.
Scores are cosines in double precision of the original vectors.

Vectors that are null, zero or hold null or non-finite components take no part, neither as
queries nor as candidates; so do rows without ``vec_id``. Ties go to the smaller ``vec_id``.
A row is no neighbour of its own id. Vectors of unlike lengths are in graphs of their own. If there
are fewer candidates than asked for, all are returned. Repeated rows count once.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD = 8192
M = 16
WIDTH = 96  # of the search at the bottom layer
CANDIDATES = 48  # earlier nodes that a new node may link to
BLOCK = 512  # queries that travel together


@dataclass
class Graph:
    ids: np.ndarray  # nodes by the ids of their rows, -1 where there are fewer
    vectors: np.ndarray  # float64, as given
    layers: list[tuple[np.ndarray, np.ndarray]]  # from the bottom: place of each node or -1, neighbours
    entry: int

    def __post_init__(self):
        norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.unit = (self.vectors / norms[:, None]).astype(np.float32)
        self.norms = norms

    def near(self, query: np.ndarray, layer: int, start: list[int], width: int) -> np.ndarray:
        """The nodes found in a layer from ``start`` on, the best ``width``."""
        place, links = self.layers[layer]
        seen = np.zeros(len(self.unit), bool)
        nodes = np.array(start)
        seen[nodes] = True
        score = self.unit[nodes] @ query
        done = np.zeros(len(nodes), bool)
        while True:
            # all nodes of the front that are not expanded yet, a few best at a time
            open_ = np.flatnonzero(~done)
            if not len(open_):
                return nodes
            take = open_[:4] if width > 1 else open_[:1]
            done[take] = True
            new = np.unique(links[place[nodes[take]]])
            new = new[new >= 0]
            new = new[~seen[new]]
            if not len(new):
                continue
            seen[new] = True
            nodes, score = np.r_[nodes, new], np.r_[score, self.unit[new] @ query]
            done = np.r_[done, np.zeros(len(new), bool)]
            order = np.argsort(-score, kind="stable")[:width]
            nodes, score, done = nodes[order], score[order], done[order]

    def search(self, vector: np.ndarray, width: int) -> np.ndarray:
        query = (vector / np.sqrt((vector**2).sum())).astype(np.float32)
        start = [self.entry]
        for layer in range(len(self.layers) - 1, 0, -1):
            start = self.near(query, layer, start, 1).tolist()
        return self.near(query, 0, start, width)

    def to_bytes(self) -> bytes:
        return pickle.dumps((self.ids, self.vectors, self.layers, self.entry))

    @staticmethod
    def from_bytes(data: bytes) -> "Graph":
        return Graph(*pickle.loads(data))


def spread_out(unit: np.ndarray, node: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, best first, those nearer to the node than to one chosen before."""
    near = unit[candidates] @ node
    between = unit[candidates] @ unit[candidates].T
    chosen: list[int] = []
    for i in range(len(candidates)):
        if not chosen or between[i, chosen].max() < near[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
    if len(chosen) < most:  # fill up with the nearest of the rest
        rest = np.setdiff1d(np.arange(len(candidates)), chosen, assume_unique=True)
        chosen += rest[: most - len(chosen)].tolist()
    return candidates[chosen]


def layer_of(unit: np.ndarray, members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    place = np.full(len(unit), -1, np.int32)
    place[members] = np.arange(len(members))
    links = np.full((len(members), most), -1, np.int32)
    own = unit[members]
    for at in range(0, len(members), 256):
        block = own[at : at + 256] @ own[: at + 256].T
        for k in range(len(block)):
            i = at + k
            if i == 0:
                continue
            row = block[k, :i]
            best = np.argpartition(-row, CANDIDATES)[:CANDIDATES] if i > CANDIDATES else np.arange(i)
            best = best[np.argsort(-row[best], kind="stable")]
            chosen = spread_out(own, own[i], best, most // 2)
            links[i, : len(chosen)] = chosen
            for j in chosen.tolist():
                free = np.flatnonzero(links[j] < 0)
                if len(free):
                    links[j, free[0]] = i
                else:
                    pool = np.r_[links[j], i]
                    pool = pool[np.argsort(-(own[pool] @ own[j]), kind="stable")]
                    links[j] = spread_out(own, own[j], pool, most)
    return place, np.where(links >= 0, members[links], -1).astype(np.int32)


def graph_of(ids: np.ndarray, vectors: np.ndarray) -> Graph:
    order = np.random.default_rng(0).permutation(len(ids))
    ids, vectors = ids[order], vectors[order]
    levels = np.minimum((-np.log(np.random.default_rng(1).random(len(ids))) / np.log(M)).astype(int), 8)
    graph = Graph(ids, vectors, [], 0)
    for level in range(int(levels.max()) + 1):
        members = np.flatnonzero(levels >= level)
        graph.layers.append(layer_of(graph.unit, members, 2 * M if level == 0 else M))
    graph.entry = int(np.argmax(levels))
    return graph


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd) & F.exists("v", lambda x: x != 0))


def build(vectors: DataFrame, k: int = 5, shard: int = SHARD) -> DataFrame:
    """``shard, graph`` rows that answer searches for up to ``k`` neighbours."""
    rows = usable(vectors).distinct()
    # of equal vectors the first k + 1 ids are enough for any k neighbours beside the query itself
    first = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    nodes = rows.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    number = max(1, -(-nodes.count() // shard))
    dealt = nodes.withColumn("size", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(number)))

    def make(key, table):
        ids = table.column("ids").to_pylist()
        wide = np.full((len(ids), k + 1), -1, np.int64)
        for i, x in enumerate(ids):
            wide[i, : len(x)] = x
        vectors = np.array(table.column("v").to_pylist(), np.float64)
        order = np.argsort(wide[:, 0])  # rows come in any order
        data = graph_of(wide[order], vectors[order]).to_bytes()
        return pa.table({"shard": [key[0].as_py()], "size": pa.array([key[1].as_py()], pa.int32()), "graph": pa.array([data], pa.binary())})

    return dealt.groupBy("shard", "size").applyInArrow(make, "shard long, size int, graph binary")


def search(index: DataFrame, queries: DataFrame, k: int = 5, width: int = WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query."""
    asked = usable(queries).distinct().withColumn("size", F.size("v"))
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, asked.count() // BLOCK))))
    blocks = blocks.groupBy("size", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    pairs = index.join(blocks, "size").select("graph", "queries")

    def find(batches):
        for batch in batches:
            for data, queries in zip(batch.column(0), batch.column(1)):
                yield answers(Graph.from_bytes(data.as_py()), queries.as_py())

    def answers(graph: Graph, queries: list) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        for q in queries:
            vector = np.array(q["v"], np.float64)
            nodes = graph.search(vector, max(width, k + 1))
            score = (graph.vectors[nodes] * vector).sum(axis=1) / (graph.norms[nodes] * np.sqrt((vector**2).sum()))
            ids = graph.ids[nodes]
            score = np.repeat(score, ids.shape[1])
            ids = ids.ravel()
            keep = (ids >= 0) & (ids != q["vec_id"])
            ids, score = ids[keep], score[keep]
            best = np.lexsort((ids, -score))[:k]
            out[0].extend([q["vec_id"]] * len(best)), out[1].extend(ids[best].tolist()), out[2].extend(score[best].tolist())
        kinds = pa.int64(), pa.int64(), pa.float64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["query_id", "vec_id", "score"])

    found = pairs.repartition(pairs.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(find, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
