"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Vectors are dealt to shards by a hash of their id, so that shards are even whatever the vectors
are. A shard's graph is over its distinct vectors, with the ids of each: a vector that a third of
all rows have is one node of each shard. Graphs are stored as flat arrays, one row for a shard. Each
query goes to every shard; shards answer from their graph, and the answers are merged by exact
distance. A search task holds one graph and one batch of queries at a time.

A shard's rows grow with the root of the table, up to SHARD_BYTES of vectors: both the graphs and
the searches of each query stay few; a larger graph is searched more widely. Queries are dealt to parts, so that a graph's are many tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import releasing
from twinview.session import new_table_dir

SHARD_ROWS = 1024  # as many shards as a shard has times as many rows
SHARD_BYTES = 32 << 20
PART_QUERIES = 1 << 14
LINKS = 12  # on the upper levels; twice as many on the lowest
EF_BUILD = 48
EF_SEARCH = 96
EF_ROOT = 4  # a search is at least this many times as wide as the root of its graph's nodes
SEED = 7
QUERY_EVERY = 100
NEAREST = 10


class Graph:
    """A graph over the rows of ``vectors``, as flat arrays of neighbours (-1: none).

    low[i]: neighbours of node i on the lowest level; high[first[i] + l - 1]: on level l, for
    nodes of level 1 or more.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: int = LINKS):
        self.vectors, self.levels, self.links = vectors, levels, links
        self.first = np.concatenate([[0], np.cumsum(levels)]).astype(np.int64)[:-1]
        self.low = np.full((len(vectors), 2 * links), -1, np.int32)
        self.high = np.full((int(levels.sum()), links), -1, np.int32)
        self.entry = 0

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, ef: int = EF_BUILD, seed: int = SEED) -> Graph:
        draws = np.random.default_rng(seed).random(len(vectors))
        levels = (-np.log(np.maximum(draws, 1e-12)) / math.log(links)).astype(np.int64)
        graph = cls(vectors, levels, links)
        for node in range(1, len(vectors)):
            graph._insert(node, ef)
        return graph

    def _row(self, node: int, level: int) -> np.ndarray:
        return self.low[node] if level == 0 else self.high[self.first[node] + level - 1]

    def _distances(self, point: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        apart = self.vectors[nodes] - point
        return np.einsum("ij,ij->i", apart, apart)

    def _near(self, point: np.ndarray, starts: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """Up to ``ef`` near nodes of a level as (squared distance, node), nearest first."""
        seen = np.zeros(len(self.vectors), bool)
        seen[[n for _, n in starts]] = True
        open_ = list(starts)
        heapq.heapify(open_)
        best = [(-d, n) for d, n in starts]
        heapq.heapify(best)
        while open_:
            d, node = heapq.heappop(open_)
            if len(best) >= ef and d > -best[0][0]:
                break
            row = self._row(node, level)
            row = row[row >= 0]
            row = row[~seen[row]]
            if not len(row):
                continue
            seen[row] = True
            far = self._distances(point, row)
            if len(best) >= ef:
                close = far < -best[0][0]
                row, far = row[close], far[close]
            for d, n in zip(far.tolist(), row.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(open_, (d, n))
        return sorted((-d, n) for d, n in best)

    def _chosen(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions first: nearer to the node than to those chosen."""
        if len(near) <= most:
            return [n for _, n in near]
        points = self.vectors[[n for _, n in near]]
        squares = np.einsum("ij,ij->i", points, points)
        apart = (squares[:, None] + squares[None, :] - 2 * points @ points.T).tolist()
        taken: list[int] = []
        for i, (d, _) in enumerate(near):
            row = apart[i]
            if all(row[j] > d for j in taken):
                taken.append(i)
                if len(taken) == most:
                    break
        others = iter(i for i in range(len(near)) if i not in set(taken))
        taken += [next(others) for _ in range(most - len(taken))]
        return [near[i][1] for i in taken]

    def _insert(self, node: int, ef: int) -> None:
        point, level = self.vectors[node], int(self.levels[node])
        top = int(self.levels[self.entry])
        at = [(float(self._distances(point, np.array([self.entry]))[0]), self.entry)]
        for above in range(top, level, -1):
            at = self._near(point, at, 1, above)
        for own in range(min(top, level), -1, -1):
            at = self._near(point, at, ef, own)
            chosen = self._chosen(at, self.links)
            self._row(node, own)[: len(chosen)] = chosen
            for other in chosen:
                row = self._row(other, own)
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                    continue
                ids = np.append(row, node)
                far = self._distances(self.vectors[other], ids)
                row[:] = self._chosen(sorted(zip(far.tolist(), ids.tolist())), len(row))
        if level > top:
            self.entry = node

    def search(self, point: np.ndarray, ef: int) -> list[int]:
        """Up to ``ef`` near nodes, nearest first."""
        at = [(float(self._distances(point, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            at = self._near(point, at, 1, level)
        return [n for _, n in self._near(point, at, ef, 0)]


# Arrays of a stored graph, in the order of the columns.
_ARRAYS = {"vectors": np.float64, "levels": np.int64, "low": np.int32, "high": np.int32, "ids": np.int64, "starts": np.int64}
INDEX = T.StructType([
    T.StructField("dim", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("entry", T.IntegerType()),
    *(T.StructField(n, T.BinaryType()) for n in _ARRAYS)])


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null, not zero, and of finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0))


def shards_of(rows: int, components: int) -> int:
    """The number of shards of ``rows`` vectors with ``components`` numbers in all."""
    return max(1, round(math.sqrt(rows / SHARD_ROWS)), -(-8 * components // SHARD_BYTES))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def build_index(vectors: DataFrame, shards: int, vec_id: str = "vec_id", vector: str = "embedding",
                links: int = LINKS, ef: int = EF_BUILD, seed: int = SEED) -> DataFrame:
    """A row of flat arrays (``INDEX``) for each shard and dimension.

    Rows without an id, and those that are not ``usable``, are left out. Rows with one id are all
    kept. ``shards`` bounds a graph's size; it should grow with the rows.
    """
    rows = usable(vectors, vector).where(F.col(vec_id).isNotNull()).select(
        F.size(vector).alias("dim"), F.pmod(F.xxhash64(vec_id), F.lit(shards)).cast("int").alias("shard"),
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    @releasing
    def build(group: pa.Table) -> pa.Table:
        dim, shard = group["dim"][0].as_py(), group["shard"][0].as_py()
        points, ids = _matrix(group["v"], dim), group["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        points, ids = points[order], ids[order]
        distinct, node = np.unique(points, axis=0, return_inverse=True)
        _, first = np.unique(node, return_index=True)  # in the order of their smallest ids
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first, kind="stable")] = np.arange(len(first))
        node, distinct = rank[node.reshape(-1)], distinct[np.argsort(first, kind="stable")]
        members = np.argsort(node, kind="stable")
        starts = np.searchsorted(node[members], np.arange(len(distinct) + 1))
        graph = Graph.build(distinct.astype(np.float32), links, ef, seed + shard)
        arrays = {"vectors": distinct, "levels": graph.levels, "low": graph.low, "high": graph.high, "ids": ids[members], "starts": starts}
        flat = [pa.array([np.ascontiguousarray(arrays[n], kind).tobytes()], pa.binary()) for n, kind in _ARRAYS.items()]
        return pa.Table.from_arrays([pa.array([x], pa.int32()) for x in (dim, shard, graph.entry)] + flat, INDEX.names)

    # a graph takes long to build for its bytes: by an explicit number, small partitions are not joined
    return rows.repartition(4 * shards, "dim", "shard").groupBy("dim", "shard").applyInArrow(build, INDEX)


class _Shard:
    """A stored graph, opened."""

    def __init__(self, row: dict, links: int):
        get = {n: np.frombuffer(row[n], kind) for n, kind in _ARRAYS.items()}
        self.exact = get["vectors"].reshape(-1, row["dim"])
        self.graph = Graph(self.exact.astype(np.float32), get["levels"], links)
        self.graph.low, self.graph.high = get["low"].reshape(-1, 2 * links), get["high"].reshape(-1, links)
        self.graph.entry, self.ids, self.starts = row["entry"], get["ids"], get["starts"]
        self.width = math.isqrt(EF_ROOT * EF_ROOT * len(self.exact))

    def nearest(self, query: int, point: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, without ``query`` itself."""
        nodes = np.array(self.graph.search(point.astype(np.float32), max(ef, k + 1, self.width)))
        apart = self.exact[nodes] - point
        far = np.sqrt((apart * apart).sum(1))
        count = np.minimum(self.starts[nodes + 1] - self.starts[nodes], k + 1)  # more of a vector are never needed
        after = np.cumsum(count)
        at = np.repeat(self.starts[nodes] - (after - count), count) + np.arange(after[-1])
        ids, far = self.ids[at], np.repeat(far, count)
        other = ids != query
        ids, far = ids[other], far[other]
        order = np.lexsort((ids, far))[:k]
        return ids[order], far[order]


def search(index: DataFrame, queries: DataFrame, shards: int, k: int = NEAREST, ef: int = EF_SEARCH,
           query_id: str = "vec_id", vector: str = "embedding", links: int = LINKS, part_queries: int = PART_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query's dimension, by
    Euclidean distance and then id, the query's own id left out.

    Queries that are not ``usable`` or without an id get no rows, repeated ones count once. With
    fewer than k candidates all that are found are returned. A task has about ``part_queries`` queries
    of one shard; queries are counted for it.
    """
    asked = usable(queries, vector).where(F.col(query_id).isNotNull()).select(
        F.size(vector).alias("dim"), F.col(query_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    parts = max(1, -(-queries.count() // part_queries))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<int>")))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    graphs = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<int>")))
    rows = graphs.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    task = ["dim", "shard", "part"]
    rows = rows.repartition(4 * shards * parts, *task).sortWithinPartitions(*task, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, own = None, None
        for batch in batches:
            kinds, keys = batch["kind"].to_numpy(), np.stack([batch[c].to_numpy() for c in task], 1)
            new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1) | (kinds[1:] != kinds[:-1])])
            edges = np.append(np.flatnonzero(new), len(kinds)).tolist()
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(edges, edges[1:]):
                key = tuple(keys[a].tolist())
                if kinds[a] == 0:
                    opened, own = _Shard(batch.slice(a, 1).to_pylist()[0], links), key
                elif key == own:  # else nothing of this dimension is in the shard
                    points, ids_ = _matrix(batch["v"].slice(a, b - a), key[0]), batch["query_id"].slice(a, b - a).to_numpy()
                    for query, point in zip(ids_.tolist(), points):
                        ids, far = opened.nearest(query, point, k, ef)
                        found.append((np.full(len(ids), query), ids, far))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "vec_id", "score"])

    answers = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found of every hundredth id."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(F.size("embedding"), F.lit(0))).alias("numbers")).first()
    shards = shards_of(size["rows"], size["numbers"] or 0)
    path = new_table_dir(spark, "hnsw")
    build_index(vectors, shards).write.parquet(path)
    return search(spark.read.schema(INDEX).parquet(path), vectors.where(F.col("vec_id") % QUERY_EVERY == 0), shards)
