"""Exact top-k search by inner product with KD-trees per shard.

Vectors become integers, ``floor(256 * x)``. They are dealt by a hash of the id into
shards of about ``SHARD_ROWS`` rows; each shard is searched in a task that builds a
KD-tree over it: median splits along the widest side, a tight box and the smallest id
at every node. A query goes through the tree best box first; the bound of a box is
the largest inner product any point of it can have. A box is left out if its bound is
below the kth score so far, or equal to it with only larger ids inside.

Queries come in blocks of ``QUERY_ROWS``, so neither a shard nor a block of queries
outgrows a task: a group is one block on one shard. In the first round each query is
searched in one shard; its kth score then goes along to all other shards.

Defined results: null vectors, empty ones and those that hold a null or a component
that is not finite take no part; only vectors of equal length are compared; ties go
to the smaller id; of rows that repeat an id each is a row of its own, and none of them is a
candidate of a query with that id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS = 8192
QUERY_ROWS = 4096
LEAF_ROWS = 128
_HITS = "query_id long, score long, vec_id long"
_FAR = -(1 << 62)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (longs) of the rows that take part."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(sound, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("vec_id"),
                F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64)


class Tree:
    """Nodes in arrays; ``order`` lists the rows of the leaves one after another."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        # Products are exact in doubles below 2**53, else they are computed in integers.
        self.exact = float(np.abs(points.astype(np.float64)).max(initial=0))
        self.points, self.ids = points, ids
        self.order = np.arange(len(ids))
        self.span, self.child, low, high, least = [], [], [], [], []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            node, rows = len(self.span), self.order[start:end]
            if parent >= 0:
                self.child[parent][side] = node
            box = points[rows]
            lo, hi = box.min(axis=0), box.max(axis=0)
            low.append(lo), high.append(hi), least.append(ids[rows].min())
            self.span.append((start, end)), self.child.append([-1, -1])
            if end - start <= leaf:
                continue
            middle = (end - start) // 2
            self.order[start:end] = rows[np.argpartition(box[:, np.argmax(hi - lo)], middle)]
            stack.append((start + middle, end, node, 1))
            stack.append((start, start + middle, node, 0))
        self.low, self.high, self.least = np.array(low), np.array(high), np.array(least)

    def search(self, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int) -> list[tuple]:
        """(query_id, score, vec_id) of the k best rows of this tree that can still matter."""
        small = self.exact * float(np.abs(queries.astype(np.float64)).max(initial=0)) * queries.shape[1] < 2.0 ** 53
        kind = np.float64 if small else object
        points, q = self.points[self.order].astype(kind), queries.astype(kind)
        ids = self.ids[self.order]
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        bounds = plus @ self.high.astype(kind).T + minus @ self.low.astype(kind).T
        found = []
        for i, own in enumerate(query_ids):
            bound, best = bounds[i], []  # best: a heap of (score, -id), the worst first
            floor = floors[i]
            heap = [(-bound[0], 0)]
            while heap:
                top, node = heapq.heappop(heap)
                worst = best[0] if len(best) == k else None
                limit = max(floor, worst[0]) if worst else floor
                if -top < limit:
                    break
                if worst and -top == worst[0] and self.least[node] > -worst[1]:
                    continue
                left, right = self.child[node]
                if left >= 0:
                    heapq.heappush(heap, (-bound[left], left))
                    heapq.heappush(heap, (-bound[right], right))
                    continue
                start, end = self.span[node]
                scores = points[start:end] @ q[i]
                for j in np.flatnonzero(scores >= limit):
                    other = ids[start + j]
                    if other == own:
                        continue
                    entry = (int(scores[j]), -int(other))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            found += [(int(own), score, -other) for score, other in best]
        return found


def _searcher(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "score": [], "vec_id": []}, dtype="int64")
        tree = Tree(_matrix(rows["v"]), rows["vec_id"].to_numpy())
        hits = tree.search(_matrix(queries["v"]), queries["vec_id"].to_numpy(), queries["floor"].to_numpy(), k)
        return pd.DataFrame(hits, columns=["query_id", "score", "vec_id"], dtype="int64")

    return search


def _round(queries: DataFrame, rows: DataFrame, shards: Column, k: int) -> DataFrame:
    keys = ["dim", "block", "shard"]
    queries = queries.withColumn("shard", F.explode(shards)).select(*keys, "vec_id", "v", "floor")
    # A shard is sent once for each block of queries that visits it.
    visits = queries.select(*[F.col(c).alias(f"to_{c}") for c in keys]).distinct()
    rows = rows.join(visits, (F.col("dim") == F.col("to_dim")) & (F.col("shard") == F.col("to_shard"))).select(
        *[F.col(f"to_{c}").alias(c) for c in keys], F.col("vec_id").alias("vec_id"), F.col("v").alias("v"))
    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_searcher(k), _HITS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row where ``is_query``."""
    base = written(quantised(vectors.withColumn(id_col, F.col(id_col).cast("long")), id_col, vector_col)
                   .withColumn("is_query", F.coalesce(is_query, F.lit(False)))
                   .withColumn("dim", F.size("v")), "kd-vectors")
    n, n_queries = base.agg(F.count("*"), F.sum(F.col("is_query").cast("long"))).first()
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-(n_queries or 0) // query_rows))
    # Copies of an id are dealt by their number too, so that they do not meet in one shard.
    base = base.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    queries = (
        base.filter("is_query and vec_id is not null").dropDuplicates(["vec_id", "v"])
        .withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
        .withColumn("home", F.col("shard"))
    )
    rows = base.filter("vec_id is not null").select("dim", "shard", "vec_id", "v")
    first = written(_round(queries.withColumn("floor", F.lit(_FAR)), rows, F.array("home"), k), "kd-first")
    # The kth score of the first round, if there are k.
    floors = first.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    queries = queries.join(floors, queries["vec_id"] == floors["query_id"], "left").withColumn(
        "floor", F.when(F.col("n") >= k, F.col("kth")).otherwise(F.lit(_FAR)))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    hits = first.unionByName(_round(queries, rows, others, k))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
