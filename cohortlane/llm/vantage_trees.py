"""Nearest neighbours by inner product with vantage-point trees, one tree per shard.

Equal vectors are first folded into one entry that keeps the smallest ids, as many as a result can name, so a very common
vector costs one entry. Entries are dealt into shards of bounded size by hash, queries into blocks of bounded size, and
every block meets every shard in one task, which builds the shard's tree and searches it for the block. Inner product
becomes distance by one more coordinate, ``sqrt(max_norm^2 - norm^2)`` of the shard, in which queries are zero.

A subtree is left out when ``factor`` times the least distance that the triangle inequality allows for it exceeds the
query's k-th best distance so far. ``factor=1`` is exact; larger factors prune more and may miss neighbours.

Null, empty and all-zero vectors and those with a null or non-finite component take no part, nor do rows without id.
Vectors of different length never meet. Repeated rows count once. Ties go to the smaller id. An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cohortlane.session import cut

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 256
#: Candidates kept beyond k before the exact scores decide.
SPARE = 8
FOUND = "query long, entry long, score double"


class Tree:
    """A vantage-point tree over the rows of ``points``, held as nested tuples of row numbers."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS):
        self.points, self.leaf = points, leaf
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        away = self._distance(self.points[rows], self.points[rows[0]])
        order = np.argsort(away, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        return (rows[0], away[near].max(), away[far].min(), self._build(rows[near]), self._build(rows[far]))

    @staticmethod
    def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((points - centre) ** 2).sum(axis=1), 0.0))

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances and row numbers of the k nearest found, per query; row -1 where there are fewer."""
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1)
        norms = (self.points**2).sum(axis=1)
        own = (queries**2).sum(axis=1)

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                square = own[who][:, None] + norms[node][None, :] - 2.0 * (queries[who] @ self.points[node].T)
                both = np.concatenate([best[who], np.maximum(square, 0.0)], axis=1)
                names = np.concatenate([rows[who], np.broadcast_to(node, square.shape)], axis=1)
                least = np.argpartition(both, k - 1, axis=1)[:, :k]
                best[who] = np.take_along_axis(both, least, axis=1)
                rows[who] = np.take_along_axis(names, least, axis=1)
                return
            vantage, inner, outer, near, far = node
            away = self._distance(queries[who], self.points[vantage])
            first_near = away <= (inner + outer) / 2

            def reach(child, bound, chosen) -> None:
                worst = np.sqrt(best[who[chosen]].max(axis=1))
                visit(child, who[chosen][factor * bound[chosen] <= worst])

            to_near, to_far = np.maximum(away - inner, 0.0), np.maximum(outer - away, 0.0)
            a, b = np.flatnonzero(first_near), np.flatnonzero(~first_near)
            reach(near, to_near, a)
            reach(far, to_far, a)
            reach(far, to_far, b)
            reach(near, to_near, b)

        visit(self.root, np.arange(len(queries)))
        return best, rows


def search_shard(entries: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """The best ``k`` entries of one shard for each query of one block, with exact scores."""
    if not len(entries) or not len(queries):
        return pd.DataFrame({"query": [], "entry": [], "score": []}).astype({"query": "int64", "entry": "int64"})
    points, wanted = np.stack(entries["vector"].to_numpy()), np.stack(queries["vector"].to_numpy())
    square = (points**2).sum(axis=1)
    lifted = np.column_stack([points, np.sqrt(np.maximum(square.max() - square, 0.0))])
    k = min(k + SPARE, len(points))
    _, rows = Tree(lifted).search(np.column_stack([wanted, np.zeros(len(wanted))]), k, factor)
    who, place = np.nonzero(rows >= 0)
    rows = rows[who, place]
    score = np.zeros(len(rows))
    for d in range(points.shape[1]):  # one order of summation, whatever the place in a block
        score += wanted[who, d] * points[rows, d]
    return pd.DataFrame({
        "query": queries["id"].to_numpy()[who], "entry": entries["id"].to_numpy()[rows], "score": score})


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, vector array<double>)`` of the rows that take part."""
    numbers = table.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return numbers.filter(F.col("id").isNotNull() & sound & F.exists("vector", lambda x: x != 0)).distinct()


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k nearest rows other than those with its own id."""
    rows, wanted = cut(usable(table, id_column, vector_column)), cut(usable(queries, id_column, vector_column))
    smallest = Window.partitionBy("vector").orderBy("id")
    copies = rows.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= k + 1)
    copies = cut(copies.withColumn("entry", F.min("id").over(Window.partitionBy("vector"))))
    # an id that carries several vectors heads several entries, so entries are numbered by their own row
    entries = cut(copies.filter("place = 1").select(F.monotonically_increasing_id().alias("id"), "vector"))
    members = cut(copies.select("vector", F.col("id").alias("vec_id")).join(
        entries.withColumnRenamed("id", "entry"), "vector").select("entry", "vec_id"))
    asked = cut(wanted.select("vector").distinct().select(F.monotonically_increasing_id().alias("id"), "vector"))
    shards = -(-entries.count() // SHARD_ROWS)
    blocks = -(-asked.count() // BLOCK_ROWS)

    def dealt(frame: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(max(m, 1) - 1))).alias(other)
        return frame.select(
            "id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(max(n, 1))).cast("int").alias(own), every)

    keys = ["dim", "shard", "block"]
    left = dealt(entries, "shard", shards, "block", blocks).groupBy(*keys)
    right = dealt(asked, "block", blocks, "shard", shards).groupBy(*keys)
    found = left.cogroup(right).applyInPandas(lambda a, b: search_shard(a, b, k + 1, factor), FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("first"))
    firsts = members.groupBy("entry").agg(F.min("vec_id").alias("first"))
    # of equal scores the entry with the smaller id goes on, as its members may fill the last places
    kept = found.join(firsts, "entry").withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id"))
    hits = kept.select("query", "entry", "score").join(members, "entry")
    hits = cut(hits.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k + 1)
               .select("query", "vec_id", "score"))
    owners = wanted.select(F.col("id").alias("query_id"), "vector").join(
        asked.withColumnRenamed("id", "query"), "vector").select("query_id", "query")
    pairs = owners.join(hits, "query").filter("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    ranked = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")


ORACLE = """
with v as (select distinct vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0)
select query_id, cast(row_number() over w as int) as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id) qualify row_number() over w <= 20"""
