"""Hard-negative mining over shared lists of anchor clusters.

Anchors are clustered by angle. For a cluster, every candidate has an upper bound on its inner product with any member:
its length times the cosine of its angle to the cluster's centre less the cluster's radius. A task holds one shard of
the candidates and one block of the anchors, sorts the shard by that bound once per cluster, and lets every member walk
the list. A member stops once its own length times the next bound falls below what it still needs, be it the score of
its last place or the least score it may take; all that follows is then certified not to matter. Scores are exact
integers, bounds have slack for rounding, so the result is that of comparing all pairs.

Two walks are made: one for the first positives of every anchor, one for the first negatives of every pair of anchor and
positive whose scores lie between two per cents of the positive's score. The best of each shard are merged by a ranked
window. Shards and blocks are dealt by hash, so no group grows with a label, a cluster or copies of a vector. Centres are
fitted on at most ``SAMPLE`` anchors; they only order the lists and never change the result.

Rows without id, label or vector, or with a null component, take no part; vectors meet only those of their own length.
Equal rows count once; different rows under one id are rows of their own, and an anchor's other rows are all but itself.
Ties go to the smaller id. Pairs without a fitting negative have no row. A table without rows or anchors gives an empty
result; other columns are ignored. A job fails, with a message, if scores exceed 62 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cohortlane.session import cut

#: Rows of one shard of candidates, and of one block of anchors.
SHARD_ROWS, BLOCK_ROWS = 8192, 16384
#: Anchors that centres are fitted on, most centres, and members that walk together.
SAMPLE, MOST_CENTRES, TOGETHER = 4096, 128, 256
#: Candidates of the first step of a walk; every step doubles, up to the second number.
FIRST_STEP, MOST_STEP = 128, 4096
LEAST, MOST = -(1 << 62), 1 << 62
FOUND = "anchor long, request int, row long, id long, score long"


def units(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and directions of length one (zero vectors keep no direction)."""
    points = points.astype(np.float64)
    lengths = np.sqrt((points**2).sum(axis=1))
    return lengths, points / np.where(lengths > 0, lengths, 1.0)[:, None]


def fit_centres(points: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Directions of clusters by spherical k-means; the first ones are spread over the given order."""
    lengths, directions = units(points)
    directions = directions[lengths > 0]
    k = min(int(np.ceil(np.sqrt(len(directions)))), MOST_CENTRES)
    if not k:
        return np.zeros((1, points.shape[1]))
    centres = directions[np.linspace(0, len(directions) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (directions @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, directions)
        lengths, fitted = units(sums)
        centres = np.where(lengths[:, None] > 0, fitted, centres)
    return centres


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, all of the left with all of the right."""
    widest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if widest < 2.0**53:  # doubles are then exact
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if widest < 2.0**62:
        return left @ right.T
    raise ValueError("Inner products exceed 62 bits; scale the components down.")


def best_of(request, score, name, place, k: int):
    """The k entries of highest score per request, ties by name; sorted."""
    order = np.lexsort((name, -score, request))
    request, score, name, place = request[order], score[order], name[order], place[order]
    kept = np.arange(len(request)) - np.searchsorted(request, request, "left") < k
    return request[kept], score[kept], name[kept], place[kept]


class SharedList:
    """The candidates of a shard in the order of their bound for one cluster of anchors."""

    def __init__(self, members: np.ndarray, lengths: np.ndarray, directions: np.ndarray):
        member_lengths, member_directions = units(members)
        _, centre = units(member_directions.sum(axis=0, keepdims=True))
        turned = np.arccos(np.clip(member_directions @ centre[0], -1.0, 1.0))
        radius = turned[member_lengths > 0].max(initial=0.0) + 1e-7
        away = np.arccos(np.clip(directions @ centre[0], -1.0, 1.0))
        bound = lengths * np.cos(np.clip(away - radius, 0.0, np.pi))
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order] * (1.0 + np.sign(bound[self.order]) * 1e-9) + 1e-6 / (1.0 + member_lengths.max(initial=0.0))
        self.member_lengths = member_lengths


def walk(shared: SharedList, who: np.ndarray, members: np.ndarray, may: "callable", asked: np.ndarray, low: np.ndarray,
         high: np.ndarray, points: np.ndarray, names: np.ndarray, k: int):
    """The k best candidates of every request, as (request, score, name, place in the shard).

    ``who`` are the members that walk, ``asked`` the place in ``who`` of each request's member, ``low`` and ``high`` the
    scores it takes; ``may(rows, columns)`` tells which members may take which candidates.
    """
    needed = low.astype(np.int64).copy()
    kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    open_, at, step = np.arange(len(asked)), 0, FIRST_STEP
    lengths = shared.member_lengths[who]
    while at < len(shared.order):
        reach = lengths[asked[open_]] * shared.bound[at]
        open_ = open_[reach + 1e-6 * np.abs(reach) / 1e3 + 0.5 > needed[open_]]  # a score is a whole number
        if not len(open_):
            break
        columns = shared.order[at : at + step]
        at, step = at + step, min(2 * step, MOST_STEP)
        rows, place = np.unique(asked[open_], return_inverse=True)
        scores = products(members[who[rows]], points[columns])
        allowed = may(who[rows], columns)
        mine = scores[place]
        good = allowed[place] & (mine >= needed[open_][:, None]) & (mine <= high[open_][:, None])
        r, c = np.nonzero(good)
        if not len(r):
            continue
        fresh = (open_[r], mine[r, c], names[columns[c]], columns[c])
        kept = best_of(*[np.concatenate(pair) for pair in zip(kept, fresh)], k)
        last = np.flatnonzero(np.bincount(kept[0], minlength=len(asked)) == k)
        ends = np.searchsorted(kept[0], last, "right") - 1
        needed[last] = np.maximum(needed[last], kept[1][ends])
    return kept


def search(shard: pd.DataFrame, block: pd.DataFrame, centres: dict[int, np.ndarray], same: bool, k: int) -> pd.DataFrame:
    """The best ``k`` rows of one shard for every request of one block of anchors."""
    columns = [c.split()[0] for c in FOUND.split(", ")]
    if not len(shard) or not len(block):
        return pd.DataFrame({c: [] for c in columns}).astype("int64")
    points = np.stack(shard["vector"].to_numpy()).astype(np.int64)
    members = np.stack(block["vector"].to_numpy()).astype(np.int64)
    codes = pd.factorize(pd.concat([shard["label"], block["label"]], ignore_index=True))[0]
    labels, own_labels = codes[: len(shard)], codes[len(shard) :]
    rows, own_rows, names = shard["row"].to_numpy(), block["row"].to_numpy(), shard["id"].to_numpy()

    def may(who: np.ndarray, which: np.ndarray) -> np.ndarray:
        alike = own_labels[who][:, None] == labels[which][None, :]
        return (alike if same else ~alike) & (own_rows[who][:, None] != rows[which][None, :])

    lengths, directions = units(points)
    middle = centres.get(points.shape[1], np.zeros((1, points.shape[1])))
    cluster = (units(members)[1] @ middle.T).argmax(axis=1)
    found = []
    for c in np.unique(cluster):
        inside = np.flatnonzero(cluster == c)
        shared = SharedList(members[inside], lengths, directions)
        for first in range(0, len(inside), TOGETHER):
            group = np.arange(first, min(first + TOGETHER, len(inside)))
            sizes = np.array([len(block["low"].iloc[i]) for i in inside[group]])
            low, high = (np.concatenate([np.asarray(block[name].iloc[i], dtype=np.int64) for i in inside[group]]) for name in ("low", "high"))
            asked = np.repeat(np.arange(len(group)), sizes)
            request, score, name, place = walk(
                shared, group, members[inside], lambda who, which: may(inside[who], which), asked, low, high, points, names, k)
            number = np.arange(len(asked)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found.append(pd.DataFrame(dict(zip(columns, (
                own_rows[inside[group[asked[request]]]], number[request], rows[place], name, score)))))
    return pd.concat(found, ignore_index=True)


def best_rows(rows: DataFrame, asked: DataFrame, centres: dict, same: bool, k: int) -> DataFrame:
    """``(anchor, request, row, id, score, place)``: the first ``k`` rows of every request, over all shards."""
    shards, blocks = (max(-(-frame.count() // size), 1) for frame, size in ((rows, SHARD_ROWS), (asked, BLOCK_ROWS)))

    def dealt(frame: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return frame.withColumn("dim", F.size("vector")).withColumn(
            own, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    keys = ["dim", "shard", "block"]
    left = dealt(rows.select("row", "id", "label", "vector"), "shard", shards, "block", blocks).groupBy(*keys)
    right = dealt(asked.select("row", "label", "vector", "low", "high"), "block", blocks, "shard", shards).groupBy(*keys)
    found = left.cogroup(right).applyInPandas(lambda a, b: search(a, b, centres, same, k), FOUND)
    order = Window.partitionBy("anchor", "request").orderBy(F.desc("score"), F.col("id"), F.col("row"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def sampled_centres(anchors: DataFrame) -> dict[int, np.ndarray]:
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vector").toPandas()["vector"]
    sizes = sample.map(len)
    return {int(d): fit_centres(np.stack(sample[sizes == d].to_numpy())) for d in sizes.unique()}


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows(id long, label, vector array<long>)``; ``is_anchor`` is a condition on them. A negative's score lies between
    ``least`` and ``most`` per cent of the positive's.
    """
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    sound &= F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    distinct = rows.filter(sound).select("id", "label", F.col("vector").cast("array<bigint>").alias("vector")).distinct()
    every = cut(distinct.withColumn("row", F.monotonically_increasing_id()))
    anchors = cut(every.filter(is_anchor))
    centres = sampled_centres(anchors)
    any_ = {"low": F.array(F.lit(LEAST)), "high": F.array(F.lit(MOST))}
    firsts = cut(best_rows(every, anchors.withColumns(any_), centres, True, positives))
    listed = firsts.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("p"))
    limits = {
        "low": F.transform("p", lambda p: F.ceil(p["score"] * least / F.lit(100).cast("decimal(3,0)")).cast("long")),
        "high": F.transform("p", lambda p: F.floor(p["score"] * most / F.lit(100).cast("decimal(3,0)")).cast("long")),
    }
    asked = cut(anchors.join(listed, anchors["row"] == listed["anchor"]).withColumns(limits))
    found = best_rows(every, asked, centres, False, negatives)
    named = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("p").alias("request", "p"))
    return found.join(named, ["anchor", "request"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("place").cast(T.IntegerType()).alias("rank"),
        F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def scaled(table: DataFrame) -> DataFrame:
    """``(id, label, vector)`` of ``embeddings``, as the registered query takes it.

    Every seventh id has the next of ten labels; a component x becomes floor(256 * x), null where it is not finite.
    """
    finite = lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(x * 256.0).cast("long"))
    return table.select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform(F.col("embedding").cast("array<double>"), finite).alias("vector"))


ORACLE = """
with r as (select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding::double[], lambda x: cast(floor(256 * x) as bigint)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
n as (select *, row_number() over () as row from r),
s as (select a.row as anchor, a.vec_id as anchor_id, c.row, c.vec_id, a.label = c.label as same,
    cast(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])), 0) as bigint) as score
  from n a join n c on a.row <> c.row and len(a.e) = len(c.e) where a.vec_id % 50 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, cast(row_number() over w as int) as rank, s.vec_id as negative_id,
  p.score as positive_score, s.score as negative_score
from p join s on s.anchor = p.anchor and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
window w as (partition by p.anchor, p.row order by s.score desc, s.vec_id) qualify row_number() over w <= 3"""
