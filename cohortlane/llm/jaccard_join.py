"""N-gram Jaccard join: a size-aware join that enumerates subsets of small sets and scans inverted lists for large ones.

A document's set holds its distinct five-word shingles as 64-bit hashes. Documents with equal sets form a class, named by
its smallest id; only that one goes on, so copies cost one row each. Two sets of sizes a and b link if they share at
least ``need(a, b)`` shingles.

* Small sets (size up to a boundary): for every size a partner may have, all subsets of the needed size are enumerated.
  Whoever shares such a subset with the smallest set of its bucket is linked to it, so a bucket gives a star of links.
* Large sets: each is listed under the first shingles of its set, as many as make sure that linked sets share more than a
  twentieth of either (the prefix filter, lengthened). The order of shingles is by hash, with those listed more than once
  last; any order is right, this one keeps the lists short. In each of ``ROUNDS`` rounds every document is compared with one pivot at most: of the central
  members of its lists, the most central one that it has not met and that is in another component. So a large group of
  near copies costs a star, not all pairs. Then all documents that share as many listed shingles with other components as
  a link needs are compared by the shingles that several components hold, under a positional filter, so no link between
  components is lost; members of a list are never paired without that filter. Documents that only happen to share a few
  shingles, more of them the larger the table, stay out of that step.
* The boundary has the least estimated cost: subsets enumerated against entries and list members met.

Documents without words have an empty set and stand alone. Null texts count as empty. Rows without id are returned with
null component. Rows that repeat an id are one node with the links of all. An empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlane.llm.components import connected_components
from cohortlane.llm.text import coded, mixed, sliced, words
from cohortlane.session import cut

SHINGLE = 5
#: Similarity as PART / WHOLE.
PART, WHOLE = 80, 100
#: Shingles are listed down to this part of a set; the less, the more of them linked sets share.
UNLISTED = 75
#: Passes that leave out documents which share too little with those that the pass before left.
PASSES = 3
#: Sets larger than this are never enumerated.
MOST_SMALL = 16
#: A shingle listed more often than this goes to the end of the order, for at most MOST_FREQUENT shingles.
FREQUENT, MOST_FREQUENT = 1, 1 << 19
#: Rounds of comparison with one pivot a document, before components are compared list by list.
ROUNDS = 3
#: Ids are broadcast up to so many rows (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1 << 20


def need(a, b):
    """Least overlap of linked sets of sizes a and b; for numbers and for columns of sizes."""
    if isinstance(a, Column):
        return F.ceil((a + b) * PART / (PART + WHOLE))
    return -(-(a + b) * PART // (PART + WHOLE))


def prefix(n):
    """How many shingles of a set of size n make sure that linked sets share one."""
    if isinstance(n, Column):
        return n - F.ceil(n * PART / WHOLE) + 1
    return n - -(-n * PART // WHOLE) + 1


def listing(n):
    """How many shingles of a set of size n are listed in the large sets' lists."""
    if isinstance(n, Column):
        return n - F.ceil(n * UNLISTED / WHOLE) + 1
    return n - -(-n * UNLISTED // WHOLE) + 1


def shingle_sets(texts) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    codes, distinct, bounds = coded([words(t) for t in texts])
    if not len(codes):
        return [np.zeros(0, dtype=np.int64) for _ in texts]
    hashes = pd.util.hash_array(distinct, categorize=False)[codes]
    rolled = hashes[: max(len(hashes) - SHINGLE + 1, 0)]
    for k in range(1, SHINGLE):
        rolled = mixed(rolled) + hashes[k : k + len(rolled)]
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(rolled[a : b - SHINGLE + 1].view(np.int64)))
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)
            for h in hashes[a:b]:
                whole = mixed(whole) + h
            sets.append(mixed(whole).view(np.int64))
        else:
            sets.append(np.zeros(0, dtype=np.int64))
    return sets


def _signed(batches):
    for batch in sliced(batches):
        sets = shingle_sets(batch["text"])
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
            "print": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "keys": [s[: prefix(len(s))] if len(s) else s for s in sets],
        })


def _listed(frequent, above: int):
    """Listed shingles of the sets that large ones may link to: size ``above`` and more."""
    def run(batches):
        last = frequent.value
        for batch in sliced(batches):
            rows = []
            for name, s in zip(batch["doc_id"], shingle_sets(batch["text"])):
                if len(s) >= max(above, 1):
                    if len(last):
                        late = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s
                        s = np.concatenate([s[~late], s[late]])
                    rows.append((name, len(s), s[: listing(len(s))]))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "keys"])

    return run


def _enumerated(boundary: int):
    """Subsets of small sets: one row per subset, with the smaller of the two sizes that it stands for."""
    def run(batches):
        for batch in sliced(batches):
            rows = []
            for name, s in zip(batch["doc_id"], shingle_sets(batch["text"])):
                n = len(s)
                if 1 < n <= boundary:
                    for m in range(-(-n * PART // WHOLE), min(boundary, n * WHOLE // PART) + 1):
                        low, high = min(n, m), max(n, m)
                        for subset in combinations(s.tolist(), need(n, m)):
                            text = np.array([low, high, *subset], dtype=np.int64).tobytes()
                            rows.append((name, n, low, hashlib.blake2b(text, digest_size=16).digest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "low", "subset"])

    return run


def _plain_sets(batches):
    for batch in sliced(batches):
        yield pd.DataFrame({"doc_id": batch["doc_id"], "elements": shingle_sets(batch["text"])})


def subsets_of(n: int, boundary: int) -> int:
    return sum(comb(n, need(n, m)) for m in range(-(-n * PART // WHOLE), min(boundary, n * WHOLE // PART) + 1))


def choose_boundary(sizes: dict[int, int], met: float) -> int:
    """The largest small size: least sum of subsets, listed entries, and list members met per entry."""
    def cost(boundary: int) -> float:
        small = sum(sizes.get(n, 0) * subsets_of(n, boundary) for n in range(2, boundary + 1))
        first = -(-(boundary + 1) * PART // WHOLE)
        return small + sum(sizes.get(n, 0) * listing(n) * (1 + met) for n in range(first, MOST_SMALL * WHOLE // PART + 2))

    return min(range(1, MOST_SMALL + 1), key=cost)


def _of_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with a table of ids, whose size was counted."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def frequent_above(often: DataFrame) -> int:
    """The least count, FREQUENT or more, that at most ``MOST_FREQUENT`` shingles exceed (beyond 10,000, whatever exceeds it)."""
    counts = often.groupBy(F.least("count", F.lit(10_000)).alias("c")).agg(F.count("*").alias("n")).collect()
    above = FREQUENT
    while sum(r["n"] for r in counts if r["c"] > above) > MOST_FREQUENT:
        above = min(r["c"] for r in counts if r["c"] > above)
    return above


def links(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between documents whose components are those of all links. ``signed``: see ``_signed``."""
    spark = docs.sparkSession
    full = signed.filter("n > 0")
    classes = full.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("c"))
    copies = cut(full.join(classes.filter("c > 1"), "print").filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct())
    # an id with several texts stays for the sake of its others
    several = full.groupBy("doc_id").agg(F.min("print").alias("x"), F.max("print").alias("y")).filter("x <> y")
    dropped = copies.select(F.col("b").alias("doc_id")).distinct().join(several.select("doc_id"), "doc_id", "left_anti")
    texts = _of_ids(docs, cut(dropped), "left_anti")

    often = cut(full.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1"))
    listed = full.agg(F.sum(F.size("keys"))).first()[0] or 1
    bounded = F.least("count", F.lit(FREQUENT)).cast("double")
    met = often.agg(F.sum(bounded * (bounded - 1))).first()[0] or 0.0
    last = often.filter(F.col("count") > frequent_above(often)).select("key")  # at most MOST_FREQUENT
    frequent = np.sort(last.toPandas()["key"].to_numpy(dtype=np.int64))
    sizes = {r["n"]: r["count"] for r in full.filter(F.col("n") <= 2 * MOST_SMALL).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, met / listed)

    few = cut(signed.filter(F.col("n").between(2, boundary)).select("doc_id").distinct())
    subsets = _of_ids(texts, few, "left_semi").mapInPandas(
        _enumerated(boundary), "doc_id long, n int, low int, subset binary")
    bucket = Window.partitionBy("subset")
    around = subsets.withColumn("pivot", F.min(F.struct("n", "doc_id")).over(bucket)).filter("pivot.n = low")
    small = cut(around.select(F.col("pivot.doc_id").alias("a"), F.col("doc_id").alias("b")).filter("a <> b").distinct())

    above = -(-(boundary + 1) * PART // WHOLE)
    shared = spark.sparkContext.broadcast(frequent)
    entries = texts.mapInPandas(_listed(shared, above), "doc_id long, n int, keys array<long>").select(
        "doc_id", "n", F.explode("keys").alias("key"))
    one = Window.partitionBy("key")
    # sizes within a factor of WHOLE / PART share a band or lie in neighbouring ones
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(WHOLE / PART)))
    entries = cut(entries.withColumn("members", F.count("*").over(one)).filter("members > 1").drop("members"))
    # the member that shares most of what it lists is the likeliest centre of a group
    central = entries.groupBy("doc_id").agg((F.count("*") / listing(F.first("n"))).alias("central"))
    pivot = F.max(F.struct("central", (-F.col("doc_id")).alias("minus"), "n")).over(Window.partitionBy("key", "band"))
    stars = entries.join(central, "doc_id").withColumn("band", band).withColumn("pivot", pivot)
    near = stars.filter("doc_id <> -pivot.minus").select(
        (-F.col("pivot.minus")).alias("a"), F.col("pivot.n").alias("n_a"), F.col("pivot.central").alias("central"),
        F.col("doc_id").alias("b"), F.col("n").alias("n_b"))
    near = near.groupBy("a", "n_a", "b", "n_b").agg(F.count("*").alias("count"), F.max("central").alias("central"))
    # lists of one group may have several pivots, so half of what links must share is asked for; the rest comes below
    n_a, n_b = F.col("n_a"), F.col("n_b")
    near = cut(near.filter((2 * F.col("count") >= least_shared(n_a, n_b)) & alike(n_a, n_b) & (F.greatest(n_a, n_b) > boundary)))
    edges = small
    for number in range(ROUNDS):
        if number:
            named = cut(connected_components(edges))
            of_a, of_b = (named.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}")) for c in ("a", "b"))
            apart = near.join(met, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
            near = cut(apart.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select(near.columns))
        best = near.groupBy("b", "n_b").agg(F.max(F.struct("central", "count", (-F.col("a")).alias("minus"), "n_a")).alias("p"))
        met = cut(best.select((-F.col("p.minus")).alias("a"), F.col("p.n_a").alias("n_a"), "b", "n_b"))
        edges = edges.union(verified(docs, met, boundary))

    named = connected_components(edges).select(F.col("node").alias("doc_id"), "component")
    placed = cut(entries.select("key", "doc_id", "n").join(cut(named), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")))
    open_ = still_open(placed)
    for _ in range(PASSES - 1):
        open_ = still_open(_of_ids(placed, open_.select("doc_id"), "left_semi"))
    return edges.union(between_components(docs, open_, boundary)).union(copies)


def still_open(placed: DataFrame) -> DataFrame:
    """``(doc_id, component)`` of the documents that may link with one of another component in ``placed``.

    ``placed(key, doc_id, n, component)`` has what is listed. Linked sets share ``PART / WHOLE`` of the larger one, of
    size m; what either doesn't list is less than ``UNLISTED / WHOLE`` of m. So both list more than the difference, in
    shingles that their two components hold.
    """
    one = Window.partitionBy("key")
    shared = placed.withColumn("least", F.min("component").over(one)).withColumn(
        "most", F.max("component").over(one)).filter("least < most")
    enough = WHOLE * F.count("*") > (PART - UNLISTED) * F.col("n")
    return cut(shared.groupBy("doc_id", "n", "component").agg(enough.alias("enough")).filter("enough").select(
        "doc_id", "component").distinct())


def between_components(docs: DataFrame, open_: DataFrame, boundary: int) -> DataFrame:
    """Links between documents of different components, among ``open_(doc_id, component)``.

    Only shingles that several components hold can be shared, so the order of a set begins with those of its own
    component alone, rare ones before frequent ones. A pair is met at the first shingle that both have; it links only if
    what follows there in either set suffices. Of documents that share nearly as much as needed few get so far.
    """
    sets = _of_ids(docs, open_.select("doc_id"), "left_semi").mapInPandas(_plain_sets, "doc_id long, elements array<long>")
    sets = cut(sets.join(open_, "doc_id").withColumn("row", F.monotonically_increasing_id()))
    listed = sets.select("row", "component", F.explode("elements").alias("key"))
    one = Window.partitionBy("key")
    # what only one component holds is counted, not shuffled any further
    held = listed.withColumn("held", F.count("*").over(one)).withColumn(
        "shared", F.min("component").over(one) < F.max("component").over(one)).filter("shared")
    ordered = held.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("held", "key"))).alias("keys"))
    sized = sets.select("row", "doc_id", "component", F.size("elements").alias("n"))
    n, own = F.col("n"), F.col("n") - F.size("keys")
    able = ordered.join(sized, "row").filter(F.size("keys") >= F.ceil(n * PART / WHOLE))
    shared = able.select("row", "doc_id", "component", "n", own.alias("own"), F.posexplode(
        F.slice("keys", F.lit(1), F.greatest(prefix(n) - own, F.lit(0)).cast("int"))).alias("at", "k"))
    entries = cut(shared.select("row", "doc_id", "component", "n", (n - F.col("own") - F.col("at")).alias("rest"), "k.key"))
    a, b = entries.alias("a"), entries.alias("b")
    n_a, n_b = F.col("a.n"), F.col("b.n")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.doc_id") < F.col("b.doc_id"))
                   & (F.col("a.component") != F.col("b.component")) & (F.greatest(n_a, n_b) > boundary)
                   & (F.least("a.rest", "b.rest") >= need(n_a, n_b)))
    pairs = cut(pairs.select(F.col("a.row").alias("a"), F.col("b.row").alias("b")).distinct())
    # few documents are in a pair; the sets of the others are not shuffled
    ends = cut(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct())
    ends = F.broadcast(ends) if ends.count() <= BROADCAST_IDS else ends
    return linked(pairs, sets.join(ends, "row", "left_semi").select(F.col("row").alias("node"), "doc_id", "elements"))


def least_shared(n_a: Column, n_b: Column) -> Column:
    """How many listed shingles linked sets share at least: what is not listed of either cannot make up for fewer."""
    return need(n_a, n_b) + F.least(listing(n_a) - n_a, listing(n_b) - n_b)


def alike(n_a: Column, n_b: Column) -> Column:
    """Whether sets of these sizes can link at all."""
    return need(n_a, n_b) <= F.least(n_a, n_b)


def verified(docs: DataFrame, pairs: DataFrame, boundary: int) -> DataFrame:
    """Those of ``pairs(a, n_a, b, n_b)`` that link, by exact overlap; pairs of small sets are left to the subsets."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    pairs = cut(pairs.filter(alike(n_a, n_b) & (F.greatest(n_a, n_b) > boundary)))
    ids = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    sets = cut(_of_ids(docs, ids, "left_semi").mapInPandas(_plain_sets, "doc_id long, elements array<long>"))
    return linked(pairs, sets.select(F.col("doc_id").alias("node"), "doc_id", "elements"))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b)``, as ids, of those ``pairs(a, b)`` of nodes whose ``sets(node, doc_id, elements)`` link."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("doc_id").alias("id_a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("doc_id").alias("id_b"), F.col("elements").alias("y")), "b")
    overlap = F.size(F.array_intersect("x", "y"))
    found = both.filter(overlap >= need(F.size("x"), F.size("y")))
    return cut(found.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: the smallest doc_id reachable by links, per row of ``docs``."""
    texts = docs.select("doc_id", "text")
    known = texts.filter("doc_id is not null")
    signed = cut(texts.mapInPandas(_signed, "doc_id long, n long, print binary, keys array<long>"))
    found = cut(connected_components(links(known, signed.filter("doc_id is not null"))))
    sizes = signed.select("doc_id", F.col("n").alias("n_shingles"))
    named = found.select(F.col("node").alias("_node"), "component")
    return sizes.join(named, F.col("doc_id") == F.col("_node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_row(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with its own columns; all rows without words stay, as they are in no group.

    Each row is a node of its own, so repeated rows, different texts of one id and rows without id are met like any
    others. The row with the smallest id stays (rows without id come last), of several the one with the smallest hash of
    its text. Rows are written with numbers first, so that a number keeps naming its row; they are packed beside it, so
    clashing column names do no harm.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    rows = cut(packed.withColumn("row", F.monotonically_increasing_id()))
    grouped = near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("own.text").alias("text"))).select(
        F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col("own.doc_id").isNull(), "own.doc_id", F.xxhash64("own.text"), "row")
    placed = cut(rows.select("row", order.alias("place")).join(grouped, "row"))
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = cut(placed.join(first, "component_id").filter("place.row <> first.row").select("row"))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return rows.join(gone, "row", "left_anti").select("own.*")
