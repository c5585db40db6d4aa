"""Temperature mixing of sources, realised as budgeted block permutations.

Source shares of the corpus tokens are raised to an exponent and normalised. The exponent is bisected on a fixed grid:
either the largest one that reaches a target entropy, or the smallest one that keeps every source within a number of
repetitions. The weights become token budgets. A source's documents are dealt into blocks of about equal size; each
pass over the source visits its blocks, and the documents in a block, in an order drawn from a seeded hash. Whole passes
take every document; the last, partial pass takes blocks in order until its budget is used, and of the block that
crosses it documents in order. The cut is one row per source, so documents need no shuffle to learn how often they count.

The default budget is the smallest that reads every source whole at least once, so nothing is left out. Tokens are words.

A null source is a source of its own. Sources without any token take no share and are read once. Rows that repeat an id
count each, with the same order keys. An empty table gives an empty result. ``docs`` may have other columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlane.llm.text import SEPARATOR_PATTERN
from cohortlane.session import cut, running_total

#: The exponent is a multiple of 1 / GRID between 0 and 1.
GRID = 1 << 20
#: Exponents tried in one pass over the source totals.
FAN = 32
BLOCK_TOKENS = 1 << 20


def token_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATOR_PATTERN)
    return F.size(F.array_remove(parts, "")).cast("long")


def _measures(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy (nats) of the weights, and passes over the most repeated source for one over all tokens, per exponent."""
    p = F.col("tokens") / F.col("all_tokens")
    sums = []
    for i, e in enumerate(exponents):
        sums += [F.sum(F.pow(p, F.lit(e))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(e)) * F.log(p)).alias(f"s{i}")]
    row = totals.agg(F.min(p).alias("least"), F.max(p).alias("most"), *sums).first()
    found = []
    for i, e in enumerate(exponents):
        z = row[f"z{i}"]
        ratio = max(row["least"] ** (e - 1), row["most"] ** (e - 1)) / min(row["least"] ** (e - 1), row["most"] ** (e - 1))
        found.append((math.log(z) - e * row[f"s{i}"] / z, ratio))
    return found


def solve_exponent(totals: DataFrame, entropy_share: float | None = None, max_epochs: float | None = None) -> float:
    """The exponent for ``totals(tokens, all_tokens)``, by section of the grid in passes over the source totals.

    ``entropy_share``: the largest exponent whose weights have at least this share of the uniform entropy.
    ``max_epochs``: the smallest exponent at which no source is read more than so many times as often as the one read
    least. With both, the larger exponent holds: repetition is the harder limit.
    """
    n = totals.count()
    if n < 2:
        return 1.0

    def section(passes) -> float:
        low, high = 0, GRID  # ``passes`` is false at low (or low = 0) and true at high, or the other way round
        while high - low > 1:
            step = max((high - low) // FAN, 1)
            tried = list(range(low + step, high, step))
            for at, measured in zip(tried, _measures(totals, [t / GRID for t in tried])):
                if passes(measured):
                    high = at
                    break
                low = at
        return high / GRID

    wanted = []
    if entropy_share is not None:
        goal = entropy_share * math.log(n)
        if _measures(totals, [1.0])[0][0] >= goal:
            wanted.append(1.0)
        else:
            wanted.append(section(lambda m: m[0] < goal) - 1 / GRID)
    if max_epochs is not None:
        enough = _measures(totals, [0.0])[0][1] <= max_epochs
        wanted.append(0.0 if enough else section(lambda m: m[1] <= max_epochs))
    return max(wanted) if wanted else 1.0


def mixture(
    docs: DataFrame, entropy_share: float | None = 0.98, max_epochs: float | None = 2.0,
    budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 42,
) -> DataFrame:
    """The plan per source: tokens, weight, epochs (whole passes) and the cut of the partial pass.

    Columns ``source, tokens, blocks, weight, epochs, cut_block, cut_key, cut_doc``; see ``copies``.
    """
    sized = docs.select("source", _name(), token_count(F.col("text")).alias("n"))
    totals = cut(sized.groupBy("source").agg(F.sum("n").alias("tokens")))
    some = totals.filter("tokens > 0")
    all_tokens = some.agg(F.sum("tokens")).first()[0] or 0
    some = some.withColumn("all_tokens", F.lit(all_tokens))
    exponent = solve_exponent(some, entropy_share, max_epochs)
    raised = F.pow(F.col("tokens") / F.col("all_tokens"), F.lit(exponent))
    z = some.agg(F.sum(raised)).first()[0] or 1.0
    weighted = some.withColumn("weight", raised / z)
    if budget is None:
        budget = weighted.agg(F.max(F.ceil(F.col("tokens") / F.col("weight")))).first()[0] or 0
    quota = F.round(F.col("weight") * budget).cast("long")
    plan = totals.join(
        weighted.select(F.col("source").alias("_s"), "weight"), F.col("source").eqNullSafe(F.col("_s")), "left",
    ).select(
        "source", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).alias("blocks"),
        F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens"))).otherwise(1).cast("long").alias("epochs"),
        F.when(F.col("tokens") > 0, quota % F.col("tokens")).otherwise(0).alias("rest"),
    )
    plan = cut(plan)
    part = plan.filter("rest > 0").select(F.col("source").alias("_s"), "blocks", "epochs", "rest")
    keyed = sized.join(part, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("_s").alias("source"), "n", "epochs", "rest", *_order(seed, F.col("epochs"), F.col("blocks")), "doc_id")
    blocks = keyed.groupBy("source", "rest", "cut_key", "cut_block").agg(F.sum("n").alias("n"))
    upto = running_total(blocks, ["source"], [F.col("cut_key"), F.col("cut_block")], "n", "upto")
    crossing = cut(upto.filter("upto >= rest and upto - n < rest").groupBy("source").agg(
        F.min(F.struct("cut_key", "cut_block", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("c")
    ).select(F.col("source").alias("_c"), "c.*"))
    inside = keyed.alias("k").join(
        crossing.alias("c"), F.col("k.source").eqNullSafe(F.col("_c"))
        & (F.col("k.cut_key") == F.col("c.cut_key")) & (F.col("k.cut_block") == F.col("c.cut_block")),
    ).select("k.source", "k.doc_key", "k.n", "left")
    running = Window.partitionBy("source").orderBy("doc_key")  # one block of a source
    taken = inside.withColumn("upto", F.sum("n").over(running)).filter("upto <= left")
    last = taken.groupBy(F.col("source").alias("_t")).agg(F.max("doc_key").alias("cut_doc"))
    return cut(plan.join(crossing, F.col("source").eqNullSafe(F.col("_c")), "left").join(
        last, F.col("source").eqNullSafe(F.col("_t")), "left",
    ).select("source", "tokens", "blocks", "weight", "epochs", "cut_key", "cut_block", "cut_doc"))


def _name() -> Column:
    """What a document's place is made of: its id or, where it has none, its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("doc_id")


def _order(seed: int, epoch: Column, blocks: Column) -> list[Column]:
    """The place of a document in a pass: the block's key and number, then the document's key."""
    block = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), blocks)
    return [
        F.xxhash64(F.lit(seed), epoch, "source", block).alias("cut_key"), block.alias("cut_block"),
        F.xxhash64(F.lit(seed), epoch, "doc_id", F.lit("doc")).alias("doc_key"),
    ]


def draws(docs: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """Every drawing of a document: ``doc`` (its row), ``epoch``, ``block``, ``block_key`` and ``doc_key``.

    Reading a source in the order ``epoch, block_key, block, doc_key`` is its permutation.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("doc"), "source", _name())
    rules = plan.select(
        F.col("source").alias("_s"), "blocks", "epochs", F.col("cut_key").alias("_k"), F.col("cut_block").alias("_b"),
        F.col("cut_doc").alias("_d"))
    joined = packed.join(rules, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"))))
    keyed = joined.select("*", *_order(seed, F.col("epoch"), F.col("blocks")))
    place, bound = F.struct("cut_key", "cut_block"), F.struct(F.col("_k"), F.col("_b"))
    partial = (place < bound) | ((place == bound) & (F.col("doc_key") <= F.col("_d")))
    drawn = (F.col("epoch") < F.col("epochs")) | F.coalesce(F.col("_k").isNotNull() & partial, F.lit(False))
    return keyed.filter(drawn).select(
        "doc", "epoch", F.col("cut_block").alias("block"), F.col("cut_key").alias("block_key"), "doc_key")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as they are drawn, with their own columns."""
    return draws(docs, mixture(docs, **options), options.get("seed", 42)).select("doc.*")
