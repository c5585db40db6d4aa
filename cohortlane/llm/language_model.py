"""Stupid-backoff scores from n-gram counts of the whole corpus, without any cut of the vocabulary.

Texts are dealt by hash of their id into slices of bounded size. Each slice asks for the counts of its distinct n-grams, of
order 1 up to the wanted one: one row for every hash partition of the count tables, with the n-grams of the slice that
belong there. The partition adds up what all slices hold and answers in the same order; the answers are joined to their
slice, whose words are then scored and summed per document. So an n-gram is shuffled once per slice that holds it, and one
that fills a third of the corpus is one entry per slice. A partition is a range of hashes: sorted n-grams are sent as
differences, whose leading bytes are zeros. The number of slices and of partitions grows with the text.

An n-gram of two or more words counts as known if more than one document holds it. A word's score is that of the longest
known n-gram that ends at it, ``log(count(n-gram) / count(n-gram without its last word))``, plus ``log(BACKOFF)`` for
each order backed off; a single word has ``log(count / words)``. A document starts with a mark of its own, whose count is
the number of documents with words. ``score`` is the mean over the document's words; documents without words (null or
empty text) have no score. Rows are scored by ``doc_id``: rows that repeat an id are scored as one document, each with a
start of its own, and rows without id take no part. An id whose rows hold more text than a slice is dealt by text as well,
after its equal rows were counted. An empty table gives an empty result; columns other than ``doc_id`` and ``text`` are
ignored. Words and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlane.llm.text import coded, mixed, words
from cohortlane.session import broadcast_if_small, cut

BACKOFF = 0.4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text in a slice, on average; a single text may have more.
SLICE_BYTES = 1 << 22
#: Bytes of text that a partition of the count tables stands for, for each order.
PART_BYTES = 1 << 24
#: The mark before a document's first word; no word holds a blank.
START = pd.util.hash_array(np.array([b" "], dtype=object), categorize=False)[0]
#: How a slice holds an n-gram: in one document, in several, or in one that other slices hold as well.
ONE, SEVERAL, SPLIT = 0, 1, 2

ASKED = "part int, slice long, grams binary, n binary, doc binary, held binary"
ANSWERS = "part int, slice long, counts binary"


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers, all first bytes before all second ones, so that leading zeros of small numbers are long runs."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(stored: bytes) -> np.ndarray:
    found = np.ascontiguousarray(np.frombuffer(stored, dtype=np.uint8).reshape(8, -1).T)
    return found.view(">u8").ravel().astype(np.uint64)


class _Grams:
    """The distinct n-grams of a slice, ``grams``, sorted; ``which`` leads from each n-gram of the texts to them."""

    def __init__(self, rows: pd.DataFrame, order: int):
        codes, distinct, bounds = coded([words(t) for t in rows["text"]])
        self.lengths = np.diff(bounds)
        self.text = np.repeat(np.arange(len(rows)), self.lengths)
        self.place = np.arange(len(self.text)) - np.repeat(bounds[:-1], self.lengths)
        rolled = np.zeros(0, dtype=np.uint64)
        if len(codes):
            rolled = pd.util.hash_array(distinct, categorize=False)[codes]
        single, self.at, keys = rolled, [], []
        for k in range(1, order + 1):
            if k > 1:
                before = np.concatenate([[START], rolled[:-1]])[: len(rolled)]
                before[self.place == 0] = START
                rolled = mixed(before + np.uint64(k)) + single
            # an n-gram may begin with the start, not before it
            self.at.append(np.flatnonzero(self.place >= k - 2))
            keys.append(mixed(rolled[self.at[-1]] + np.uint64(k)))
        self.grams, self.which = np.unique(np.concatenate(keys), return_inverse=True)

    def by_order(self, values: np.ndarray) -> list[np.ndarray]:
        """``values`` of the n-grams that end at each word, order by order; 0 where there is none."""
        found = [np.zeros(len(self.text), dtype=np.int64) for _ in self.at]
        ends = np.cumsum([len(at) for at in self.at])[:-1]
        for of, at, which in zip(found, self.at, np.split(self.which, ends)):
            of[at] = values[which]
        return found


def _asking(order: int, parts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = _Grams(rows, order)
        text = found.text[np.concatenate(found.at)]
        n = np.bincount(found.which, weights=rows["times"].to_numpy()[text], minlength=len(found.grams)).astype(np.uint64)
        doc = rows["doc_id"].to_numpy(dtype=np.int64)[text]
        one = np.zeros(len(n), dtype=np.int64)
        one[found.which] = doc
        several = np.bincount(found.which, weights=doc != one[found.which], minlength=len(n)) > 0
        split = np.zeros(len(n), dtype=bool)
        split[found.which] = rows["split"].to_numpy(dtype=bool)[text]
        held = np.where(several, SEVERAL, np.where(split, SPLIT, ONE)).astype(np.uint8)
        one[held != SPLIT] = 0
        part = ((found.grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(part, prepend=-1.0))
        pieces = [(part[a], found.grams[a:b], n[a:b], one[a:b], held[a:b]) for a, b in zip(starts, [*starts[1:], len(n)])]
        return pd.DataFrame(
            [(p, rows["slice"].iloc[0], planes(np.diff(g, prepend=np.uint64(0))), planes(c), planes(d), h.tobytes())
             for p, g, c, d, h in pieces], columns=["part", "slice", "grams", "n", "doc", "held"])

    return run


def _answered(asked: pd.DataFrame) -> pd.DataFrame:
    """Twice the count of each n-gram, and one more if it is known."""
    grams = [np.cumsum(from_planes(g), dtype=np.uint64) for g in asked["grams"]]
    ends = np.cumsum([len(g) for g in grams])[:-1]
    distinct, of = np.unique(np.concatenate(grams), return_inverse=True)
    n, doc = (np.concatenate([from_planes(x) for x in asked[c]]).view(np.int64) for c in ("n", "doc"))
    held = np.frombuffer(b"".join(asked["held"]), dtype=np.uint8)

    def entries(which) -> np.ndarray:
        return np.bincount(of[which], minlength=len(distinct))

    split = held == SPLIT
    one = np.zeros(len(distinct), dtype=np.int64)
    one[of[split]] = doc[split]
    of_split, differing = entries(split), entries(split & (doc != one[of]))
    alone = entries(held == ONE)
    known = (entries(held == SEVERAL) > 0) | (alone > 1) | ((alone > 0) & (of_split > 0)) | (differing > 0)
    counts = 2 * np.bincount(of, weights=n, minlength=len(distinct)).astype(np.uint64) + known.astype(np.uint64)
    return pd.DataFrame({
        "part": asked["part"], "slice": asked["slice"], "counts": [planes(x) for x in np.split(counts[of], ends)]})


def _scoring(order: int):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        found = _Grams(rows, order)
        told = np.concatenate([np.zeros(0, dtype=np.uint64), *[from_planes(x) for x in answers.sort_values("part")["counts"]]])
        counts, known = found.by_order((told >> np.uint64(1)).astype(np.int64)), found.by_order((told & np.uint64(1)).astype(np.int64))
        score = np.log(counts[0]) + (order - 1) * np.log(BACKOFF)
        # what is divided by the number of words, and by that of started documents, is counted: both are known at the end
        single, started = np.ones(len(score), dtype=bool), np.zeros(len(score), dtype=bool)
        for k in range(2, order + 1):
            before = np.concatenate([[1], counts[k - 2][:-1]])[: len(score)]
            before[found.place == 0] = 1
            better = known[k - 1] > 0
            score[better] = np.log(counts[k - 1][better] / before[better]) + (order - k) * np.log(BACKOFF)
            single[better] = False
            started |= better & (found.place == 0)
        times = rows["times"].to_numpy()
        sums = {c: times * np.bincount(found.text, weights=w, minlength=len(rows))
                for c, w in (("s", score), ("singles", single), ("starts", started))}
        return pd.DataFrame({"doc_id": rows["doc_id"], "n_words": times * found.lengths, **sums})

    return run


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(doc_id, text, times, split, slice)`` of all rows with an id, and the bytes of their texts."""
    texts = docs.filter("doc_id is not null").select("doc_id", "text")
    sizes = cut(texts.groupBy("doc_id").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"), F.count("*").alias("rows")))
    size = sizes.agg(F.sum("size")).first()[0] or 0
    slices = size // SLICE_BYTES + 1
    rows = texts.withColumn("times", F.lit(1).cast("long")).withColumn("split", F.lit(False))
    large = sizes.filter((F.col("rows") > 1) & (F.col("size") > SLICE_BYTES)).select("doc_id")
    if not large.isEmpty():
        large = broadcast_if_small(large)
        counted = texts.join(large, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("times"))
        rows = rows.join(large, "doc_id", "left_anti").union(counted.withColumn("split", F.lit(True)))
    by = F.when(F.col("split"), F.xxhash64("doc_id", "text")).otherwise(F.xxhash64("doc_id"))
    # asked for here, so that both uses are one exchange
    return rows.withColumn("slice", F.pmod(by, F.lit(slices))).repartition("slice"), size


def backoff_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """``(doc_id, n_words, score)`` of every document, from n-grams of up to ``order`` words."""
    rows, size = dealt(docs)
    asked = rows.groupBy("slice").applyInPandas(_asking(order, order * size // PART_BYTES + 1), ASKED)
    answers = asked.groupBy("part").applyInPandas(_answered, ANSWERS)
    scored = rows.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(
        _scoring(order), "doc_id long, n_words long, s double, singles double, starts double")
    sums = cut(scored.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n_words", "s", "singles", "starts")]))
    total, started = sums.agg(F.sum("n_words"), F.count_if(F.col("n_words") > 0)).first()
    s = F.col("s") - F.col("singles") * F.log(F.lit(float(total or 1))) - F.col("starts") * F.log(F.lit(float(started or 1)))
    return sums.select("doc_id", "n_words", F.when(
        F.col("n_words") > 0, F.round(s / F.col("n_words"), 6) + F.lit(0.0)).alias("score"))


#: The scores of order 2.
ORACLE = f"""
with w as (select doc_id, unnest(list_filter(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as word,
      generate_subscripts(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), 1) as i from documents),
t as (select count(*) as total, count(distinct doc_id) as started from w),
b as (select doc_id, word, lag(word, 1, ' ') over (partition by doc_id order by i) as u from w),
c as (select u, word, count(*) as all_n, min(doc_id) < max(doc_id) as known from b group by 1, 2),
n as (select word, count(*) as c from w group by 1 union all select ' ', started from t),
s as (select b.doc_id, count(*) as n_words, sum(case when known then ln(all_n / x.c) else ln({BACKOFF} * y.c / (select total from t)) end) as s
      from b join c on c.u = b.u and c.word = b.word join n x on x.word = b.u join n y on y.word = b.word group by 1)
select d.doc_id, coalesce(n_words, 0) as n_words, round(s / n_words, 6) + 0.0 as score from documents d left join s on s.doc_id = d.doc_id"""
