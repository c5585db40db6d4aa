"""Spelling variants: words that differ by one letter, found by k-d trees over letter-count vectors.

One inserted or deleted letter changes one letter count by one; one replaced letter takes one from a count and adds one
to another. So near words of equal length lie within an L1 distance of two, one up and one down, and near words whose
lengths differ by one lie within one up. Words are grouped by length, and a pair is met where the longer word (of equal
ones the later) lives.

* A k-d tree per length, fitted on a bounded sample of the words, parts the space of counts into boxes of about
  ``CELL_WORDS`` words. Every word lives in one box and is sent to all boxes of its own and the next length that it can
  reach, so boxes are searched apart. Boxes that stay too full, as those of a hot length beyond the sample's depth, are
  dealt into several groups by hash, and those who search the box go to all of them.
* In a group a second k-d tree is built to leaves of ``LEAF_WORDS`` words. Those who reach a leaf are compared with its
  words by bits (which letters stand there once, and twice), and the letter order of what is left is checked.

The sample only shapes the boxes: all words are indexed, all pairs are found. Letters from U+00C0 to U+00FF
share a count with their other case, all others share six, which can only bring words nearer.

Only distinct words and their counts are shuffled after the first aggregate, which combines before its shuffle. The
number of near words and the best of them are aggregates too, so a word with very many near words does no harm. Forms
have at least ten times the count of their word, so their chains are short and roots need a few joins.
Null and empty texts have no words. Rows that repeat an id count each; without an id the run is hashed with an empty id.
A text of any length, or a word of any length, is worked on whole; words of one kind only are no special case. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlane.session import cut

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_TIMES = 7, 2
#: How many times the count of a word its form has at least.
FORM_TIMES = 10
#: Words of a box, and the most boxes; words that the trees over all lengths are fitted on.
CELL_WORDS, MOST_CELLS, SAMPLE = 32768, 4096, 1 << 17
#: Words of a leaf inside a group, words that search it together, and pairs that are compared at once.
LEAF_WORDS, TOGETHER, PAIRS = 128, 1 << 15, 1 << 20
#: a to z, U+00C0 to U+00FF folded by case, and all others folded.
COUNTS = 26 + 32 + 6
PAIR_ROWS = "word string, other string, other_n long"
BEST_ROWS = "word string, n_near long, minus long, form string"


def spelled(texts: DataFrame) -> DataFrame:
    """``(word, n)``: the words of the contract. One run in 31, by its hash, loses a letter, as a scribe might drop it."""
    runs = F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"({RUN})"), F.lit(1)))
    listed = texts.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    # a run can only get shorter
    low = listed.filter(F.length("run") >= LEAST_LETTERS).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, dropped).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_TIMES)


def letters_of(words: list[str]) -> list[np.ndarray]:
    """The code points of each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.split(flat, np.cumsum([len(w) for w in words])[:-1]) if words else []


def counts_of(words: list[str]) -> np.ndarray:
    """Letter counts, one row a word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    column = np.where((flat >= 97) & (flat <= 122), flat - 97,
                      np.where((flat >= 0xC0) & (flat <= 0xFF), 26 + flat % 32, 58 + flat % 6))
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counted = np.bincount(row * COUNTS + column, minlength=len(words) * COUNTS)
    return counted.reshape(len(words), COUNTS).astype(np.int32)


@dataclass
class Node:
    """A box of counts, parted at a value of one count; a leaf has a number, and the rows that it was built over."""

    rows: np.ndarray
    number: int = -1
    column: int = -1
    at: int = 0
    children: tuple = ()


def split(counts: np.ndarray) -> tuple[int, int] | None:
    """The count and value that part the rows most evenly; None if all are equal."""
    middle = np.median(counts, axis=0).astype(np.int64)
    best = None
    for shift in (0, -1):
        share = (counts <= middle + shift).mean(axis=0)
        share = np.where((share > 0) & (share < 1), np.abs(share - 0.5), 1.0)
        column = int(share.argmin())
        if share[column] < 1 and (best is None or share[column] < best[0]):
            best = (share[column], column, int(middle[column]) + shift)
    return best and best[1:]


def tree_of(counts: np.ndarray, depth: int = 1 << 30, leaf_rows: int = LEAF_WORDS) -> Node:
    """A k-d tree over the rows of ``counts``, at most ``depth`` levels of planes deep; its planes part all of the space."""
    numbers = iter(range(1 << 30))

    def grow(rows: np.ndarray, left: int) -> Node:
        plane = split(counts[rows]) if left and len(rows) > leaf_rows else None
        if plane is None:
            return Node(rows, next(numbers))
        under = counts[rows, plane[0]] <= plane[1]
        return Node(rows, -1, *plane, (grow(rows[under], left - 1), grow(rows[~under], left - 1)))

    return grow(np.arange(len(counts)), depth)


def reached(tree: Node, counts: np.ndarray, up: int, down: int):
    """``(leaf, rows of counts that may have a near word in it)``.

    Boxes are left out that need more than ``up`` added or ``down`` taken letters, each at most one. A letter once
    added to reach a side of one plane also serves the other planes of its count.
    """
    none = np.full(len(counts), -1, dtype=np.int16)
    stack = [(tree, np.arange(len(counts)), none, none)]
    while stack:
        node, who, added, taken = stack.pop()
        if not len(who):
            continue
        if not node.children:
            yield node, who
            continue
        own = counts[who, node.column]
        free = ((added < 0) | (added == node.column)) if up else False
        over = own <= node.at
        right = ~over | ((own == node.at) & free)
        stack.append((node.children[1], who[right], np.where(over, node.column, added)[right].astype(np.int16), taken[right]))
        free = ((taken < 0) | (taken == node.column)) if down else False
        left = over | ((own == node.at + 1) & free)
        stack.append((node.children[0], who[left], added[left], np.where(over, taken, node.column)[left].astype(np.int16)))


def home(tree: Node, counts: np.ndarray) -> np.ndarray:
    """The number of the leaf in which each row lives."""
    found = np.zeros(len(counts), dtype=np.int32)
    for leaf, who in reached(tree, counts, 0, 0):
        found[who] = leaf.number
    return found


def masks(counts: np.ndarray) -> np.ndarray:
    """Two sets of bits a row: the counts of at least one, and of at least two."""
    bits = np.stack([counts >= 1, counts >= 2], axis=1)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def one_letter_apart(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Which rows of letters become each other by one replaced, or one more, letter."""
    n = shorter.shape[1]
    if longer.shape[1] == n:
        return (shorter != longer).sum(axis=1) == 1
    head = np.logical_and.accumulate(shorter == longer[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def near_pairs(asking: list[str], living: list[str]):
    """``(places in asking, places in living)`` of near words; all asking words have one length, all living words one.

    Of two words of one length only the earlier asks for the later.
    """
    first, second = np.stack(letters_of(asking)), np.stack(letters_of(living))
    equal = first.shape[1] == second.shape[1]
    up, down = 1, 1 if equal else 0
    asked, counts = counts_of(asking), counts_of(living)
    tree, bits, own_bits = tree_of(counts), masks(counts), masks(asked)
    for at in range(0, len(asking), TOGETHER):
        for leaf, who in reached(tree, asked[at : at + TOGETHER], up, down):
            who = who + at
            for rows in np.split(leaf.rows, range(PAIRS, len(leaf.rows), PAIRS)):
                step = max(PAIRS // len(rows), 1)
                for some in np.split(who, range(step, len(who), step)):
                    a, b = close(own_bits[some], bits[rows], up, down)
                    a, b = some[a], rows[b]
                    good = one_letter_apart(first[a], second[b])
                    a, b = a[good], b[good]
                    if equal and len(a):
                        once = np.array([asking[i] < living[j] for i, j in zip(a.tolist(), b.tolist())])
                        a, b = a[once], b[once]
                    if len(a):
                        yield a, b


def close(own: np.ndarray, bits: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose counts, up to two of a letter, need at most ``up`` added and ``down`` taken letters."""
    more = np.bitwise_count(bits[None, :, 0] & ~own[:, None, 0])
    more += np.bitwise_count(bits[None, :, 1] & ~own[:, None, 1])
    a, b = np.nonzero(more <= up)
    less = np.bitwise_count(own[a, 0] & ~bits[b, 0]) + np.bitwise_count(own[a, 1] & ~bits[b, 1])
    good = less <= down
    return a[good], b[good]


def pairs_of(group: pd.DataFrame):
    """``(words, counts, place of a word, place of the other)`` of all near pairs met in one group, in both directions."""
    lives = group["lives"].to_numpy()
    words, times = group["word"].to_numpy(), group["n"].to_numpy()
    living = np.flatnonzero(lives)
    places = []
    if len(living):
        asks = np.flatnonzero(~lives)
        sizes = group["word"].str.len().to_numpy()[asks]
        for size in np.unique(sizes):
            mine = asks[sizes == size]
            for a, b in near_pairs(words[mine].tolist(), words[living].tolist()):
                places.append((mine[a], living[b]))
    a, b = (np.concatenate([p[i] for p in places]) if places else np.zeros(0, dtype=np.int64) for i in (0, 1))
    return words, times, np.concatenate([a, b]), np.concatenate([b, a])


def pair_rows(group: pd.DataFrame) -> pd.DataFrame:
    words, times, a, b = pairs_of(group)
    return pd.DataFrame({"word": words[a], "other": words[b], "other_n": times[b]})


def best_rows(group: pd.DataFrame) -> pd.DataFrame:
    """Per word of a group: how many near words it met, and the best of them."""
    words, times, a, b = pairs_of(group)
    distinct, code = np.unique(words.astype(str), return_inverse=True)  # codes have the order of code points
    order = np.lexsort((code[b], -times[b], code[a]))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(code[a], prepend=-1))
    n = np.diff(np.append(first, len(a)))
    return pd.DataFrame({"word": words[a[first]], "n_near": n, "minus": -times[b[first]], "form": words[b[first]]})


def fitted_trees(words: DataFrame, sizes: dict[int, int]) -> dict[int, Node]:
    """A tree for every length with more words than a box takes; all other lengths are one box."""
    crowded = [size for size, n in sizes.items() if n > CELL_WORDS]
    if not crowded:
        return {}
    total = sum(sizes[size] for size in crowded)
    picked = words.filter(F.length("word").isin(crowded)).orderBy(F.xxhash64("word")).limit(SAMPLE)
    sample = [r["word"] for r in picked.select("word").collect()]
    trees = {}
    for size in crowded:
        boxes = min(-(-sizes[size] // CELL_WORDS), max(MOST_CELLS * sizes[size] // total, 1))
        trees[size] = tree_of(counts_of([w for w in sample if len(w) == size]), int(np.ceil(np.log2(boxes))), 1)
    return trees


def by_length(batches):
    for batch in batches:
        size = batch["word"].str.len().to_numpy()
        for length in np.unique(size):
            part = batch.iloc[np.flatnonzero(size == length)]
            yield int(length), part, counts_of(part["word"].tolist())


def dealt(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``(size, box, salt, word, n, lives)``: every word where it lives, and wherever it asks for near words."""
    trees = fitted_trees(words, sizes)

    def homes(batches):
        for length, part, counts in by_length(batches):
            if length in trees:
                yield pd.DataFrame({"size": length, "box": home(trees[length], counts)})

    # no more rows than boxes; a box that stays too full is dealt into several groups
    filled = words.mapInPandas(homes, "size int, box int").groupBy("size", "box").count() if trees else None
    groups = {(r["size"], r["box"]): -(-r["count"] // (2 * CELL_WORDS)) for r in filled.collect()} if trees else {}

    def placed(batches):
        for length, part, counts in by_length(batches):
            def at(size: int, box, who: np.ndarray, salt, lives: bool) -> pd.DataFrame:
                chosen = part.iloc[who]
                return pd.DataFrame({"size": size, "box": box, "salt": salt, "word": chosen["word"], "n": chosen["n"], "lives": lives})

            everyone = np.arange(len(part))
            tree = trees.get(length)
            own = home(tree, counts) if tree else np.zeros(len(part), dtype=np.int32)
            most = np.array([groups.get((length, b), 1) for b in own.tolist()])
            yield at(length, own, everyone, part["hash"].to_numpy() % most, True)
            for other, up, down in ((length, 1, 1), (length + 1, 1, 0)):
                if other in trees:
                    for leaf, who in reached(trees[other], counts, up, down):
                        for salt in range(groups.get((other, leaf.number), 0)):  # no group, no word lives there
                            yield at(other, leaf.number, who, salt, False)
                elif other in sizes:
                    yield at(other, 0, everyone, 0, False)

    hashed = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("hash"))
    return hashed.mapInPandas(placed, "size int, box int, salt int, word string, n long, lives boolean")


def _groups(words: DataFrame):
    sizes = {r["size"]: r["count"] for r in words.groupBy(F.length("word").alias("size")).count().collect()}
    return dealt(words, sizes).groupBy("size", "box", "salt")


def near_words(words: DataFrame) -> DataFrame:
    """``(word, other, other_n)``: every word of ``words(word, n)`` with each of its near words."""
    return _groups(cut(words)).applyInPandas(pair_rows, PAIR_ROWS)


def roots_of(forms: DataFrame, longest: int) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: steps double, so chains of ``longest`` forms need few joins."""
    roots = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < longest:
        roots = cut(roots)
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("last"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root"))
        reach *= 2
    return roots


def variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``words(word, n)``; words are distinct."""
    words = cut(words)
    # a group sends one row a word, not one a pair
    met = _groups(words).applyInPandas(best_rows, BEST_ROWS)
    judged = met.join(words, "word").groupBy("word", "n").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "form")).alias("best"))
    best = F.when(-F.col("best.minus") >= FORM_TIMES * F.col("n"), F.col("best"))
    judged = cut(judged.select("word", "n_near", best["form"].alias("form"), (-best["minus"]).alias("form_n")))
    most = words.agg(F.max("n")).first()[0] or 1
    forms = judged.filter("form is not null").select("word", "form")
    roots = roots_of(forms, len(str(most)))  # each form has ten times the count of the one before
    return words.join(judged, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
