"""SentencePiece encoding and decoding.

A text is parted into words (a run of blanks with what follows it; no piece crosses the border of two). The distinct
words are exploded into their substrings of at most the longest piece, joined to the table of pieces, and kept as a
lattice, which says for begin and end of a substring the priority of its piece. A fold turns the lattice of a word into
borders. The model at hand is a byte-pair model. A fold for the best sum of scores (Viterbi) would give other pieces
than its own encoder, so the fold applies merges: each step joins the two neighbours whose union is the piece of best
priority, leftmost first, until none is left.

* ``fold_words`` does this for a table of words with Spark's own operators: explode, an equi-join, a grouping by word,
  and a higher-order ``aggregate``.
* ``encode`` does it for the words of a batch of texts inside a task, with arrays over all words at once, and shuffles
  nothing: a shuffle of word occurrences would take more disk than the texts themselves (see README). Words of more than
  ``MOST_LATTICE`` characters, whose fold takes as many steps, are merged from a heap in ``n log n``.

Substrings are joined by 64-bit hashes. Characters outside the table become byte pieces.

A null or empty text has no pieces. Rows that repeat an id each get their row, rows without id too; an empty table gives
an empty result. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq
import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortlane.llm.text import coded, mixed, sliced

BLANK = "▁"
#: Longer words are merged from a heap.
MOST_LATTICE = 64
#: Characters of words whose lattices are held at a time.
TOGETHER = 1 << 18
#: Substrings are first looked up by so many bits of their hash.
SEEN_BITS = 22
NONE = np.int32((1 << 31) - 1)
WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


@cache
def model(path: str):
    """``(priorities, ids, pieces, first byte piece)``: mergeable pieces by rank of score, and all pieces by id."""
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(read.get_piece_size())
    plain = [i for i in every if not (read.is_control(i) or read.is_unknown(i) or read.is_byte(i))]
    names = {i: read.id_to_piece(i) for i in every}
    ranked = sorted(plain, key=lambda i: (-read.get_score(i), i))
    priorities = {names[i]: rank for rank, i in enumerate(ranked)}
    bytes_ = {int(names[i][3:5], 16): i for i in every if read.is_byte(i)}
    return priorities, {names[i]: i for i in plain}, names, bytes_


def piece_table(spark, path: str) -> DataFrame:
    """``(piece, priority)`` of the pieces of two and more characters; its size is the vocabulary's."""
    rows = [(p, r) for p, r in model(path)[0].items() if len(p) > 1]
    return spark.createDataFrame(rows, "piece string, priority int")


def marked(text: Column) -> Column:
    """The text as the model sees it: blanks marked, and one more in front."""
    return F.when(text != "", F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK))))


def fold_merges(n: Column, lattice: Column) -> Column:
    """Borders of the pieces of a word of n characters; ``lattice`` maps ``begin << 32 | end`` to a priority."""
    worst = F.lit(1 << 30)

    def priority(begin: Column, end: Column) -> Column:
        return F.coalesce(F.try_element_at(lattice, F.shiftleft(begin.cast("long"), 32) + end), worst)

    start = F.struct(
        F.sequence(F.lit(0), n).alias("borders"),
        F.transform(F.sequence(F.lit(0), n - 2), lambda i: priority(i, i + 2)).alias("merges"))

    def step(state: Column, _: Column) -> Column:
        borders, merges = state["borders"], state["merges"]
        best = F.array_min(merges)
        at = F.array_position(merges, best).cast("int")  # from 1: joins what lies between borders at and at + 2
        left = F.when(at > 1, F.array(priority(F.get(borders, at - 2), F.get(borders, at + 1)))).otherwise(
            F.array().cast("array<int>"))
        right = F.when(at < F.size(merges), F.array(priority(F.get(borders, at - 1), F.get(borders, at + 2)))).otherwise(
            F.array().cast("array<int>"))
        joined = F.struct(
            F.concat(F.slice(borders, F.lit(1), at), F.slice(borders, at + 2, F.size(borders))).alias("borders"),
            F.concat(F.slice(merges, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right,
                     F.slice(merges, at + 2, F.size(merges))).alias("merges"))
        return F.when((F.size(merges) > 0) & (best < worst), joined).otherwise(state)

    return F.aggregate(F.sequence(F.lit(2), n), start, step, lambda state: state["borders"])


def merged(word: str, priorities: dict[str, int]) -> list[str]:
    """The pieces of a word: the same merges as those of ``fold_merges``, taken from a heap."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end, alive, heap = list(range(1, n + 1)), [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            found = priorities.get(word[i : end[j]])
            if found is not None:
                heapq.heappush(heap, (found, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, middle, last = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j < n and end[i] == middle and end[j] == last:
            alive[j], end[i], after[i] = False, last, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
    return [word[i : end[i]] for i in range(n) if alive[i]]


def fold_words(words: DataFrame, path: str) -> DataFrame:
    """``(word, borders)`` of the distinct words of at least two characters, blanks marked, that hold a piece."""
    longest = max(len(p) for p in model(path)[0])
    n = F.length("word")
    words = words.select("word").filter(n >= 2).distinct()
    begins = words.select("word", n.alias("n"), F.explode(F.sequence(F.lit(1), n - 1)).alias("begin"))
    substrings = begins.select("word", "n", "begin", F.explode(
        F.sequence(F.lit(2), F.least(F.lit(longest), F.col("n") - F.col("begin") + 1))).alias("size"))
    edges = substrings.select(
        "word", "n", (F.shiftleft((F.col("begin") - 1).cast("long"), 32) + F.col("begin") - 1 + F.col("size")).alias("place"),
        F.expr("substring(word, begin, size)").alias("piece"),
    ).join(F.broadcast(piece_table(words.sparkSession, path)), "piece")
    lattice = edges.groupBy("word", "n").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "priority"))).alias("lattice"))
    return lattice.select("word", fold_merges(F.col("n"), F.col("lattice")).alias("borders"))


@cache
def lattice_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Ascending hashes of the pieces, which first bits they have, their priorities and ids, and the longest length."""
    priorities, ids, _, _ = model(path)
    pieces = list(priorities)
    letters = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    hashes = np.zeros(len(pieces), dtype=np.uint64)
    for i in range(sizes.max()):
        inside = sizes > i
        hashes[inside] = hashed(hashes[inside], letters[starts[inside] + i])
    order = np.argsort(hashes)
    seen = np.zeros(1 << SEEN_BITS, dtype=bool)
    seen[hashes >> np.uint64(64 - SEEN_BITS)] = True
    known = np.array([priorities[p] for p in pieces], dtype=np.int32), np.array([ids[p] for p in pieces], dtype=np.int32)
    return hashes[order], seen, known[0][order], known[1][order], int(sizes.max())


def hashed(hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of substrings, each with one more letter."""
    return mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + letters + np.uint64(1))


def lattice(letters: np.ndarray, ends: np.ndarray, path: str) -> np.ndarray:
    """``(size, begin)`` to the row of the piece in the table, -1 where the substring is none.

    ``ends`` says for each letter where its word ends.
    """
    table, seen, _, _, longest = lattice_table(path)
    found = np.full((longest + 1, len(letters)), -1, dtype=np.int32)
    begins, hashes = np.arange(len(letters)), np.zeros(len(letters), dtype=np.uint64)
    for size in range(1, longest + 1):
        inside = begins + size <= ends[begins]
        begins, hashes = begins[inside], hashed(hashes[inside], letters[begins[inside] + size - 1])
        maybe = np.flatnonzero(seen[hashes >> np.uint64(64 - SEEN_BITS)])
        row = np.minimum(np.searchsorted(table, hashes[maybe]), len(table) - 1)
        match = table[row] == hashes[maybe]
        found[size, begins[maybe[match]]] = row[match]
    return found


def folded(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces of all words, end to end, and how many each word has."""
    _, _, priorities, piece_ids, longest = lattice_table(path)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    word_ends = np.cumsum(sizes)
    rows = lattice(letters, np.repeat(word_ends, sizes), path)

    def priority(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - begin
        row = rows[np.minimum(size, longest), begin]
        return np.where((size <= longest) & (row >= 0), priorities[row], NONE)

    # one row for each piece so far of the words that may still merge; the last piece of a word joins nothing
    alive = np.ones(len(letters), dtype=bool)  # letters that begin a piece
    begin, end, word = np.arange(len(letters)), np.arange(1, len(letters) + 1), np.repeat(np.arange(len(words)), sizes)
    after = np.append(end[1:], len(letters))
    merge = np.where(end < word_ends[word], priority(begin, after), NONE)
    while len(begin):
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        count = np.diff(np.append(starts, len(word)))
        best = np.minimum.reduceat(merge, starts)
        going = np.repeat(best < NONE, count)
        begin, end, word, merge = begin[going], end[going], word[going], merge[going]
        best, count = best[best < NONE], count[best < NONE]
        if not len(begin):
            break
        starts = np.cumsum(count) - count
        at = np.flatnonzero(merge == np.repeat(best, count))
        at = at[np.diff(word[at], prepend=-1) > 0]  # the leftmost of each word
        alive[begin[at + 1]] = False
        end[at] = end[at + 1]
        left = np.ones(len(begin), dtype=bool)
        left[at + 1] = False
        at = at - np.arange(len(at))  # one row before it has gone for each word before
        begin, end, word, merge = begin[left], end[left], word[left], merge[left]
        starts = starts - np.arange(len(starts))
        for changed in (at, at[at > starts] - 1):
            last = end[changed] == word_ends[word[changed]]
            follows = np.where(last, 0, end[np.minimum(changed + 1, len(end) - 1)])
            merge[changed] = np.where(last, NONE, priority(begin[changed], np.maximum(follows, begin[changed] + 1)))
    begins = np.flatnonzero(alive)
    stops = np.append(begins[1:], len(letters))
    row = rows[stops - begins, begins]
    counts = np.bincount(np.repeat(np.arange(len(words)), sizes)[begins], minlength=len(words))
    found = np.where(row >= 0, piece_ids[row], -1)
    if (row < 0).any():  # letters that are no piece: one byte piece for each of their bytes
        bytes_ = model(path)[3]
        unknown = np.flatnonzero(row < 0)
        spelled = [[bytes_[b] for b in chr(int(letters[begins[i]])).encode()] for i in unknown]
        extra = np.array([len(x) for x in spelled])
        owner = np.repeat(np.arange(len(words)), sizes)[begins[unknown]]
        counts = counts + np.bincount(owner, weights=extra - 1, minlength=len(words)).astype(np.int64)
        times = np.ones(len(found), dtype=np.int64)
        times[unknown] = extra
        found = np.repeat(found, times)
        found[found < 0] = [i for x in spelled for i in x]
    return found.astype(np.int32), counts


def heaped(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The same for long words, one after another."""
    priorities, ids, _, bytes_ = model(path)
    found = [[i for p in merged(w, priorities) for i in ([ids[p]] if p in ids else [bytes_[b] for b in p.encode()])] for w in words]
    return np.array([i for x in found for i in x], dtype=np.int32), np.array([len(x) for x in found], dtype=np.int64)


def ids_of(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the pieces of distinct words, end to end; where each word's begin, and how many it has."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    short = np.flatnonzero(sizes <= MOST_LATTICE)
    parts = np.split(short, np.flatnonzero(np.diff(np.cumsum(sizes[short]) // TOGETHER)) + 1)
    parts = [(folded, p) for p in parts if len(p)] + [(heaped, p) for p in [np.flatnonzero(sizes > MOST_LATTICE)] if len(p)]
    starts, counts, flat, at = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), [], 0
    for encoder, part in parts:
        ids, counted = encoder([words[i] for i in part], path)
        counts[part], starts[part] = counted, at + np.cumsum(counted) - counted
        at += len(ids)
        flat.append(ids)
    return np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32), starts, counts


def _encoded(path: str):
    def run(batches):
        for batch in sliced(batches, 1000):
            codes, distinct, bounds = coded([WORD.findall(text) if text else [] for text in batch["marked"]])
            flat, starts, counts = ids_of(list(distinct), path)
            each = counts[codes]
            ends = np.cumsum(each)
            ids = flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each - starts[codes], each)]
            encoded = np.split(ids, np.concatenate([[0], ends])[bounds[1:-1]]) if len(batch) else []
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": encoded})

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_pieces, ids)`` per row, as the model's own encoder gives them."""
    texts = docs.select("doc_id", marked(F.col("text")).alias("marked"))
    encoded = texts.mapInPandas(_encoded(path), "doc_id long, ids array<int>")
    return encoded.select("doc_id", F.size("ids").cast(T.LongType()).alias("n_pieces"), "ids")


def _text_of(path: str):
    def run(batches):
        _, _, names, bytes_ = model(path)
        raw = {i: bytes([b]) for b, i in bytes_.items()}
        table = {i: raw.get(i, names[i].replace(BLANK, " ").encode()) for i in names}
        for batch in batches:
            texts = [b"".join([table[i] for i in ids]).decode("utf-8", "replace") for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": [t[1:] if t[:1] == " " else t for t in texts]})

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; marked blanks come back as blanks."""
    return encoded.select("doc_id", "ids").mapInPandas(_text_of(path), "doc_id long, text string")
