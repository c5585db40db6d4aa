"""Removal of byte strings of a given length that occur twice, by prefix-free parsing.

Every text is parsed by content: a rolling hash of ``PHRASE`` bytes triggers where it is the least within ``REACH``
consecutive positions, and a phrase starts at each trigger. A string of ``LENGTH`` bytes has exactly ``REACH`` places for
a phrase, so wherever a string lies, the phrase at the least of them is found at the same place in it. Hence:

1. Dictionary: phrases are counted over the corpus. Only occurrences of phrases that occur twice go on.
2. Parse: each occurrence carries a fingerprint of its phrase with the ``LENGTH - PHRASE`` bytes before and after. Where
   two agree, every string around the phrase repeats. This settles the inside of repeats, copies of whole texts included.
3. Borders: occurrences that agree with no other, though their phrase repeats, are compared with one occurrence of every
   other fingerprint of the phrase. The strings around the phrase are suffixes of what stands before it joined to
   prefixes of what stands behind; for each of the possible places of the phrase they are ordered by fingerprint, and
   equal neighbours in that order repeat. As all of them hold the phrase, first and last one found bound the bytes.

The full suffix order of the corpus is thus never written out: it is taken to the depth of ``LENGTH`` bytes, by
fingerprints instead of bytes, and only where dictionary and parse leave it open. Counts combine before they are
shuffled. A phrase with more than ``MOST_CONTEXTS`` different surroundings is resolved by counting fingerprints in
Spark instead of inside one task, with the same result.

Null texts are empty. Matches never cross rows. Rows that repeat an id are texts of their own (equal rows get equal
results); an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlane.llm.text import mixed
from cohortlane.session import cut

LENGTH = 200
PHRASE = 100
#: Bytes of a string beside its phrase.
AROUND = LENGTH - PHRASE
#: A phrase starts within any so many consecutive positions.
REACH = AROUND + 1
STEPS = [1, 2, 4, 8, 16, 32, 64, 128]
#: Odd multipliers.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
MOST_CONTEXTS = 20_000
#: Ids are broadcast up to so many rows (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1 << 20
#: Batches of whole phrases are compared together up to so many rows.
TOGETHER = 4096


def fingerprints(content: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each string of ``length`` bytes, by doubling."""
    if len(content) < length:
        return np.zeros(0, dtype=np.uint64)
    level = mixed(content.astype(np.uint64) + ODD[0])
    whole, done = None, 0
    for step in STEPS:
        if length & step:
            part = level[done : done + len(content) - length + 1]
            whole = part if whole is None else mixed(whole * ODD[0] + part)
            done += step
        if step * 2 > length:
            break
        level = mixed(level[:-step] * ODD[0] + level[step:])
    return whole


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` consecutive values."""
    step = 1
    while step * 2 <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def phrase_starts(hashes: np.ndarray) -> np.ndarray:
    """Positions that are the least of some ``REACH`` consecutive ones; all of them, if several are equal."""
    least = sliding(hashes, REACH, np.minimum)
    edge = np.zeros(REACH - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.concatenate([edge, least, edge]), REACH, np.maximum) == hashes)


def parse(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase starts, phrase hashes, and hashes of phrases with their surroundings (signed)."""
    data = np.frombuffer(content, dtype=np.uint8)
    if len(data) < LENGTH:
        return (np.zeros(0, dtype=np.int64),) * 3
    hashes = fingerprints(data, PHRASE)
    starts = phrase_starts(hashes)
    before, behind = starts - AROUND, starts + PHRASE
    left = hashes[np.maximum(before, 0)]  # AROUND equals PHRASE, so surroundings have hashes already
    right = hashes[np.minimum(behind, len(hashes) - 1)]
    for i in np.flatnonzero(before < 0):  # cut off by the ends of the text: hashed with their length
        left[i] = _short(content[: starts[i]])
    for i in np.flatnonzero(behind > len(hashes) - 1):
        right[i] = _short(content[behind[i] :])
    around = mixed(mixed(left * ODD[0] + hashes[starts]) * ODD[1] + right)
    return starts, hashes[starts].view(np.int64), around.view(np.int64)


def _short(part: bytes) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(part, digest_size=8).digest(), dtype=np.uint64)[0]


def runs(n: int, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the bytes of a text of n bytes that intervals cover; adjoining ones are one."""
    order = np.argsort(lows, kind="stable")
    lows, highs = np.maximum(lows[order], 0), np.maximum.accumulate(np.minimum(highs[order], n))
    fresh = np.concatenate([[True], lows[1:] > highs[:-1]])
    return lows[fresh], highs[np.concatenate([fresh[1:], [True]])]


def rolled(contexts: list[bytes], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first 0 to AROUND bytes of each context (its last ones, if ``backwards``), and its length."""
    sizes = np.array([len(c) for c in contexts])
    table = np.zeros((len(contexts), AROUND), dtype=np.uint64)
    for i, c in enumerate(contexts):
        table[i, : len(c)] = np.frombuffer(c[::-1] if backwards else c, dtype=np.uint8)
    hashes = np.zeros((len(contexts), AROUND + 1), dtype=np.uint64)
    for k in range(AROUND):
        hashes[:, k + 1] = mixed(hashes[:, k] * ODD[1] + table[:, k] + np.uint64(1))
    return hashes, sizes


def placed_strings(phrases: np.ndarray, lefts: list[bytes], rights: list[bytes]):
    """For each place ``o`` of the phrase: rows that have such a string, and its fingerprint."""
    left, n_left = rolled(lefts, True)
    right, n_right = rolled(rights, False)
    key = mixed(phrases.view(np.uint64))
    for o in range(AROUND + 1):
        rows = np.flatnonzero((n_left >= o) & (n_right >= AROUND - o))
        yield o, rows, mixed(mixed(key[rows] + left[rows, o]) * ODD[0] + right[rows, AROUND - o])


def _whole(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


OCCURRENCES = "d long, r long, start int, phrase long, around long"


def _phrases(batches):
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at : at + 500]
            found = [parse(_whole(t)) for t in part["text"]]
            n = [len(f[0]) for f in found]
            yield pd.DataFrame({
                "d": np.repeat(part["d"].to_numpy(), n), "r": np.repeat(part["r"].to_numpy(), n),
                "start": np.concatenate([f[0] for f in found]).astype(np.int32),
                "phrase": np.concatenate([f[1] for f in found]), "around": np.concatenate([f[2] for f in found])})


CONTEXTS = "phrase long, d long, r long, start int, open boolean, before binary, behind binary"


def _contexts(batches):
    names = [c.split()[0] for c in CONTEXTS.split(", ")]
    for batch in batches:
        rows = []
        for item in batch.itertuples(index=False):
            content = _whole(item.text)
            for w in item.wanted:
                start = w["start"]
                rows.append((w["phrase"], item.d, item.r, start, w["open"], content[max(start - AROUND, 0) : start],
                             content[start + PHRASE : start + LENGTH]))
        yield pd.DataFrame(rows, columns=names)


INTERVALS = "d long, r long, low int, high int"


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    first = np.full(len(frame), AROUND + 1)
    last = np.full(len(frame), -1)
    for o, rows, prints in placed_strings(frame["phrase"].to_numpy(), list(frame["before"]), list(frame["behind"])):
        order = np.argsort(prints, kind="stable")
        same = prints[order][1:] == prints[order][:-1]
        twice = rows[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(rows) else rows
        first[twice] = np.minimum(first[twice], o)
        last[twice] = o
    hit = np.flatnonzero((last >= 0) & frame["open"].to_numpy())
    start = frame["start"].to_numpy()[hit]
    return pd.DataFrame({
        "d": frame["d"].to_numpy()[hit], "r": frame["r"].to_numpy()[hit],
        "low": (start - last[hit]).astype(np.int32), "high": (start - first[hit] + LENGTH).astype(np.int32)})


def _compared(batches):
    """Batches come sorted by phrase; each phrase is compared as a whole, many phrases at a time."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        while len(held) > TOGETHER:
            phrases = held["phrase"].to_numpy()
            ends = np.flatnonzero(phrases[1:] != phrases[:-1]) + 1
            ends = ends[ends >= TOGETHER][:1] if (ends >= TOGETHER).any() else ends[-1:]
            if not len(ends):
                break
            yield _compare(held.iloc[: ends[0]])
            held = held.iloc[ends[0] :].reset_index(drop=True)
    if held is not None and len(held):
        yield _compare(held)


STRINGS = "d long, r long, start int, open boolean, o int, print long"


def _spelled(batches):
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at : at + 500]
            for o, rows, prints in placed_strings(part["phrase"].to_numpy(), list(part["before"]), list(part["behind"])):
                chosen = part.iloc[rows][["d", "r", "start", "open"]]
                yield chosen.assign(o=np.int32(o), print=prints.view(np.int64))


KEPT = "d long, r long, n_removed long, n_spans long, kept binary"


def _cut_out(readable: bool):
    """What stays of each text; if it is to be read, each piece without the bytes of characters that are cut."""
    names = [c.split()[0] for c in KEPT.split(", ")]

    def run(batches):
        for batch in batches:
            rows = []
            for item in batch.itertuples(index=False):
                content = _whole(item.text)
                spans = np.array([(s["low"], s["high"]) for s in item.spans], dtype=np.int64)
                begins, ends = runs(len(content), spans[:, 0], spans[:, 1])
                edges = [0, *np.column_stack([begins, ends]).ravel().tolist(), len(content)]
                pieces = [content[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)]
                removed = len(content) - sum(map(len, pieces))
                if readable:
                    pieces = [piece.decode("utf-8", "ignore").encode() for piece in pieces]
                rows.append((item.d, item.r, removed, len(begins), b"".join(pieces)))
            yield pd.DataFrame(rows, columns=names)

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """``d`` and ``r`` name a row: its id (or a hash of the text, where it has none) and a hash of the text."""
    return docs.select(F.coalesce("doc_id", F.xxhash64("text")).alias("d"), F.xxhash64(F.lit("row"), "text").alias("r"), "text")


def _texts_of(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """Texts joined to marks by row; only texts with marks are shuffled if their ids are few enough to broadcast."""
    ids = cut(marks.select("d").distinct())
    if ids.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), "d", "left_semi")
    return texts.dropDuplicates(["d", "r"]).join(marks, ["d", "r"])


def intervals(texts: DataFrame) -> DataFrame:
    """``(d, r, low, high)``: byte intervals of rows whose union is all that strings occurring twice cover."""
    occurrences = texts.mapInPandas(_phrases, OCCURRENCES)
    repeated = occurrences.groupBy("phrase").count().filter("count > 1").select("phrase")
    occurrences = cut(occurrences.join(cut(repeated), "phrase"))
    kinds = cut(occurrences.groupBy("phrase", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "r", "start")).alias("one")))
    inside = occurrences.join(kinds.filter("n > 1").select("phrase", "around"), ["phrase", "around"]).select(
        "d", "r", (F.col("start") - AROUND).alias("low"), (F.col("start") + LENGTH).alias("high"))
    several = kinds.groupBy("phrase").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter(
        "kinds > 1 and least = 1")
    wanted = cut(kinds.join(several, "phrase").select(
        "phrase", "one.*", (F.col("n") == 1).alias("open"), (F.col("kinds") > MOST_CONTEXTS).alias("many")))
    marks = wanted.groupBy("d", "r").agg(F.collect_list(F.struct("start", "phrase", "open")).alias("wanted"))
    contexts = _texts_of(texts, cut(marks)).mapInPandas(_contexts, CONTEXTS)
    hot = cut(wanted.filter("many").select("phrase").distinct())
    if hot.isEmpty():
        return inside.union(_grouped(contexts))
    contexts = cut(contexts)
    strings = contexts.join(hot, "phrase", "left_semi").mapInPandas(_spelled, STRINGS)
    twice = strings.groupBy("o", "print").count().filter("count > 1").drop("count")
    found = strings.filter("open").join(twice, ["o", "print"]).groupBy("d", "r", "start").agg(
        F.min("o").alias("first"), F.max("o").alias("last"))
    counted = found.select("d", "r", F.expr("start - last").alias("low"), F.expr(f"start - first + {LENGTH}").alias("high"))
    return inside.union(_grouped(contexts.join(hot, "phrase", "left_anti"))).union(counted)


def _grouped(contexts: DataFrame) -> DataFrame:
    return contexts.repartition("phrase").sortWithinPartitions("phrase").mapInPandas(_compared, INTERVALS)


def changed(docs: DataFrame, readable: bool = False) -> DataFrame:
    """``(d, r, n_removed, n_spans, kept)`` of the rows that lose bytes; ``kept`` is what stays of them.

    If it is to be ``readable``, characters that lose some of their bytes go as a whole.
    """
    texts = keyed(docs.filter("text is not null"))
    spans = cut(intervals(texts).groupBy("d", "r").agg(F.collect_set(F.struct("low", "high")).alias("spans")))
    return cut(_texts_of(texts, spans).mapInPandas(_cut_out(readable), KEPT))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row."""
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    own = docs.select(
        "doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("d"), F.xxhash64(F.lit("row"), "text").alias("r"),
        F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("whole"))
    cuts = changed(docs).select("d", "r", "n_removed", "n_spans", F.sha2("kept", 256).alias("part"))
    return own.join(cuts, ["d", "r"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("part", "whole").alias("kept_sha256"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with what stays of their texts; characters that lose some of their bytes go as a whole.

    ``n_chars``, where there is such a column, is counted anew for the texts that change.
    """
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce("doc_id", F.xxhash64("text")).alias("d"), F.xxhash64(F.lit("row"), "text").alias("r"))
    cuts = changed(docs, readable=True).select("d", "r", F.decode("kept", "utf-8").alias("kept"))
    joined = row.join(cuts, ["d", "r"], "left")
    values = {"text": F.coalesce("kept", "doc.text")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("doc.n_chars"))
    return joined.select(*[values.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])

