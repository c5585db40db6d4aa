"""Document fingerprints: sketches of a fixed share of all shingle hashes.

A text's sketch keeps every hash of its distinct five-word shingles that lies below ``SHARE`` of the range of 64 bits,
so it grows with the text, and two sketches of any sizes are compared as they are: the hashes that both keep are a fair
sample of the shingles that both texts have. Sketches of parts merge by union. A text that keeps no hash at all keeps
its smallest one, so that equal short texts still agree and different ones do not; a merge drops such a hash as soon as
another below the threshold is there. Words are those of the Jaccard join (bytes 0x20 and 0x09 to 0x0D part them, A-Z
count as a-z); a text with fewer than five words has its whole sequence as one shingle, one without words an empty sketch.

``fingerprints`` gives the sketch of each row and needs no shuffle. ``edited_fingerprints`` compares each row with the
next one, so rows are dealt into ranges of descending id, once: bounds are read from a sorted table of ids and hashes,
and the first row of a range is sent to the range before it as well, so that no range waits for another.

A null text counts as empty; two empty sketches have a likeness of one, one empty sketch has none of another. Rows that
repeat an id follow each other in the order of a 64-bit hash of their text and are spread by it, rows without id come
last in that order; the row after the last is the first, a single row follows itself. Texts are worked on in slices of
bounded size, a longer one by itself. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlane.llm.text import rolled_shingles

SHINGLE = 5
#: The share of all hashes that a sketch keeps, as one in so many.
ONE_IN = 4
LIMIT = np.uint64((1 << 64) // ONE_IN)
#: A range of rows holds about so many bytes of text, a slice of a range at most so many characters.
RANGE_BYTES, SLICE_CHARS = 16 << 20, 1 << 22
COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, held_by_edited double"
)


def sketches(texts) -> list[np.ndarray]:
    """The sorted hashes that each text keeps, as unsigned 64-bit integers."""
    hashes, bounds = rolled_shingles(texts, SHINGLE)
    below = np.concatenate([[0], np.cumsum(hashes < LIMIT)])
    low = hashes[hashes < LIMIT]
    found = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        kept = low[below[a] : below[b]]
        found.append(np.unique(kept) if len(kept) else hashes[a:b].min(keepdims=True) if b > a else hashes[:0])
    return found


def merged(sketch: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(sketch, other)
    low = both[both < LIMIT]
    return low if len(low) else both[:1]


def shared(sketch: np.ndarray, other: np.ndarray) -> int:
    if not len(sketch) or not len(other):
        return 0
    at = np.minimum(np.searchsorted(other, sketch), len(other) - 1)
    return int((other[at] == sketch).sum())


def likeness(sketch: np.ndarray, other: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingles."""
    both = shared(sketch, other)
    whole = len(sketch) + len(other) - both
    return both / whole if whole else 1.0


def containment(sketch: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has too."""
    return shared(sketch, other) / len(sketch) if len(sketch) else 1.0


def as_text(sketch: np.ndarray) -> str:
    """Sixteen hexadecimal digits a hash, ascending."""
    return sketch.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u8").astype(np.uint64)


def slices(batches):
    """Batches in slices of bounded size in characters."""
    for batch in batches:
        sizes = batch["text"].str.len().fillna(0).to_numpy().cumsum() // SLICE_CHARS
        for at in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes)) + 1):
            yield batch.iloc[at]


def _fingerprints(batches):
    for batch in slices(batches):
        found = sketches(batch["text"])
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "sketch": [s.view(np.int64) for s in found]})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, sketch)`` per row; hashes are signed views of unsigned ones, in unsigned order."""
    return docs.select("doc_id", "text").mapInPandas(_fingerprints, "doc_id long, sketch array<long>")


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the head of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(names, texts, sketch_of, following, sketch_after):
    """Result rows of texts, each with the one after it."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    changed_sketch = sketches(changed)
    return pd.DataFrame({
        "doc_id": pd.array(names, dtype="Int64"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [as_text(s) for s in sketch_of], "edited_fingerprint": [as_text(s) for s in changed_sketch],
        "near_edited": [likeness(a, b) for a, b in zip(sketch_of, changed_sketch)],
        "near_next": [likeness(a, b) for a, b in zip(sketch_of, sketch_after)],
        "held_by_edited": [containment(a, b) for a, b in zip(sketch_of, changed_sketch)],
    })


def _ranges(batches):
    """Rows come sorted by range, guests of a range last; a guest only follows, it has no row of its own."""
    last = None  # range, id, text and sketch of the row that waits for the one after it
    for batch in slices(batches):
        texts = [t or "" for t in batch["text"]]
        found = sketches(texts)
        ranges, guests = batch["range"].tolist(), batch["guest"].tolist()
        names = [None if none else n for none, n in zip(batch["none"].tolist(), batch["id"].tolist())]
        pairs = []
        for row in zip(ranges, names, texts, found, guests):
            if last is not None and last[0] == row[0]:
                pairs.append((last, row))
            last = None if row[4] else row
        if pairs:
            own, after = zip(*pairs)
            yield _compared([r[1] for r in own], [r[2] for r in own], [r[3] for r in own], [r[2] for r in after], [r[3] for r in after])


KEY = np.dtype([("none", "?"), ("down", "<i8"), ("hash", "<i8")])


def range_of(bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last bound not after each key, and whether it is the key; both are arrays of ``KEY``, bounds ascending."""
    both = np.concatenate([bounds, keys])
    order = np.lexsort((np.arange(len(both)) >= len(bounds), both["hash"], both["down"], both["none"]))
    seen = np.empty(len(both), dtype=np.int64)
    seen[order] = np.cumsum(order < len(bounds))
    own = np.maximum(seen[len(bounds) :] - 1, 0)
    return own, bounds[own] == keys


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint beside that of its edited text, and its likeness to both it and the next row."""
    hashed = docs.select(
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    size = hashed.agg(F.sum(F.octet_length("text"))).first()[0]
    if size is None:
        return docs.sparkSession.createDataFrame([], COLUMNS)
    key = [F.col("none"), F.bitwise_not("id").alias("down"), F.col("hash")]
    sorted_keys = hashed.select(*key).repartitionByRange(max(-(-size // RANGE_BYTES), 1), "none", "down", "hash")
    # one bound a range: the key of its first row
    firsts = sorted_keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct("none", "down", "hash")).alias("k"))
    bounds = np.array(sorted(tuple(r) for r in firsts.select("k.*").collect()), dtype=KEY)

    def ranged(none: pd.Series, down: pd.Series, hashes: pd.Series) -> pd.Series:
        keys = np.empty(len(none), dtype=KEY)
        keys["none"], keys["down"], keys["hash"] = none, down, hashes
        own, first = range_of(bounds, keys)
        return pd.Series([[r, (r - 1) % len(bounds)] if f else [r] for r, f in zip(own.tolist(), first.tolist())])

    ranges = F.pandas_udf(ranged, "array<int>")(*key)
    dealt = hashed.select("none", "id", "text", "hash", F.posexplode(ranges).alias("guest", "range"))
    dealt = dealt.withColumn("guest", F.col("guest") > 0).repartition(2 * len(bounds), "range")
    # of equal first rows all are guests; the first of them follows
    in_order = dealt.sortWithinPartitions("range", "guest", "none", F.desc("id"), "hash", "text")
    return in_order.select("range", "guest", "none", "id", "text").mapInPandas(_ranges, COLUMNS)
