"""Words and hashes of texts, shared by the operators that work inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd

#: A-Z to a-z; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: The same words as a Spark column: parts between runs of the bytes 0x20 and 0x09 to 0x0D.
SEPARATOR_PATTERN = "[\\x20\\x09-\\x0D]+"


def words(text: str | None) -> list[bytes]:
    """Lower-cased words; ``bytes.split`` parts at exactly the bytes 0x20 and 0x09 to 0x0D."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def coded(lists: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all entries, the distinct entries, and the bounds of each list."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    flat = np.empty(bounds[-1], dtype=object)
    at = 0
    for part in lists:
        flat[at : at + len(part)] = part
        at += len(part)
    codes, distinct = pd.factorize(flat)
    return codes, np.asarray(distinct, dtype=object), bounds


def sliced(batches, rows: int = 500):
    """Batches in slices of bounded size, so that word lists of long texts don't pile up."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def rolled_shingles(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` words, end to end, and the bounds of each text's own.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    codes, distinct, bounds = coded([words(t) for t in texts])
    if not len(codes):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    hashes = pd.util.hash_array(distinct, categorize=False)[codes]
    rolled = np.zeros(0, dtype=np.uint64)
    if len(hashes) >= size:
        rolled = hashes[: len(hashes) - size + 1]
        for k in range(1, size):
            rolled = mixed(rolled) + hashes[k : k + len(rolled)]
        rolled = mixed(rolled)
    parts = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= size:
            parts.append(rolled[a : b - size + 1])
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)
            for h in hashes[a:b]:
                whole = mixed(whole) + h
            parts.append(mixed(whole))
        else:
            parts.append(rolled[:0])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
