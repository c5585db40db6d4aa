"""Hard negatives, sketches and spelling variants, against plain Python over every pair."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlane.llm import fingerprints as fp, hard_negatives as hn, spelling_variants as sv
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- hard negatives -----------------------------------------------------------------------------------------


def mined(rows, anchor, positives=5, negatives=3, least=50, most=95):
    distinct = sorted({(i, l, tuple(v)) for i, l, v in rows if i is not None and l is not None and v is not None and None not in v})
    found = []
    for a, (i, label, vector) in enumerate(distinct):
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, w)), j, m != label) for b, (j, m, w) in enumerate(distinct)
                        if a != b and len(w) == len(vector))
        for score, j, _ in [s for s in scored if not s[2]][:positives]:
            fits = [(-s, k) for s, k, other in scored if other and least * -score <= 100 * -s <= most * -score]
            found += [(i, j, rank, k, -score, s) for rank, (s, k) in enumerate(fits[:negatives], start=1)]
    return sorted(found)


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(400):
        v = centres[i % 6] + 0.6 * rng.normal(size=8)
        rows.append((i, int(rng.integers(3)), np.floor(20 * v).astype(int).tolist()))
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(150)]  # one very common vector
    rows += [rows[0], rows[10], (20, 1, rows[21][2])]  # repeated rows, and another row under a known id
    rows += [(None, 1, [1] * 8), (30, None, [1] * 8), (40, 1, None), (50, 1, [1, None] * 4), (60, 2, [0] * 8), (70, 1, [5, 5]), (80, 2, [4, 5]),
             (90, 1, [6, 7]), (100, 1, [])]
    return rows


SCHEMA = "id long, label int, vector array<long>"


@pytest.mark.parametrize("shard, block, step", [(8192, 16384, 128), (64, 8, 4)])
def test_negatives_match_every_pair(spark, vector_rows, monkeypatch, shard, block, step):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_ROWS", block), ("FIRST_STEP", step), ("TOGETHER", 3 if step == 4 else 256)):
        monkeypatch.setattr(hn, name, value)
    frame = spark.createDataFrame(vector_rows, SCHEMA).withColumn("row", F.lit("clash")).withColumn("anchor", F.lit(1))
    found = sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 10 == 0).collect()))
    assert found == mined(vector_rows, lambda i: i % 10 == 0) and len(found) > 200


def test_negatives_of_empty_tables_and_of_no_anchor(spark, vector_rows):
    frame = spark.createDataFrame(vector_rows, SCHEMA)
    assert hn.hard_negatives(frame.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hn.hard_negatives(frame, F.col("id") < 0).count() == 0


def test_a_walk_ends_once_nothing_better_can_follow():
    rng = np.random.default_rng(2)
    middle = rng.normal(size=16)
    near = np.floor(100 * (middle + 0.05 * rng.normal(size=(40, 16)))).astype(np.int64)
    far = np.floor(100 * rng.normal(size=(5000, 16))).astype(np.int64)
    points, members = np.concatenate([far, near[8:]]), near[:8]
    looked = []

    def may(who, columns):
        looked.append(len(columns))
        return np.ones((len(who), len(columns)), dtype=bool)

    shared = hn.SharedList(members, *hn.units(points))
    zero, most = np.full(8, hn.LEAST), np.full(8, hn.MOST)
    request, score, name, _ = hn.walk(shared, np.arange(8), members, may, np.arange(8), zero, most, points, np.arange(len(points)), 5)
    every = members @ points.T
    assert sum(looked) < len(points) / 4
    assert score.reshape(8, 5).tolist() == (-np.sort(-every, axis=1)[:, :5]).tolist()


def test_scores_that_are_too_large_are_told():
    with pytest.raises(ValueError, match="62 bits"):
        hn.products(np.array([[1 << 40]]), np.array([[1 << 40]]))
    assert hn.products(np.array([[(1 << 30) + 1]]), np.array([[(1 << 30) + 3]])).tolist() == [[((1 << 30) + 1) * ((1 << 30) + 3)]]


def test_vectors_are_scaled_and_labels_moved(spark):
    frame = spark.createDataFrame(
        [(7, 9, [0.5, -0.001]), (8, 9, [1.0, float("nan")]), (14, None, [0.1]), (21, 3, None), (22, 1, [float("inf")])],
        "vec_id long, label int, embedding array<float>")
    assert [tuple(r) for r in hn.scaled(frame).collect()] == [(7, 0, [128, -1]), (8, 9, [256, None]), (14, None, [25]), (21, 4, None), (22, 1, [None])]


# --- sketches -----------------------------------------------------------------------------------------------


def shingles(text):
    found = WORD.findall((text or "").translate(ASCII))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def expected_edits(rows):
    """Digests of edited texts; of rows that share an id, any order may be meant, so they are left out."""
    ordered = sorted(((r[0], r[1] or "") for r in rows if r[0] is not None), reverse=True)
    found = {}
    for (i, text), (_, after) in zip(ordered, ordered[1:]):
        half = len(text) // 2
        found[i] = (len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    return found


@pytest.mark.parametrize("size", [fp.RANGE_BYTES, 2000])
def test_edits_follow_the_order_of_ids(spark, docs, rows, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE_BYTES", size)
    found = fp.edited_fingerprints(docs.withColumn("range", F.lit("x")).withColumn("guest", F.lit(1))).collect()
    assert len(found) == len(rows)
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    known = Counter(r[0] for r in rows)
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in found}
    wanted = {i: e for i, e in expected_edits(rows).items() if known[i] == 1 and known[i - 1] == 1}
    assert len(wanted) > 15 and all(got[i] == e for i, e in wanted.items())
    by_text = {}
    texts = {}
    for row in rows:
        texts.setdefault(row[0], row[1] or "")
    for r in found:
        if known[r["doc_id"]] == 1:
            by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next", "held_by_edited"))


def test_the_last_row_is_followed_by_the_first(spark):
    frame = spark.createDataFrame([(1, "ab"), (5, "cdef")], "doc_id long, text string")
    changed = {1: "ac", 5: "cdab"}
    found = {r["doc_id"]: r["edited_sha256"] for r in fp.edited_fingerprints(frame).collect()}
    assert found == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in changed.items()}
    alone = fp.edited_fingerprints(frame.filter("doc_id = 5")).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"cdcd").hexdigest() and alone["near_next"] == 1.0
    empty = fp.edited_fingerprints(frame.limit(0))
    assert empty.count() == 0 and empty.columns == fp.edited_fingerprints(frame).columns


def test_ranges_of_equal_ids_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_BYTES", 300)
    rows = [(7, sentence(i, 12)) for i in range(60)] + [(None, sentence(i, 9)) for i in range(40)] + [(i, sentence(i, 9)) for i in range(20)]
    found = fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in found) == Counter((i, len(t)) for i, t in rows)


def test_sketches_estimate_likeness_and_merge():
    texts = [sentence(i, 3000) for i in range(3)]
    texts.append(texts[0][: len(texts[0]) // 2] + texts[1][len(texts[1]) // 2 :])
    sketch = fp.sketches(texts)
    sets = [shingles(t) for t in texts]
    for a in range(4):
        for b in range(4):
            true = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            assert abs(fp.likeness(sketch[a], sketch[b]) - true) < 0.06
            assert abs(fp.containment(sketch[a], sketch[b]) - len(sets[a] & sets[b]) / len(sets[a])) < 0.06
    assert abs(len(sketch[0]) * fp.ONE_IN / len(sets[0]) - 1) < 0.15
    both = fp.merged(sketch[0], sketch[1])
    assert fp.containment(sketch[0], both) == 1.0 and both.tolist() == sorted({*sketch[0].tolist(), *sketch[1].tolist()})
    assert fp.from_text(fp.as_text(sketch[0])).tolist() == sketch[0].tolist()


def test_short_texts_keep_a_hash():
    texts = [f"only few words {i}" for i in range(50)] + ["", "  \n", "only few words 7"]
    sketch = fp.sketches(texts)
    assert all(len(s) == 1 for s in sketch[:50]) and len({fp.as_text(s) for s in sketch[:50]}) == 50
    assert fp.likeness(sketch[7], sketch[-1]) == 1.0 and fp.likeness(sketch[7], sketch[8]) == 0.0
    assert fp.likeness(sketch[50], sketch[51]) == 1.0 and fp.likeness(sketch[50], sketch[7]) == 0.0
    long = fp.sketches([sentence(1, 500)])[0]
    lone = np.array([int(fp.LIMIT) + 5], dtype=np.uint64)
    assert fp.merged(lone, long).tolist() == long.tolist()  # a hash above the threshold goes once another is there


def test_sketch_table_has_a_row_for_every_row(docs, rows, no_docs):
    found = fp.fingerprints(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    assert fp.fingerprints(no_docs).count() == 0


# --- spelling variants --------------------------------------------------------------------------------------


def spelled(rows):
    counted = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def judged(counted):
    found = {}
    for word, n in counted.items():
        others = [w for w in counted if near(word, w)]
        best = min(others, key=lambda w: (-counted[w], w), default=None)
        found[word] = (best if others and counted[best] >= 10 * n else None, n, len(others))
    rows = []
    for word, (form, n, k) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        rows.append((word, form, root, n, k, counted[form] if form else None))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def variant_rows():
    """Words with variants of all kinds, chains of forms, and one crowded length."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcde") for _ in range(rng.choice([7, 8, 8, 8, 9]))) for _ in range(300)] + ["überalles", "Überalles", "überallès"]
    rows = []
    for i, word in enumerate(words):
        k = rng.randrange(len(word))
        spellings = [word, word[:k] + word[k + 1 :], word[:k] + "xyé"[i % 3] + word[k + 1 :], word[:k] + "z" + word[k:], word.upper()]
        times = [rng.choice([1, 2, 25, 300]), 2, rng.choice([2, 30]), 3, 1]
        rows.append((i, " ".join(w for w, n in zip(spellings, times) for _ in range(n))))
    rows += [(999, None), (None, "withoutid withoutid Withoutid"), (998, ""), (0, rows[0][1]), (0, rows[0][1]), (5, "q" * 5000 + " " + "q" * 4999)]
    rows += [(700 + i, " ".join(["chainabc"] * 2 + ["chainabd"] * 40 + ["chainaed"] * 600)) for i in range(3)]
    return rows + [(i, "q" * 5000 + " " + "q" * 4999) for i in (6, 7, 8)]


@pytest.mark.parametrize("cell, leaf, together", [(sv.CELL_WORDS, sv.LEAF_WORDS, sv.TOGETHER), (40, 4, 50), (5, 2, 7)])
def test_variants_match_every_pair(spark, variant_rows, monkeypatch, cell, leaf, together):
    for name, value in (("CELL_WORDS", cell), ("LEAF_WORDS", leaf), ("TOGETHER", together), ("PAIRS", sv.PAIRS if leaf > 4 else 64)):
        monkeypatch.setattr(sv, name, value)
    frame = spark.createDataFrame(variant_rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    counted = spelled(variant_rows)
    words = sv.spelled(frame)
    assert {r["word"]: r["n"] for r in words.collect()} == counted
    found = sorted(map(tuple, sv.variants(words).collect()), key=repr)
    wanted = judged(counted)
    assert found == wanted
    assert max(r[3] for r in wanted) >= 300 and sum(r[2] != r[1] and r[1] is not None for r in wanted) > 0
    if cell == 40:
        pairs = sorted((r["word"], r["other"], r["other_n"]) for r in sv.near_words(words).collect())
        assert pairs == sorted((a, b, counted[b]) for a in counted for b in counted if near(a, b))


def test_boxes_that_cannot_be_parted_are_dealt(spark, monkeypatch):
    """Anagrams have equal counts, so no plane parts them."""
    monkeypatch.setattr(sv, "CELL_WORDS", 10)
    monkeypatch.setattr(sv, "LEAF_WORDS", 3)
    rng = random.Random(1)
    words = sorted({"".join(rng.sample("abcdefg", 7)) for _ in range(150)} | {"".join(rng.sample("abcdeff", 7)) for _ in range(50)})
    frame = spark.createDataFrame([(w, 2 + i) for i, w in enumerate(words)], "word string, n long")
    pairs = {(r["word"], r["other"]) for r in sv.near_words(frame).collect()}
    assert pairs == {(a, b) for a in words for b in words if near(a, b)} and pairs


def test_variants_of_nothing(spark, no_docs):
    assert sv.variants(sv.spelled(no_docs)).count() == 0
    one = spark.createDataFrame([(1, "lonelyword lonelyword")], "doc_id long, text string")
    assert [tuple(r) for r in sv.variants(sv.spelled(one)).collect()] == [("lonelyword", None, "lonelyword", 2, 0, None)]
