"""Quality rules, Jaccard join, byte repeats, mixing and language model, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlane.llm import jaccard_join as jj, language_model as lm, quality_rules as qr, repeated_bytes as rb
from cohortlane.llm import source_mixing as sm
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def as_rows(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def test_quality_counts_match_plain_python(docs, rows):
    expected = []
    for row in rows:
        text, found = row[1] or "", words(row[1])
        grams = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
        times = Counter(grams)
        covered = {k for i, g in enumerate(grams) if times[g] > 1 for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
        expected.append((row[0], len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"),
                         len(lines) - len(set(lines)), len(covered), failed))
    result = qr.quality_rules(docs)
    assert as_rows(result, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(expected, key=repr)
    assert result.filter("kept and base_failed").isEmpty()
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == result.filter("kept").count() > 0


def test_quality_runs_without_python_or_shuffle(docs, no_docs):
    plan = qr.quality_rules(no_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert qr.quality_rules(no_docs).count() == 0


def test_rules_bound_ratios(spark):
    rule = qr.Threshold("r", "a", "b", least=10, most=50)
    frame = spark.createDataFrame([(1, 11), (1, 10), (5, 10), (6, 10)], "a long, b long")
    assert [r[0] for r in frame.select(rule.column()).collect()] == [False, True, True, False]


def shingles(text):
    found = words((text or "").translate(ASCII))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def groups(rows):
    """Smallest id reachable, per id, by comparing every pair."""
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {x: root(x) for x in parent}


@pytest.fixture(scope="module")
def near_rows():
    """Sets of 1 to 40 shingles in families that differ by a few words, so that both ways of joining are needed."""
    rows = []
    for family in range(12):
        base = sentence(100 + family, 5 + 3 * family).split()
        for copy in range(8):
            changed = list(base)
            if copy:
                changed[(copy * 5) % len(base)] = f"new{copy}"
            if copy > 4:
                changed += [f"tail{copy % 3}"]
            rows.append((len(rows), " ".join(changed[: len(changed) - copy % 2])))
    return rows


def test_components_match_all_pairs(spark, docs, rows, near_rows):
    found = as_rows(jj.near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    expected = groups(rows)
    assert found == sorted(((r[0], len(shingles(r[1])), expected.get(r[0])) for r in rows), key=repr)
    frame = spark.createDataFrame(near_rows, "doc_id long, text string").repartition(4)
    expected = groups(near_rows)
    assert dict(as_rows(jj.near_duplicates(frame), "doc_id", "component_id")) == expected
    assert 12 < len(set(expected.values())) < len(near_rows)


@pytest.mark.parametrize("boundary", [1, 9, 16])
def test_boundary_and_frequent_shingles_do_not_change_the_result(spark, near_rows, monkeypatch, boundary):
    monkeypatch.setattr(jj, "choose_boundary", lambda sizes, met: boundary)
    monkeypatch.setattr(jj, "FREQUENT", 2)
    frame = spark.createDataFrame(near_rows, "doc_id long, text string")
    assert dict(as_rows(jj.near_duplicates(frame), "doc_id", "component_id")) == groups(near_rows)


def test_boundary_follows_the_cost():
    assert jj.choose_boundary({5: 1000}, met=100.0) >= 5
    assert jj.choose_boundary({16: 1000}, met=0.0) < 16


def test_an_id_with_several_texts_has_the_links_of_all(spark, no_docs):
    x, y = sentence(50, 40), sentence(51, 40)
    near_y = y.split()
    near_y[3] = "changed"
    frame = spark.createDataFrame([(1, x), (3, x), (3, y), (5, " ".join(near_y)), (6, sentence(52, 40))], "doc_id long, text string")
    assert as_rows(jj.near_duplicates(frame), "doc_id", "component_id") == [(1, 1), (3, 1), (3, 1), (5, 1), (6, 6)]
    assert jj.near_duplicates(no_docs).count() == 0 and jj.keep_one_row(no_docs).count() == 0


def test_groups_around_the_threshold_meet_few_pairs(spark, monkeypatch):
    """Texts that differ from a common one by as much as may be are mostly no links of each other."""
    rows, base = [], sentence(60, 120).split()
    for i in range(60):
        changed = list(base)
        for k in range(1 + i % 4):
            changed[(i * 7 + k * 29) % len(base)] = f"own{i}x{k}"
        rows.append((i, " ".join(changed)))
    pairs = []
    plain = jj.linked
    monkeypatch.setattr(jj, "linked", lambda p, sets: (pairs.append(p.count()), plain(p, sets))[1])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(as_rows(jj.near_duplicates(frame), "doc_id", "component_id")) == groups(rows)
    assert sum(pairs) < 60 * 59 / 4


def test_columns_with_clashing_names_stay(spark):
    rows = [(1, sentence(70, 30), 5, "a", "z"), (2, sentence(70, 30), 6, "b", "y"), (3, sentence(71, 30), 7, "c", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _row int, row string, own string")
    kept = jj.keep_one_row(frame)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_one_row_of_each_group_stays_in_the_pipeline(spark, no_docs):
    """Repeated rows and rows without id; the next stage must not cut both copies out."""
    import corpus_pipeline as cp

    a, b, c, d = (sentence(700 + i, 80) for i in range(4))
    near = a.split()
    near[40] = "changed"
    near_d = d.split()
    near_d[30] = "changed"
    rows = [(1, a), (1, a), (2, " ".join(near)), (None, a), (None, b), (None, b), (None, b.upper()), (3, c), (None, c),
            (2, d), (9, " ".join(near_d)), (None, None), (None, None), (5, ""), (5, "")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component long").repartition(3)
    kept = cp.jaccard(spark, frame, "")
    assert kept.columns == frame.columns
    found = as_rows(kept, "doc_id", "text")
    one_b = [r for r in found if r[0] is None and r[1]]
    assert len(one_b) == 1 and one_b[0][1] in (b, b.upper())
    assert sorted(set(found) - set(one_b), key=repr) == sorted({(1, a), (3, c), (2, d), (None, None), (5, "")}, key=repr)
    assert len(found) == 8
    left = {r["text"] for r in cp.suffix_arrays(spark, kept, "").collect()}
    assert {a, c, d} <= left
    assert cp.jaccard(spark, no_docs, "").count() == 0


def repeats(texts):
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    found = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - 199):
            if times[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(d) else 0
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone])
        edges = [0, *(np.flatnonzero(np.diff(gone)) + 1).tolist(), len(d)] if len(d) else [0]
        pieces = [d[a:b] for a, b in zip(edges, edges[1:]) if not gone[a]]
        readable = "".join(p.decode("utf-8", "ignore") for p in pieces)
        found.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), readable))
    return found


def passages():
    """Passages of 150 to 450 bytes, cut and joined so that repeats touch, overlap and end inside each other."""
    parts = [sentence(900 + i, 60)[: 150 + 30 * i] for i in range(11)]
    rows = [(i, sentence(2000 + i, 30) + parts[i % 11] + parts[(i * 3) % 11] + sentence(3000 + i, 20)) for i in range(40)]
    rows += [(40, parts[5] + parts[6]), (41, parts[6][17:]), (42, parts[9][:199]), (43, parts[9][:200]), (44, parts[9][1:201]),
             (45, "a" * 199), (46, "a" * 200), (47, "b" * 201), (48, "é" * 150)]
    return rows


@pytest.mark.parametrize("many, together", [(20_000, 4096), (2, 4096), (20_000, 3)])
def test_repeated_bytes_match_all_strings(spark, docs, rows, monkeypatch, many, together):
    monkeypatch.setattr(rb, "MOST_CONTEXTS", many)
    monkeypatch.setattr(rb, "TOGETHER", together)
    extra = passages()
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    every = [(r[0], r[1]) for r in rows] + extra
    expected = [(e[0], *f[:4]) for e, f in zip(every, repeats([e[1] for e in every]))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert as_rows(rb.without_repeats(frame), *names) == sorted(expected, key=repr)


def test_texts_without_repeats(docs, no_docs, rows):
    result = rb.remove_repeats(docs)
    expected = sorted((f[4] for f in repeats([r[1] for r in rows])), key=repr)
    assert result.columns == docs.columns
    assert sorted((r["text"] or "" for r in result.collect()), key=repr) == expected
    assert rb.without_repeats(no_docs).count() == 0 and rb.remove_repeats(no_docs).count() == 0


def test_pieces_of_cut_characters_do_not_join(spark):
    """What stays of one character before a span and of another behind it makes no third one."""
    passage = "p" * 198
    first, second = f"headĩ{passage}é tail one", f"other ũ{passage}è"
    # the span reaches from the second byte of one letter to the first byte of another
    frame = spark.createDataFrame([(1, first), (2, second)], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in rb.remove_repeats(frame).collect()}
    assert "p" not in found[1] + found[2]
    assert found == {1: "head tail one", 2: "other "}


def test_rows_of_one_id_are_told_apart(spark):
    shared = sentence(80, 60)
    rows = [(1, f"{i} {sentence(90 + i, 20)} " + (shared if i < 3 else "")) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(r["text"] for r in rb.remove_repeats(frame).collect())
    assert found == sorted(f[4] for f in repeats([r[1] for r in rows]))


def test_rows_without_id_are_mixed_one_by_one(spark):
    rows = [(None, f"w{i} " * 10, "a") for i in range(300)] + [(i, "x " * 100, "b") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = sm.mixture(frame, entropy_share=None, max_epochs=None, budget=21_000, block_tokens=200)
    taken = sm.draws(frame, plan).filter("source = 'a'").groupBy("epoch").count().collect()
    quota = next(r for r in plan.collect() if r["source"] == "a")["weight"] * 21_000 / 10
    assert abs(sum(r["count"] for r in taken) - quota) <= 1.5


def test_mixing_draws_within_budget_and_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 40)), "big" if i % 3 else f"s{i % 5}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = sm.mixture(frame, entropy_share=0.95, max_epochs=3.0, block_tokens=100)
    drawn = sm.draws(frame, plan).select("doc.doc_id", "doc.source", "epoch", "block", "block_key", "doc_key").collect()
    tokens, size = defaultdict(int), {r[0]: len(r[1].split()) for r in rows}
    for r in rows:
        tokens[r[2]] += size[r[0]]
    p = plan.collect()
    assert sum(r["weight"] for r in p) == pytest.approx(1)
    entropy = -sum(r["weight"] * math.log(r["weight"]) for r in p)
    ratio = [r["weight"] / tokens[r["source"]] for r in p]
    assert entropy >= 0.95 * math.log(len(p)) - 1e-3 or max(ratio) / min(ratio) == pytest.approx(3, abs=0.01)
    assert max(ratio) / min(ratio) <= 3.001
    budget = max(math.ceil(tokens[r["source"]] / r["weight"]) for r in p)
    for r in p:
        of = [d for d in drawn if d["source"] == r["source"]]
        got = sum(size[d["doc_id"]] for d in of)
        goal = round(r["weight"] * budget)
        assert goal - 40 < got <= goal  # at most one document short
        whole = [d for d in of if d["epoch"] < r["epochs"]]
        assert Counter(d["doc_id"] for d in whole) == {i: r["epochs"] for i, _, s in rows if s == r["source"]}
        # the last pass is a prefix of its permutation
        order = lambda d: (d["block_key"], d["block"], d["doc_key"])
        last = sorted(order(d) for d in of if d["epoch"] == r["epochs"])
        if last:
            every = sm.draws(frame, plan.withColumn("epochs", F.lit(r["epochs"] + 1))).filter(
                (F.col("doc.source") == r["source"]) & (F.col("epoch") == r["epochs"])).select("block_key", "block", "doc_key")
            assert sorted(tuple(x) for x in every.collect())[: len(last)] == last


def test_exponent_meets_its_target(spark):
    totals = spark.createDataFrame([(n, 1111) for n in (1000, 100, 10, 1)], "tokens long, all_tokens long")

    def entropy(e):
        w = np.array([1000, 100, 10, 1], dtype=float) ** e
        w /= w.sum()
        return -(w * np.log(w)).sum()

    e = sm.solve_exponent(totals, entropy_share=0.9)
    assert entropy(e) >= 0.9 * math.log(4) > entropy(e + 2 / sm.GRID)
    e = sm.solve_exponent(totals, max_epochs=5.0)
    assert 1000 ** (1 - e) <= 5.0 < 1000 ** (1 - e + 2 / sm.GRID)
    assert sm.solve_exponent(totals, entropy_share=0.0) == 1.0 and sm.solve_exponent(totals, max_epochs=1e9) == 0.0


def test_mixing_takes_awkward_rows(docs, no_docs, rows):
    mixed = sm.mixed(docs)
    assert mixed.columns == docs.columns
    drawn = Counter(map(repr, as_rows(mixed, *docs.columns)))
    assert set(drawn) == {repr(tuple(r)) for r in rows}
    assert sm.mixed(no_docs).count() == 0
    nothing = sm.mixed(no_docs.union(docs.filter("text is null")))
    assert nothing.count() == docs.filter("text is null").count()


@pytest.mark.parametrize("order, size, part", [(1, 1 << 22, 1 << 24), (2, 1 << 22, 1 << 24), (2, 500, 1000), (3, 2000, 700), (5, 20, 30_000)])
def test_backoff_scores_match_plain_python(docs, rows, no_docs, monkeypatch, order, size, part):
    """Every order; one slice and one partition as well as many small ones, with ids that are larger than a slice."""
    monkeypatch.setattr(lm, "SLICE_BYTES", size)
    monkeypatch.setattr(lm, "PART_BYTES", part)
    texts = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            texts[r[0]].append(["<", *map(str.encode, words((r[1] or "").translate(ASCII)))])
    total = sum(len(t) - 1 for ts in texts.values() for t in ts)
    counts, holders = Counter(), defaultdict(set)
    for d, ts in texts.items():
        for t in ts:
            for end in range(2, len(t) + 1):
                for k in range(1, min(order, end) + 1):
                    counts[tuple(t[end - k : end])] += 1
                    holders[tuple(t[end - k : end])].add(d)
    counts[("<",)] = sum(any(len(t) > 1 for t in ts) for ts in texts.values())

    def part(t, end):
        for k in range(min(order, end), 1, -1):
            gram = tuple(t[end - k : end])
            if len(holders[gram]) > 1:
                return math.log(counts[gram] / counts[gram[:-1]]) + (order - k) * math.log(0.4)
        return math.log(counts[(t[end - 1],)] / total) + (order - 1) * math.log(0.4)

    found = {r["doc_id"]: (r["n_words"], r["score"]) for r in lm.backoff_scores(docs, order).collect()}
    assert found.keys() == texts.keys()
    for d, ts in texts.items():
        parts = [part(t, end) for t in ts for end in range(2, len(t) + 1)]
        assert found[d] == (len(parts), pytest.approx(sum(parts) / len(parts), abs=2e-6) if parts else None)
    assert lm.backoff_scores(no_docs, order).count() == 0


def test_whole_vocabulary_keeps_every_word(spark, docs, rows, no_docs):
    """Rare words are no common unknown word; against plain Python."""
    extra = [(500 + i, f"rare{i} other{i} the the", "en", "a", 1, 7, "x") for i in range(5)]
    texts = defaultdict(list)
    for r in [*rows, *extra]:
        if r[0] is not None:
            texts[r[0]].append(words((r[1] or "").translate(ASCII)))
    grams = {d: [g for t in ts if t for g in zip(["<", *map(str.encode, t)], map(str.encode, t))] for d, ts in texts.items()}
    pairs, holders = Counter(g for x in grams.values() for g in x), defaultdict(set)
    for d, x in grams.items():
        for g in x:
            holders[g].add(d)
    word = Counter(g[1] for x in grams.values() for g in x)
    total = sum(word.values())
    word["<"] = sum(any(ts) for ts in texts.values())
    frame = docs.union(spark.createDataFrame(extra, docs.schema))
    found = {r["doc_id"]: (r["n_words"], r["score"]) for r in lm.backoff_scores(frame).collect()}
    assert found.keys() == grams.keys()
    for d, x in grams.items():
        parts = [math.log(pairs[g] / word[g[0]]) if len(holders[g]) > 1 else math.log(0.4 * word[g[1]] / total) for g in x]
        assert found[d] == (len(x), pytest.approx(sum(parts) / len(x), abs=2e-6) if x else None)
    assert lm.backoff_scores(no_docs).count() == 0


def test_members_of_a_list_meet_under_the_positional_filter_alone(spark, monkeypatch):
    """Texts that share a passage but no link: their components are never paired by a listed shingle alone."""
    plans = []
    plain = jj.cut
    monkeypatch.setattr(jj, "cut", lambda f: plans.append(f._jdf.queryExecution().optimizedPlan().toString()) or plain(f))
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"w{n}x{i}" for i in range(20)]) for n in range(30)]
    near = " ".join(texts[0].split()[:-2])
    rows = list(enumerate([*texts, near]))
    found = jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {**{i: i for i in range(30)}, 30: 0}
    across = [x for plan in plans for x in plan.split("\n") if "Join Inner" in x and re.search(r"NOT \(component#\d+L? = ", x)]
    assert across and all("rest#" in x for x in across)


def test_texts_with_a_few_common_shingles_are_not_compared_across_components(spark, monkeypatch):
    """Short passages of neighbours leave a text alone; texts about as different as links may be are all compared."""
    seen, texts = [], []
    plain = jj.between_components
    monkeypatch.setattr(jj, "between_components", lambda docs, open_, boundary: (
        seen.extend(r["doc_id"] for r in open_.collect()), plain(docs, open_, boundary))[1])
    monkeypatch.setattr(jj, "MOST_FREQUENT", 0)
    monkeypatch.setattr(jj, "ROUNDS", 0)
    for n in range(40):
        own = [f"own{n}x{i}" for i in range(300)]
        texts.append(" ".join([f"to{n}x{i}" for i in range(20)] + own + [f"to{n + 1}x{i}" for i in range(20)]))
    rows = list(enumerate(texts))
    for family in range(30):
        base = [f"base{family}x{i}" for i in range(30 + 6 * family)]
        rows.append((len(rows), " ".join(base)))
        for less in (0.8, 0.9):
            rows.append((len(rows), " ".join(base[: round(less * (len(base) - 4)) + 4])))
        other = list(base)
        for k in range((len(base) - 4) // 50 + family % 2):
            other[10 + 25 * k] = f"new{family}x{k}"
        rows.append((len(rows), " ".join(other)))
    found = jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = groups(rows)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == expected
    assert len(rows) - len(set(expected.values())) > 60
    assert min(seen) >= 40
