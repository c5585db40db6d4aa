"""Url filter, archives, token files, pieces and nearest neighbours, against plain Python."""

import gzip
import hashlib
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlane.llm import components, piece_lattice as pl, token_planes as tp, url_filter as uf, vantage_trees as vt, warc
from cohortlane.session import scratch_folder
from tests.llm.conftest import sentence

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 300), (None, 5), (41, 99), (99, 100)]
    edges += edges[:5] + [(201, 200)]
    found = {r[0]: r[1] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 41 for i in (41, 99, *range(100, 160))}, 200: 200, 201: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rules_and_aliases(spark):
    canonical = '<LINK href="{}" rel=\'canonical\'>'
    pages = [
        (1, "http://A.Example.NET/en/x?q=1", None), (2, "https://example.net/de/", ""), (3, "http://net", ""), (4, "http://net/", ""),
        (5, "http://z.example.com/de/a#f", canonical.format("http://other.test/b")), (6, "http://other.test/b", "<p>"),
        (7, "http://m.org/fr/1", canonical.format("//other.test/b")), (8, "http://m.org/es/1", canonical.format("http://m.org/fr/1")),
        (9, "http://free.test/", '<meta http-equiv="refresh" content="0; URL=/there">'), (10, "http://free.test/there", ""),
        (11, None, "x"), (12, "no scheme", "x"), (13, "", ""), (5, "http://z.example.com/de/a#f", ""), (None, "http://q.example.com/de/", ""),
        (14, "http://notexample.net.test/", ""), (15, "http://xorg/fr/", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.url_verdicts(frame).collect()}
    assert uf.url_verdicts(frame).count() == len(pages)
    assert found[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[2] == ("example.net", "/de/", "net/", "block")
    assert found[3] == ("net", "", None, "allow") and found[4][2:] == ("net/", "block")
    assert found[5][2:] == ("example.com/de/", "block")
    assert found[6] == ("other.test", "/b", None, "block")  # an alias of a blocked page
    assert found[7][2:] == ("org/fr/", "allow")  # its own rule comes first
    assert found[8][2:] == (None, "block")
    assert found[9][3] == found[10][3] == "allow"
    assert found[11] == found[12] == found[13] == ("", "", None, "allow")
    assert found[None][3] == "block" and found[14][3] == found[15][3] == "allow"
    redirects = spark.createDataFrame([("http://free.test/there", "https://example.net/de/")], "a string, b string")
    found = {r["page_id"]: r["verdict"] for r in uf.url_verdicts(frame, redirects=redirects).collect()}
    assert found[9] == found[10] == "block"
    assert uf.url_verdicts(frame.limit(0)).count() == 0


@pytest.mark.parametrize("url, html, node", [
    ("http://free.test/d/a", '<link rel="canonical" href="page.html">', "http://free.test/d/page.html"),
    ("http://free.test/d/e/a?x=1", "<link rel=canonical href=../up>", "http://free.test/d/up"),
    ("http://free.test/d/a?x=1", '<link rel="canonical" href="?id=1">', "http://free.test/d/a?id=1"),
    ("http://free.test/d/a", '<link rel=canonical href="/r/../s">', "http://free.test/s"),
    ("http://free.test/d/a", '<base target="_top"><base href="http://base.test/b/c"><link rel="canonical" href="page">', "http://base.test/b/page"),
    ("http://free.test/d/a", '<link rel="canonical" href="../y"><base href="/b/c/d">', "http://free.test/b/y"),
    ("http://free.test/a", '<link rel="canonical" href="http://o.test/?x=1&amp;y=2&#38;z=3">', "http://o.test/?x=1&y=2&z=3"),
    ("http://free.test/a", '<link rel="canonical" href="/p?x=1&copy=2">', "http://free.test/p?x=1&copy=2"),
    ("http://free.test/d/a", '<meta http-equiv="refresh" content="0; url=t?x=1&amp;y=2">', "http://free.test/d/t?x=1&y=2"),
    ("http://free.test/d/a", "<meta content='3;URL=next' http-equiv=Refresh>", "http://free.test/d/next"),
    ("http://free.test/d/a", '<link rel="canonical" href="HTTP://U@Other.TEST/Path?Q=A#f">', "http://U@other.test/Path?Q=A"),
    ("http://free.test/d/a", '<link rel="canonical" href="log?to=http://o.test/">', "http://free.test/d/log?to=http://o.test/"),
    ("http://free.test/d/a", '<link rel="canonical" href="mailto:a@b.test">', None),
    ("http://free.test/d/a", '<link rel="canonical" href="http://[x"><p>', "http://[x"),
])
def test_targets_are_resolved(spark, url, html, node):
    pages = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    assert [tuple(r) for r in uf.link_edges(pages).collect()] == ([(url, node)] if node else [])


def test_blocks_reach_aliases_however_they_are_written(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "HTTP://Free.TEST/d/a", link.format("b?x=1&amp;y=2")), (2, "http://free.test/d/b?x=1&y=2", link.format("HTTP://Z.Example.COM/de/q")),
        (3, "http://z.example.com/de/q", ""), (4, "http://free.test/D/a", ""),
        (5, "http://free.test/x/y", '<base href="../d/"><meta http-equiv=refresh content="0;url=a">'),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in uf.url_verdicts(frame).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block"}


def pages(spark):
    long, other = sentence(1, 400), "é" * 500
    rows = [(1, "http://a/", long), (2, "http://b/\r\nX: y", long), (3, None, long), (4, "http://d/", other), (9, "http://e/", other),
            (5, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (10, "u", "WARC/1.1\r\n\r\nx\r\n\r\n" * 90), (3, None, long),
            (None, "u", long), (11, "u", "a\x00b" + "z" * 999), (11, "u", other + "!")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)


def test_archives_round_trip(spark):
    rows, frame = pages(spark)
    payload = [(r[2] or "").encode() for r in rows]
    keep = {}
    for r, p in zip(rows, payload):
        if len(p) >= 1000 and r[0] is not None:
            keep[p] = max(keep.get(p, -1), r[0])
    expected = []
    for r, p in zip(rows, payload):
        again = r[0] is not None and keep.get(p, r[0]) > r[0]
        expected.append((r[0], len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", keep[p] if again else None))
    path = f"{scratch_folder(spark)}/archive-test"
    warc.write_archives(frame, path)
    found = warc.read_archives(spark, path).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == sorted(expected, key=repr)
    assert sorted(bytes(r["payload"]) for r in found) == sorted(payload)
    raw = b"".join(gzip.decompress(bytes(r["content"])) for r in spark.read.format("binaryFile").load(path).collect())
    assert raw.count(b"WARC-Type: revisit") == sum(e[3] == "revisit" for e in expected)
    assert b"\nX: y" not in raw
    assert warc.archived(frame.limit(0)).count() == 0


def test_planes_round_trip():
    rng = np.random.default_rng(0)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        for kind in ("bit", "byte"):
            assert (tp.from_planes(tp.to_planes(ids, kind), n) == ids).all()


def test_checksums_join():
    rng = np.random.default_rng(1)
    parts = [rng.bytes(n) for n in (1, 4, 100, 70_000)]
    assert tp.crc_joined([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("kind, size", [("byte", 1 << 16), ("bit", 100)])
def test_token_files_round_trip(spark, docs, rows, kind, size):
    tokenizer = Tokenizer.from_file(WORDS)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    ids = [np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4") for r in order]
    starts = np.cumsum([len(i) for i in ids]) - [len(i) for i in ids]
    path = f"{scratch_folder(spark)}/ids-test-{kind}"
    tp.write_ids(docs, path, WORDS, size=size, kind=kind)
    found = tp.read_documents(spark, path).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], bytes(r["ids"])) for r in found] == [(r[0], s, i.tobytes()) for r, s, i in zip(order, starts, ids)]
    digests = tp.document_digests(spark, path).orderBy("start").collect()
    assert [tuple(d) for d in digests] == [(r[0], s, len(i), zlib.crc32(i.tobytes())) for r, s, i in zip(order, starts, ids)]
    index = spark.read.parquet(f"{path}/index").orderBy("first_id").collect()
    assert sum(r["n_ids"] for r in index) == sum(map(len, ids)) and all(len(r["plane_bytes"]) == (32 if kind == "bit" else 4) for r in index)


def test_long_texts_are_not_encoded_together(monkeypatch):
    seen, encode = [], tp.encode
    monkeypatch.setattr(tp, "encode", lambda texts, *rest: (seen.append(sum(len(t or "") for t in texts.to_pylist())), encode(texts, *rest))[1])
    monkeypatch.setattr(tp, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [None, *(sentence(i, 20) + " x" * 1_000_000 for i in range(7)), "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    rows = [r for out in tp._chunks(WORDS, 2, 1 << 16, "byte")([batch]) for r in out.to_pylist()]
    assert sum(seen) == sum(len(t or "") for t in texts) and max(seen) < 9_000_000
    ids = np.concatenate([tp.from_planes(r["planes"], r["n_ids"]) for r in rows])
    known = Tokenizer.from_file(WORDS)
    assert ids.tolist() == [i for t in texts for i in [*known.encode(t or "", add_special_tokens=False).ids, 2]]


def test_parts_and_words_encoded_in_pieces(monkeypatch, rows):
    texts = [r[1] for r in rows]
    monkeypatch.setattr(tp, "AT_ONCE", 3)
    tp.known_parts(WORDS).clear()
    ids, ends = tp.encode(texts, WORDS, 2)
    known = Tokenizer.from_file(WORDS)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [[*known.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_token_files_of_nothing(no_docs):
    assert tp.stored(no_docs, WORDS).count() == 0


def test_pieces_match_the_model(spark, docs, rows, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = pl.encode(docs, PIECES).cache()
    found = sorted(((r["doc_id"], r["n_pieces"], tuple(r["ids"])) for r in encoded.collect()), key=repr)
    expected = [(r[0], tuple(model.encode(r[1] or ""))) for r in rows]
    assert found == sorted(((d, len(i), i) for d, i in expected), key=repr)
    texts = sorted(r["text"] for r in pl.decode(encoded, PIECES).collect())
    assert texts == sorted((r[1] or "").replace("▁", " ") for r in rows)
    assert pl.encode(no_docs, PIECES).count() == 0


def test_heap_and_fold_merge_alike(spark):
    priorities = pl.model(PIECES)[0]
    words = ["▁" + w for w in sentence(8, 60).split()] + ["▁▁▁x", "ab" * 16, "日本語のテキスト", "▁#", "aaaaaaaaaaa"]
    frame = spark.createDataFrame([(w,) for w in words + words[:3]], "word string")
    folded = {r["word"]: [r["word"][i:j] for i, j in zip(r["borders"], r["borders"][1:])] for r in pl.fold_words(frame, PIECES).collect()}
    for word in words:
        assert folded.get(word, list(word)) == pl.merged(word, priorities)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert pl.merged("▁" + "ab" * 400, priorities) == model.encode("ab" * 400, out_type=str)


def brute(vectors, queries, k):
    found = []
    for q, x in queries:
        scored = {}
        for i, y in vectors:
            if i != q and len(x) == len(y):
                score = 0.0
                for a, b in zip(x, y):
                    score += a * b
                scored[i] = max(score, scored.get(i, -np.inf))
        best = sorted(scored.items(), key=lambda s: (-s[1], s[0]))[:k]
        found += [(q, r + 1, i, s) for r, (i, s) in enumerate(best)]
    return sorted(found)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=8)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(200)]  # a third of all rows are one vector
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [None] + [1.0] * 7), (604, [float("nan")] * 8), (605, [float("inf")] * 8),
             (606, [1.0, 2.0]), (620, [2.0, 1.0]), (None, rows[1][1]), rows[7], (7, rows[8][1])]
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int").repartition(5)


@pytest.mark.parametrize("leaf", [4, 256])
def test_exact_search_matches_brute_force(vectors, monkeypatch, leaf):
    monkeypatch.setattr(vt.Tree.__init__, "__defaults__", (leaf,))
    monkeypatch.setattr(vt, "SHARD_ROWS", 150)
    monkeypatch.setattr(vt, "BLOCK_ROWS", 10)
    good = vt.usable(vectors, "vec_id", "embedding").collect()
    points = [(r["id"], r["vector"]) for r in good]
    found = vt.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=5, factor=1.0).collect()
    expected = brute(points, sorted({(i, tuple(v)) for i, v in points if i % 20 == 0}), 5)
    assert sorted(tuple(r) for r in found) == expected
    assert not {600, 601, 602, 603, 604, 605} & {r["vec_id"] for r in found}
    assert vt.nearest(vectors.limit(0), vectors, k=5).count() == 0


def test_relaxed_search_keeps_recall(spark):
    """Production factor and sizes of the query, on vectors of as many dimensions."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree, queries = vt.Tree(x), x[::20]
    _, rows = tree.search(queries, 21, 2.0)
    true = np.argsort(-(queries @ x.T), axis=1)[:, :21]
    assert np.mean([len(set(a) & set(b)) / 21 for a, b in zip(rows, true)]) >= 0.9


def test_pruning_leaves_subtrees_out():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 2))
    tree = vt.Tree(x, leaf=16)
    _, exact = tree.search(x[:20], 3, 1.0)
    true = np.argsort(((x[:20, None] - x[None]) ** 2).sum(-1), axis=1)[:, :3]
    assert all(set(a) == set(b) for a, b in zip(exact, true))
    _, loose = tree.search(x[:20], 3, 50.0)
    assert sum(set(a) != set(b) for a, b in zip(loose, true)) > 0
