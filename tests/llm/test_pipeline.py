"""The whole pipeline on a small table, against its five stages in plain Python and the model's own encoder."""

from collections import Counter

import public_tokenizers
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline as cp
from cohortlane.llm import queries, quality_rules as qr
from tests.llm.conftest import sentence
from tests.llm.test_texts import groups, repeats, words

#: Queries over texts that plain SQL cannot express; each has a test against brute force, a round trip or a library.
WITHOUT_SQL = {"op1_source_mixing", "op4_jaccard_join", "op5_prefix_free_parsing", "op7_piece_lattice", "op8_token_planes",
               "op12_scaled_sketch", "op13_spelling_variants"}


def test_queries_without_sql_are_listed():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL
    assert set(queries.QUERIES) <= set(entry.queries())


def prose(seed, n):
    return " ".join("the " + w for w in sentence(seed, n).split())


def test_run_is_the_chain_of_its_stages(spark, tmp_path):
    shared = prose(1, 60)
    texts = [prose(10 + i, 60) for i in range(12)]
    near = texts[0].split()
    near[50] = "changed"
    texts += [" ".join(near), texts[1], texts[2] + " " + shared, texts[3] + "\n" + shared, None, "", "too short", "# $ % " * 30,
              "one line again and again\n" * 30, "été ü 日本 " + prose(40, 50)]
    rows = [(i, t, "en", "ab"[i % 2], 0 if t is None else len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    found = cp.run(spark, folder).collect()

    kept = {r["doc_id"] for r in qr.quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).filter("kept").collect()}
    assert kept == {i for i, t, *_ in rows if t and len(words(t)) >= 20 and not t.startswith(("#", "one line"))}
    good = [(i, t) for i, t, *_ in rows if i in kept]
    one = groups(good)
    stay = [(i, t) for i, t in good if one[i] == i]
    assert len(stay) < len(good)
    cleaned = {i: f[4] for (i, _), f in zip(stay, repeats([t for _, t in stay]))}
    assert any(cleaned[i] != t for i, t in stay)
    drawn = Counter(r["doc_id"] for r in found)
    assert set(drawn) == set(cleaned) and max(drawn.values()) <= 2
    encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(list(r["ids"]) == encoder.encode(cleaned[r["doc_id"]]) for r in found)
