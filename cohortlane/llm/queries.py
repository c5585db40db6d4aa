"""Registered queries of the operators for training text, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlane.llm import fingerprints, hard_negatives, jaccard_join, language_model, piece_lattice, quality_rules as quality, repeated_bytes
from cohortlane.llm import source_mixing, spelling_variants, token_planes, url_filter, vantage_trees, warc

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def register(make):
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_quality_rules", quality.oracle())
def op6(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query("op3_url_filter", url_filter.oracle())
def op3(spark, sf_dir):
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


@query("op9_warc_revisits", warc.ORACLE)
def op9(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_vantage_trees", vantage_trees.ORACLE)
def op10(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vantage_trees.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20, factor=2.0)


@query("op8_token_planes")
def op8(spark, sf_dir):
    return token_planes.stored(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_source_mixing")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", source_mixing.token_count(F.col("text")).alias("n_tokens"))
    return source_mixing.draws(docs, source_mixing.mixture(docs)).select(
        "doc.doc_id", "doc.source", "doc.n_tokens", "epoch", "block", "block_key", "doc_key")


@query("op2_whole_vocabulary", language_model.ORACLE)
@query("op2_stupid_backoff", language_model.ORACLE)
def op2(spark, sf_dir):
    return language_model.backoff_scores(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join")
def op4(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_prefix_free_parsing")
def op5(spark, sf_dir):
    return repeated_bytes.without_repeats(table(spark, sf_dir, "documents"))


@query("op7_piece_lattice")
def op7(spark, sf_dir):
    return piece_lattice.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_hard_negatives", hard_negatives.ORACLE)
def op11(spark, sf_dir):
    rows = hard_negatives.scaled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 50 == 0)


@query("op12_scaled_sketch")
def op12(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    return spelling_variants.variants(spelling_variants.spelled(table(spark, sf_dir, "documents")))
