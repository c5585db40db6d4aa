"""From raw documents to token ids: the stages of the corpus pipeline, each over all that the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlane.llm import jaccard_join, piece_lattice, repeated_bytes, source_mixing
from cohortlane.llm import quality_rules as quality
from cohortlane.session import scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that break a rule go."""
    return quality.keep_good(docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near copies one row stays, that with the smallest id; repeated rows are near copies too."""
    return jaccard_join.keep_one_row(docs)


def suffix_arrays(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: byte strings that occur twice are cut out of the texts."""
    return repeated_bytes.remove_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document is drawn at least once, those of small sources up to twice as often."""
    return source_mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the piece ids of every drawn document."""
    return piece_lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard),
    ("suffix-array dedup", suffix_arrays),
    ("source mixing", mixing),
    ("SentencePiece encoding", pieces),
]

#: Groups of near copies, byte strings and the tokenizer's merges are beyond plain SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
