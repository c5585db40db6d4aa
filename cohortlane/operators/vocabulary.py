"""Concept sets, survey codes and units resolved against the vocabulary tables.

All concept sets of a study are resolved together as one long table keyed by set; sets with the same
definition are resolved once. What is broadcast by hint is made from the configuration; resolved seeds are
written first, so Catalyst knows their size when it chooses the joins that follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import ConceptSet, MeasurementFeature, SurveyFeature
from ..errors import DataContractError
from ..session import cut, local_rows
from ..sources.omop import CONTRACT, OmopSource

RECORD = CONTRACT["concept"]


def _literal(source: OmopSource, rows: list, schema: str) -> DataFrame:
    return F.broadcast(local_rows(source.spark, rows, schema))


def _fail_on(problems: DataFrame, what: str) -> None:
    found = problems.limit(21).collect()
    if found:
        more = " and more" if len(found) > 20 else ""
        raise DataContractError(f"{what}: {[tuple(r) for r in found[:20]]}{more}")


def concept_seeds(source: OmopSource, sets: dict[str, ConceptSet]) -> DataFrame:
    """(set_key, concept record) for every concept named by id, or by code in the set's vocabulary."""
    concept = source.table("concept")
    ids = [(key, i) for key, s in sets.items() for i in s.ids]
    codes = [(key, s.vocabulary, c) for key, s in sets.items() for c in s.codes]
    by_id = concept.join(_literal(source, ids, "set_key string, concept_id long"), "concept_id")
    by_code = concept.join(
        _literal(source, codes, "set_key string, vocabulary_id string, concept_code string"),
        ["vocabulary_id", "concept_code"],
    )
    columns = ["set_key", *RECORD]
    return by_id.select(*columns).unionByName(by_code.select(*columns)).distinct()


def seed_problems(source: OmopSource, sets: dict[str, ConceptSet], seeds: DataFrame) -> DataFrame:
    """Requested ids or codes that are absent, and seeds that are not usable."""
    ids = [(key, i) for key, s in sets.items() for i in s.ids]
    codes = [(key, s.vocabulary, c) for key, s in sets.items() for c in s.codes]
    absent_ids = local_rows(source.spark, ids, "set_key string, concept_id long").join(
        seeds, ["set_key", "concept_id"], "left_anti"
    )
    absent_codes = local_rows(source.spark, 
        codes, "set_key string, vocabulary_id string, concept_code string"
    ).join(seeds, ["set_key", "vocabulary_id", "concept_code"], "left_anti")
    rules = _literal(
        source,
        [(key, s.domain, s.require_standard) for key, s in sets.items()],
        "set_key string, wanted string, standard_only boolean",
    )
    unusable = seeds.join(rules, "set_key").select(
        "set_key",
        F.col("concept_id").cast("string").alias("item"),
        F.when(F.col("invalid_reason").isNotNull(), "invalid")
        .when(~F.col("domain_id").eqNullSafe(F.col("wanted")), "wrong domain")
        .when(F.col("standard_only") & ~F.col("standard_concept").eqNullSafe(F.lit("S")), "not standard")
        .alias("problem"),
    )
    return (
        absent_ids.select("set_key", F.col("concept_id").cast("string").alias("item"))
        .unionByName(absent_codes.select("set_key", F.col("concept_code").alias("item")))
        .withColumn("problem", F.lit("absent"))
        .unionByName(unusable.filter(F.col("problem").isNotNull()))
    )


def expand_concepts(source: OmopSource, sets: dict[str, ConceptSet], seeds: DataFrame) -> DataFrame:
    """Seeds, their descendants where asked for, then the restrictions of each set.

    Restrictions follow the expansion: excluding a concept leaves its descendants in.
    """
    spark = source.spark
    start = seeds.select("set_key", "concept_id")
    widened = [key for key, s in sets.items() if s.descendants]
    descendants = (
        source.table("concept_ancestor")
        .join(
            start.filter(F.col("set_key").isin(widened)).withColumnRenamed("concept_id", "ancestor_concept_id"),
            "ancestor_concept_id",
        )
        .select("set_key", F.col("descendant_concept_id").alias("concept_id"))
    )
    members = start.unionByName(descendants).distinct()
    rules = _literal(
        source,
        [(key, s.domain, s.require_standard) for key, s in sets.items()],
        "set_key string, domain_id string, standard_only boolean",
    )
    excluded = local_rows(spark, 
        [(key, i) for key, s in sets.items() for i in s.exclude_ids], "set_key string, concept_id long"
    )
    return (
        source.table("concept")
        .filter("invalid_reason is null")
        .join(members, "concept_id")
        .join(rules, ["set_key", "domain_id"])
        .filter(~F.col("standard_only") | F.col("standard_concept").eqNullSafe(F.lit("S")))
        .join(F.broadcast(excluded), ["set_key", "concept_id"], "left_anti")
        .select("set_key", *RECORD)
        .distinct()
    )


def resolve_concepts(source: OmopSource, features: dict[str, ConceptSet]) -> DataFrame:
    """(feature, concept record) for all features in one long table, checked and materialised."""
    keys = {name: definition.digest() for name, definition in features.items()}
    sets = {keys[name]: definition for name, definition in features.items()}
    seeds = cut(concept_seeds(source, sets))
    _fail_on(seed_problems(source, sets, seeds), "Seed concepts cannot be used")
    wanted = local_rows(source.spark, [(k,) for k in sets], "set_key string")
    members = cut(expand_concepts(source, sets, seeds))
    _fail_on(wanted.join(members, "set_key", "left_anti"), "Concept sets left empty by their restrictions")
    names = _literal(source, [(n, k) for n, k in keys.items()], "feature string, set_key string")
    return members.join(names, "set_key").select("feature", *RECORD)


def resolve_units(source: OmopSource, features: dict[str, MeasurementFeature]) -> DataFrame:
    """(feature, concept_id, concept_code, valid) of the accepted units; every code must exist and be valid."""
    rows = [(n, f.unit_vocabulary, c) for n, f in features.items() for c in f.unit_codes]
    wanted = local_rows(source.spark, rows, "feature string, vocabulary_id string, concept_code string")
    units = cut(
        source.table("concept")
        .join(F.broadcast(wanted), ["vocabulary_id", "concept_code"])
        .select(
            "feature", "vocabulary_id", "concept_id", "concept_code",
            F.col("invalid_reason").isNull().alias("valid"),
        )
    )
    absent = wanted.join(units.filter("valid"), ["feature", "vocabulary_id", "concept_code"], "left_anti")
    _fail_on(absent, "Unknown measurement units")
    return units


def survey_records(source: OmopSource, surveys: dict[str, SurveyFeature]) -> DataFrame:
    """Concepts a survey definition names, by id or case-insensitively by code in its vocabulary."""
    concept = source.table("concept").withColumn("code", F.lower("concept_code"))
    ids = [(n, i) for n, s in surveys.items() for i in sorted(s.ids())]
    codes = [(n, s.vocabulary, c) for n, s in surveys.items() for c in sorted(s.codes())]
    by_id = concept.join(_literal(source, ids, "feature string, concept_id long"), "concept_id")
    by_code = concept.join(
        _literal(source, codes, "feature string, vocabulary_id string, code string"), ["vocabulary_id", "code"]
    )
    columns = ["feature", "code", *RECORD]
    return by_id.select(*columns).unionByName(by_code.select(*columns)).distinct()


def survey_problems(source: OmopSource, surveys: dict[str, SurveyFeature], records: DataFrame) -> DataFrame:
    spark = source.spark
    ids = [(n, i) for n, s in surveys.items() for i in sorted(s.ids())]
    codes = [(n, s.vocabulary, c) for n, s in surveys.items() for c in sorted(s.codes())]
    vocabularies = _literal(
        source, [(n, s.vocabulary) for n, s in surveys.items()], "feature string, vocabulary_id string"
    )
    in_vocabulary = records.join(vocabularies, ["feature", "vocabulary_id"])
    absent_ids = local_rows(spark, ids, "feature string, concept_id long").join(
        records, ["feature", "concept_id"], "left_anti"
    )
    absent_codes = local_rows(spark, codes, "feature string, vocabulary_id string, code string").join(
        records, ["feature", "vocabulary_id", "code"], "left_anti"
    )
    ambiguous = in_vocabulary.groupBy("feature", "code").count().filter("count > 1")

    def rows(frame, item, problem):
        return frame.select(
            "feature", F.col(item).cast("string").alias("item"), F.lit(problem).alias("problem")
        )

    return (
        rows(absent_ids, "concept_id", "absent")
        .unionByName(rows(absent_codes, "code", "absent"))
        .unionByName(rows(ambiguous, "code", "ambiguous"))
        .unionByName(rows(records.filter("invalid_reason is not null"), "concept_id", "invalid"))
    )


def resolve_surveys(source: OmopSource, surveys: dict[str, SurveyFeature]) -> DataFrame:
    """(feature, question_id, positive, negative, threshold): one row per question of each feature."""
    spark = source.spark
    records = cut(survey_records(source, surveys))
    _fail_on(survey_problems(source, surveys, records), "Survey concepts cannot be used")
    vocabularies = _literal(
        source, [(n, s.vocabulary) for n, s in surveys.items()], "feature string, vocabulary_id string"
    )
    lookup = F.broadcast(
        records.join(vocabularies, ["feature", "vocabulary_id"]).select("feature", "code", "concept_id")
    )
    by_id, by_code, limits_id, limits_code = [], [], [], []
    for name, s in surveys.items():
        for polarity, mapping in (("positive", s.positive), ("negative", s.negative)):
            by_id += [(name, q, a, polarity) for q, answers in mapping.items() for a in answers]
        for polarity, mapping in (("positive", s.positive_codes), ("negative", s.negative_codes)):
            by_code += [
                (name, q.lower(), a.lower(), polarity) for q, answers in mapping.items() for a in answers
            ]
        limits_id += [(name, q, v) for q, v in s.numeric_positive_above.items()]
        limits_code += [(name, q.lower(), float(v)) for q, v in s.numeric_positive_codes.items()]
    question = lookup.select("feature", F.col("code").alias("question"), F.col("concept_id").alias("question_id"))
    answer = lookup.select("feature", F.col("code").alias("answer"), F.col("concept_id").alias("answer_id"))
    answers = (
        local_rows(spark, by_id, "feature string, question_id long, answer_id long, polarity string")
        .unionByName(
            local_rows(spark, by_code, "feature string, question string, answer string, polarity string")
            .join(question, ["feature", "question"])
            .join(answer, ["feature", "answer"])
            .select("feature", "question_id", "answer_id", "polarity")
        )
        .distinct()
    )
    clash = answers.groupBy("feature", "question_id", "answer_id").count().filter("count > 1")
    _fail_on(clash, "Survey answers mapped both ways")
    limits = (
        local_rows(spark, limits_id, "feature string, question_id long, threshold double")
        .withColumn("rank", F.lit(0))
        .unionByName(
            local_rows(spark, limits_code, "feature string, question string, threshold double")
            .join(question, ["feature", "question"])
            .select("feature", "question_id", "threshold", F.lit(1).alias("rank"))
        )
        .groupBy("feature", "question_id")
        .agg(F.max_by("threshold", "rank").alias("threshold"))
    )
    grouped = answers.groupBy("feature", "question_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("polarity") == "positive", F.col("answer_id")))).alias("positive"),
        F.sort_array(F.collect_list(F.when(F.col("polarity") == "negative", F.col("answer_id")))).alias("negative"),
    )
    empty = F.array().cast("array<bigint>")
    return cut(
        grouped.join(limits, ["feature", "question_id"], "full").select(
            "feature", "question_id",
            F.coalesce("positive", empty).alias("positive"),
            F.coalesce("negative", empty).alias("negative"),
            "threshold",
        )
    )
