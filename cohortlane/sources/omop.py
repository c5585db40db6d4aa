"""The seven OMOP tables a study may read, and the contract they are checked against."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..config import StudySpec
from ..errors import DataContractError
from ..session import local_rows

# The columns each source table must have.
CONTRACT = {
    "person": [
        "person_id", "birth_datetime", "sex_at_birth_concept_id", "race_concept_id", "ethnicity_concept_id",
    ],
    "condition_occurrence": ["person_id", "condition_concept_id", "condition_start_date"],
    "visit_occurrence": ["person_id", "visit_start_date"],
    "concept": [
        "concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_code", "standard_concept",
        "invalid_reason",
    ],
    "concept_ancestor": ["ancestor_concept_id", "descendant_concept_id"],
    "observation": [
        "person_id", "observation_date", "observation_source_concept_id", "value_source_concept_id",
        "value_as_number", "value_as_string",
    ],
    "measurement": [
        "person_id", "measurement_concept_id", "measurement_date", "value_as_number", "unit_concept_id",
    ],
}

PROBLEMS = "table_name string, column_name string, problem string"


def allowed_types(column: str) -> tuple:
    if column.endswith(("_date", "_datetime")):
        return (T.DateType, T.TimestampType, T.TimestampNTZType)
    if column.endswith("_id") and column not in ("domain_id", "vocabulary_id"):
        return (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if column == "value_as_number":
        return (T.NumericType,)
    return (T.StringType,)


def required_tables(study: StudySpec) -> list[str]:
    optional = {"observation": study.surveys, "measurement": study.measurements}
    return sorted(t for t in CONTRACT if optional.get(t, True))


@dataclass(frozen=True)
class OmopSource:
    """Named lazy tables. Only contract tables can be read, and only their contract columns."""

    spark: SparkSession
    tables: dict

    @classmethod
    def parquet(cls, spark: SparkSession, directory: str) -> OmopSource:
        return cls(spark, {name: spark.read.parquet(f"{directory}/{name}") for name in CONTRACT})

    @classmethod
    def views(cls, spark: SparkSession, prefix: str = "") -> OmopSource:
        return cls(spark, {name: spark.table(f"{prefix}{name}") for name in CONTRACT})

    def table(self, name: str) -> DataFrame:
        if name not in CONTRACT or name not in self.tables:
            raise DataContractError(f"{name!r} is not a source table of a study.")
        return self.tables[name].select(*CONTRACT[name])

    def schema_problems(self, study: StudySpec) -> DataFrame:
        """One row per missing column or unexpected type among the tables this study needs."""
        rows = []
        for name in required_tables(study):
            frame = self.tables.get(name)
            found = {f.name: f.dataType for f in frame.schema} if frame is not None else {}
            for column in CONTRACT[name]:
                if column not in found:
                    rows.append((name, column, "missing"))
                elif not isinstance(found[column], allowed_types(column)):
                    rows.append((name, column, f"unexpected type {found[column].simpleString()}"))
        return local_rows(self.spark, rows, PROBLEMS)

    def preflight(self, study: StudySpec) -> dict:
        problems = self.schema_problems(study).collect()
        if problems:
            raise DataContractError(f"The source does not meet its contract: {[tuple(p) for p in problems]}")
        return {
            name: {f.name: f.dataType.simpleString() for f in self.table(name).schema}
            for name in required_tables(study)
        }
