"""What the stages of a study did, as rows that travel with its report.

Each stage states its choices as (stage, item, value); nothing in a row is counted from people. A review is a row
as well, so a report that nobody looked at says so. Coverage counts methods as present only where both are found.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import ReportSpec, StudySpec
from ..errors import DataContractError
from ..session import local_rows

SCHEMA = "seq int, stage string, item string, value string"
REVIEW = "review"
NOT_REVIEWED = "not reviewed"


def _shown(value) -> str:
    if hasattr(value, "to_dict"):
        value = value.to_dict()
    return value if isinstance(value, str) else json.dumps(value, sort_keys=True, default=str)


def method_rows(study: StudySpec, content: ReportSpec) -> list[tuple[str, str, str]]:
    """(stage, item, value) of everything the definitions fix, in the order of the stages."""
    rows = [("study", "identity", study.study_id), ("study", "version", study.version)]
    rows += [
        ("features", "age at", str(study.age_reference_date)), ("features", "records up to", str(study.clinical_cutoff)),
        ("features", "definition", study.extraction_digest()),
        ("groups", "case", _shown(study.case)), ("groups", "control", _shown(study.control)),
        ("groups", "least age at the cutoff", _shown(study.minimum_age)),
    ]
    plan = study.matching
    distance = "difference" if len(plan.distance) == 1 and plan.distance[0] not in plan.categorical else "Mahalanobis"
    rows += [
        ("matching", "distance", "difference in the logit" if plan.method == "propensity" else distance),
        ("matching", "distance columns", _shown(list(plan.distance))), ("matching", "equal columns", _shown(list(plan.exact))),
        ("matching", "calipers", _shown(plan.calipers)), ("matching", "controls a case", f"{plan.minimum_controls} to {plan.ratio}"),
        ("matching", "controls used again", _shown(plan.replace)),
        ("matching", "order", "cases by id, all first controls before second ones, equal distances to the smaller id"),
        ("balance", "unit", "standard deviation of the cases of the full valid pool, before and after"),
    ]
    for model in study.models:
        rows.append(("models", model.name, _shown({
            "method": model.method, "predictors": model.predictors, "covariates": model.covariates,
            "categorical": model.categorical, "family": model.family, "primary": model.primary,
            "restriction": model.restriction.to_dict() if model.restriction else None,
        })))
    for name, item in content.characteristics.items():
        rows.append(("summaries", name, _shown(item)))
    rows.append(("screening", "content definition", content.digest()))
    return rows


def methods_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """The rows numbered in the order given, ended by a review that is still to come."""
    numbered = [(i, *row) for i, row in enumerate([*rows, (REVIEW, "status", NOT_REVIEWED)])]
    return local_rows(spark, numbered, SCHEMA)


def reviewed(methods: DataFrame, status: str, reviewer: str) -> DataFrame:
    """The same methods under a new review status; earlier review rows are replaced."""
    if not status.strip() or not reviewer.strip():
        raise DataContractError("A review has a status and a reviewer.")
    kept = methods.filter(F.col("stage") != REVIEW)
    last = (methods.agg(F.max("seq")).first()[0] or 0) + 1
    rows = [(last, REVIEW, "status", status.strip()), (last + 1, REVIEW, "reviewer", reviewer.strip())]
    return kept.unionByName(local_rows(methods.sparkSession, rows, SCHEMA))


def methods_present(methods: DataFrame) -> DataFrame:
    """(item): "methods" if a stage states anything, "review" if a status is stated; blank values state nothing."""
    stated = methods.filter(F.trim(F.coalesce("value", F.lit(""))) != "")
    status = (F.col("stage") == REVIEW) & (F.col("item") == "status")
    item = F.when(status, "review").when(F.col("stage") != REVIEW, "methods")
    return stated.select(item.alias("item")).filter("item is not null").distinct()
