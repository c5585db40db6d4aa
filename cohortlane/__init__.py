"""Matched case-control studies over OMOP-shaped tables, as Spark DataFrame operators."""

from .config import (
    CategoryGroup,
    CharacteristicSpec,
    ConceptSet,
    ConditionFeature,
    MatchSpec,
    MeasurementFeature,
    ModelSpec,
    Predicate,
    PublicationSpec,
    ReportRequirement,
    ReportSpec,
    StudySpec,
    SurveyFeature,
)
from .errors import DataContractError, SpecError

__all__ = [
    "CategoryGroup",
    "CharacteristicSpec",
    "ConceptSet",
    "ConditionFeature",
    "DataContractError",
    "MatchSpec",
    "MeasurementFeature",
    "ModelSpec",
    "Predicate",
    "PublicationSpec",
    "ReportRequirement",
    "ReportSpec",
    "SpecError",
    "StudySpec",
    "SurveyFeature",
]

# Functions used inside tasks travel with the job, so executors need no copy of this package.
import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
