"""Study definitions: frozen dataclasses, checked when they are built.

Only configuration lives here; nothing in this module touches a DataFrame.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import json
import math
import re
from dataclasses import dataclass, field
from typing import Any

from .errors import SpecError

NAME = re.compile(r"^[a-z][a-z0-9_]*$")

# The vocabulary domains, comparison operators and column names a study may not reuse.
DOMAINS = ("Condition", "Measurement", "Observation", "Drug", "Procedure")
OPERATORS = ("eq", "ne", "ge", "gt", "le", "lt", "in", "not_in", "is_missing", "not_missing")
RESERVED = (
    "person_id", "is_case", "age", "age_at_cutoff", "birth_date", "sex_at_birth", "race", "ethnicity",
    "ehr_days", "ehr_record_count", "match_set_id", "weight",
)
SUMMARIES = ("n_percent", "mean_sd", "median_iqr", "missing")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise SpecError(message)


def _unique(values) -> bool:
    values = list(values)
    return len(set(values)) == len(values)


def _date(value) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _build(cls, value):
    """Accept an instance or a plain mapping; unknown keys are an error."""
    if value is None or isinstance(value, cls):
        return value
    known = {f.name for f in dataclasses.fields(cls)}
    extra = set(value) - known
    _require(not extra, f"Unknown {cls.__name__} keys: {sorted(extra)}")
    return cls(**value)


def _names(cls, mapping) -> dict:
    for name in mapping:
        _require(bool(NAME.match(name)), f"Not a valid feature name: {name!r}")
    return {name: _build(cls, item) for name, item in mapping.items()}


class Spec:
    """Freezing and serialising shared by every definition."""

    def _set(self, **values) -> None:
        for name, value in values.items():
            object.__setattr__(self, name, value)

    @classmethod
    def from_dict(cls, value: dict):
        return _build(cls, value)

    def to_dict(self) -> dict:
        return json.loads(json.dumps(dataclasses.asdict(self), default=str))

    def digest(self) -> str:
        return config_digest(self.to_dict())


def config_digest(value: Any) -> str:
    text = json.dumps(value, sort_keys=True, default=str, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class ConceptSet(Spec):
    ids: tuple = ()
    codes: tuple = ()
    vocabulary: str = "SNOMED"
    domain: str = "Condition"
    descendants: bool = True
    exclude_ids: tuple = ()
    require_standard: bool = True

    def __post_init__(self):
        self._set(ids=tuple(self.ids), codes=tuple(self.codes), exclude_ids=tuple(self.exclude_ids))
        _require(bool(self.ids or self.codes), "A concept set without ids or codes selects nothing.")
        _require(all(i > 0 for i in self.ids + self.exclude_ids), "Concept ids are positive integers.")
        _require(self.domain in DOMAINS, f"Unknown domain {self.domain!r}")


@dataclass(frozen=True)
class ConditionFeature(Spec):
    concepts: ConceptSet
    min_distinct_dates: int = 1
    min_span_days: int = 0
    lookback_days: int | None = None

    def __post_init__(self):
        self._set(concepts=_build(ConceptSet, self.concepts))
        _require(self.concepts.domain == "Condition", "A condition feature needs Condition concepts.")
        _require(self.min_distinct_dates >= 1 and self.min_span_days >= 0, "Invalid condition thresholds.")
        _require(self.lookback_days is None or self.lookback_days >= 0, "A lookback is not negative.")


@dataclass(frozen=True)
class MeasurementFeature(Spec):
    concepts: ConceptSet
    unit_codes: tuple
    minimum: float
    maximum: float
    unit_vocabulary: str = "UCUM"
    lookback_days: int = 365

    def __post_init__(self):
        self._set(concepts=_build(ConceptSet, self.concepts), unit_codes=tuple(self.unit_codes))
        _require(self.concepts.domain == "Measurement", "A measurement feature needs Measurement concepts.")
        _require(bool(self.unit_codes), "Declare the accepted units.")
        _require(math.isfinite(self.minimum) and math.isfinite(self.maximum), "The range is finite.")
        _require(self.minimum < self.maximum, "The accepted range is empty.")
        _require(self.lookback_days >= 0, "A lookback is not negative.")


@dataclass(frozen=True)
class SurveyFeature(Spec):
    positive: dict = field(default_factory=dict)
    negative: dict = field(default_factory=dict)
    numeric_positive_above: dict = field(default_factory=dict)
    positive_codes: dict = field(default_factory=dict)
    negative_codes: dict = field(default_factory=dict)
    numeric_positive_codes: dict = field(default_factory=dict)
    vocabulary: str = "PPI"
    positive_label: str = "yes"
    negative_label: str = "no"
    unknown_label: str = "unknown"
    conflict_label: str = "conflict"

    def __post_init__(self):
        self._set(
            positive={int(q): tuple(a) for q, a in self.positive.items()},
            negative={int(q): tuple(a) for q, a in self.negative.items()},
            numeric_positive_above={int(q): float(v) for q, v in self.numeric_positive_above.items()},
            positive_codes={q: tuple(a) for q, a in self.positive_codes.items()},
            negative_codes={q: tuple(a) for q, a in self.negative_codes.items()},
        )
        rules = (
            self.positive, self.negative, self.numeric_positive_above,
            self.positive_codes, self.negative_codes, self.numeric_positive_codes,
        )
        _require(any(rules), "A survey feature needs at least one rule.")
        for question, answers in self.positive.items():
            _require(not set(answers) & set(self.negative.get(question, ())), "An answer is both yes and no.")
        for question, answers in self.positive_codes.items():
            other = {a.lower() for a in self.negative_codes.get(question, ())}
            _require(not {a.lower() for a in answers} & other, "An answer code is both yes and no.")
        _require(_unique(self.labels()), "Survey labels must differ.")

    def labels(self) -> tuple:
        return self.positive_label, self.negative_label, self.unknown_label, self.conflict_label

    def codes(self) -> set:
        found = {*self.positive_codes, *self.negative_codes, *self.numeric_positive_codes}
        for answers in (*self.positive_codes.values(), *self.negative_codes.values()):
            found.update(answers)
        return {c.lower() for c in found}

    def ids(self) -> set:
        found = {*self.positive, *self.negative, *self.numeric_positive_above}
        for answers in (*self.positive.values(), *self.negative.values()):
            found.update(answers)
        return found


@dataclass(frozen=True)
class Predicate(Spec):
    field: str | None = None
    op: str = "eq"
    value: Any = None
    all_of: tuple = ()
    any_of: tuple = ()
    negate: Predicate | None = None

    def __post_init__(self):
        value = tuple(self.value) if isinstance(self.value, list) else self.value
        self._set(
            value=value,
            all_of=tuple(_build(Predicate, p) for p in self.all_of),
            any_of=tuple(_build(Predicate, p) for p in self.any_of),
            negate=_build(Predicate, self.negate),
        )
        shapes = [self.field is not None, bool(self.all_of), bool(self.any_of), self.negate is not None]
        _require(sum(shapes) == 1, "A predicate is exactly one of field, all_of, any_of, negate.")
        _require(self.op in OPERATORS, f"Unknown predicate operator {self.op!r}")
        if self.field is not None and self.op in ("in", "not_in"):
            _require(isinstance(self.value, tuple), "Membership needs a list of values.")


@dataclass(frozen=True)
class MatchSpec(Spec):
    method: str = "nearest"
    exact: tuple = ()
    calipers: dict = field(default_factory=dict)
    distance: tuple = ("age",)
    categorical: tuple = ()
    ratio: int = 4
    minimum_controls: int = 1
    replace: bool = False
    seed: int = 20260907
    propensity_caliper: float = 0.2

    def __post_init__(self):
        self._set(
            exact=tuple(self.exact), distance=tuple(self.distance), categorical=tuple(self.categorical),
            calipers={k: float(v) for k, v in self.calipers.items()},
        )
        _require(self.method in ("nearest", "propensity"), f"Unknown matching method {self.method!r}")
        _require(1 <= self.ratio <= 20, "The ratio lies between 1 and 20.")
        _require(1 <= self.minimum_controls <= self.ratio, "minimum_controls lies between 1 and ratio.")
        _require(all(c >= 0 for c in self.calipers.values()), "A caliper is not negative.")
        _require(bool(self.distance), "Declare at least one distance column.")
        _require(not set(self.calipers) & set(self.categorical), "A categorical column has no raw caliper.")
        _require(self.propensity_caliper > 0, "The propensity caliper is positive.")

    def columns(self) -> list[str]:
        return sorted({*self.exact, *self.distance, *self.calipers})

    def numeric_columns(self) -> list[str]:
        return sorted({*self.distance, *self.calipers} - {*self.exact, *self.categorical})


@dataclass(frozen=True)
class ModelSpec(Spec):
    name: str
    predictors: tuple
    covariates: tuple = ()
    categorical: tuple = ()
    method: str = "conditional"
    primary: bool = False
    family: str = "primary"
    restriction: Predicate | None = None
    max_iterations: int = 500

    def __post_init__(self):
        self._set(
            predictors=tuple(self.predictors), covariates=tuple(self.covariates),
            categorical=tuple(self.categorical), restriction=_build(Predicate, self.restriction),
        )
        _require(bool(self.predictors) and _unique(self.predictors), "Declare distinct predictors.")
        _require(not set(self.predictors) & set(self.covariates), "A predictor is not also a covariate.")
        _require(_unique(self.covariates), "Covariates repeat.")
        _require(set(self.categorical) <= set(self.covariates), "Categorical terms are declared covariates.")
        _require(self.method in ("conditional", "firth"), f"Unknown model method {self.method!r}")
        _require(not self.primary or self.method == "conditional", "The primary model is conditional.")
        _require(self.max_iterations >= 20, "Allow at least 20 iterations.")


@dataclass(frozen=True)
class StudySpec(Spec):
    study_id: str
    version: str
    age_reference_date: dt.date
    clinical_cutoff: dt.date
    case: Predicate
    control: Predicate
    conditions: dict
    matching: MatchSpec
    models: tuple
    design: str = "matched_case_control"
    tier: str = "registered"
    dataset: str | None = None
    minimum_age: int = 18
    maximum_age: int | None = None
    eligibility: Predicate | None = None
    measurements: dict = field(default_factory=dict)
    surveys: dict = field(default_factory=dict)
    labels: dict = field(default_factory=dict)
    categorical: tuple = ("sex_at_birth", "race", "ethnicity")
    continuous: tuple = ("age",)

    def __post_init__(self):
        self._set(
            age_reference_date=_date(self.age_reference_date),
            clinical_cutoff=_date(self.clinical_cutoff),
            case=_build(Predicate, self.case),
            control=_build(Predicate, self.control),
            eligibility=_build(Predicate, self.eligibility),
            conditions=_names(ConditionFeature, self.conditions),
            measurements=_names(MeasurementFeature, self.measurements),
            surveys=_names(SurveyFeature, self.surveys),
            matching=_build(MatchSpec, self.matching),
            models=tuple(_build(ModelSpec, m) for m in self.models),
            categorical=tuple(self.categorical),
            continuous=tuple(self.continuous),
        )
        _require(self.design == "matched_case_control", "Only matched case-control studies exist.")
        _require(self.clinical_cutoff <= self.age_reference_date, "The cutoff follows the reference date.")
        _require(self.maximum_age is None or self.maximum_age >= self.minimum_age, "Empty age interval.")
        _require(bool(self.conditions), "Declare at least one condition feature.")
        names = [*self.conditions, *self.measurements, *self.surveys]
        _require(_unique(names), "A feature name is used twice.")
        _require(not set(names) & set(RESERVED), "A feature takes a reserved name.")
        _require(sum(m.primary for m in self.models) == 1, "Exactly one model is primary.")
        _require(_unique(m.name for m in self.models), "Model names repeat.")

    def extraction_digest(self) -> str:
        """Identity of everything that decides the feature rows, and nothing else."""
        fields = (
            "age_reference_date", "clinical_cutoff", "tier", "dataset", "conditions", "measurements", "surveys",
        )
        whole = self.to_dict()
        return config_digest({name: whole[name] for name in fields})


def sensitivity_spec(base: StudySpec, *, version: str, **changes) -> StudySpec:
    """The same study with changed fields, under a version of its own."""
    _require(version != base.version, "A sensitivity analysis needs its own version.")
    return dataclasses.replace(base, version=version, **changes)


@dataclass(frozen=True)
class CategoryGroup(Spec):
    label: str
    values: tuple

    def __post_init__(self):
        self._set(values=tuple(tuple(v) for v in self.values))
        _require(bool(self.label and self.values), "A category group has a label and values.")


@dataclass(frozen=True)
class CharacteristicSpec(Spec):
    fields: tuple
    kind: str = "categorical"
    label: str = ""
    groups: tuple = ()

    def __post_init__(self):
        self._set(fields=tuple(self.fields), groups=tuple(_build(CategoryGroup, g) for g in self.groups))
        _require(bool(self.fields) and _unique(self.fields), "Select each field once.")
        _require(not set(self.fields) & {"person_id", "match_set_id"}, "Identifiers are not summarised.")
        _require(self.kind in ("categorical", "binary", "continuous"), f"Unknown kind {self.kind!r}")
        if self.kind != "categorical":
            _require(len(self.fields) == 1 and not self.groups, "One field and no groups for this kind.")
        _require(_unique(g.label for g in self.groups), "Group labels repeat.")
        values = [v for g in self.groups for v in g.values]
        _require(_unique(values), "Category groups overlap.")
        _require(all(len(v) == len(self.fields) for v in values), "Give one value per field.")


@dataclass(frozen=True)
class ReportSpec(Spec):
    version: str
    characteristics: dict

    def __post_init__(self):
        items = {k: _build(CharacteristicSpec, v) for k, v in self.characteristics.items()}
        self._set(characteristics=items)
        _require(bool(self.version and items), "A report has a version and content.")


def default_report_spec(study: StudySpec) -> ReportSpec:
    categorical = {v: CharacteristicSpec(fields=(v,)) for v in study.categorical}
    continuous = {v: CharacteristicSpec(fields=(v,), kind="continuous") for v in study.continuous}
    return ReportSpec(version="default-1", characteristics={**categorical, **continuous})


@dataclass(frozen=True)
class ReportRequirement(Spec):
    study_id: str | None = None
    protocol_version: str | None = None
    characteristics: dict = field(default_factory=dict)
    associations: dict = field(default_factory=dict)
    association_columns: tuple = ("Condition", "OR", "95% CI", "P", "Cases", "Controls", "Matched sets")
    tables: dict = field(default_factory=dict)
    group_sizes: bool = False

    def __post_init__(self):
        for mapping in (self.characteristics, self.associations, self.tables):
            for key, values in mapping.items():
                _require(bool(key) and bool(values) and _unique(values), "Empty or repeated requirement.")
        for wanted in self.characteristics.values():
            _require(set(wanted) <= set(SUMMARIES), "Unknown summary name.")
        _require(set(self.tables) <= {"flow", "balance"}, "Diagnostic tables are flow and balance.")
        _require(not self.associations or bool(self.association_columns), "Select association columns.")


@dataclass(frozen=True)
class PublicationSpec(Spec):
    version: str
    reports: dict

    def __post_init__(self):
        self._set(reports={k: _build(ReportRequirement, v) for k, v in self.reports.items()})
        _require(bool(self.version and self.reports), "A publication has a version and reports.")
