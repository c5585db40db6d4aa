"""A study from source tables to a screened report, one explicit stage after another."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..config import ReportSpec, StudySpec, default_report_spec
from ..errors import DataContractError
from ..operators.cohorts import build_cohorts, cases_and_controls, flow_counts
from ..operators.features import extract_features, resolve_study, unique_people
from ..operators.matching import MatchLimits, MatchResult, match_groups
from ..operators.models import fit_models
from ..operators.provenance import method_rows, methods_frame
from ..operators.release import (
    Report, publication_associations, publication_characteristics, publication_flow,
)
from ..operators.screening import (
    full_flow, screened_associations, screened_balance, screened_characteristics, screened_flow,
    screened_group_sizes, SUPPRESSED,
)
from ..operators.summaries import characteristics, group_sizes
from ..session import cut
from ..sources.omop import OmopSource
from ..sources.store import FrameStore, fingerprint, load_snapshot, save_snapshot, write_csv, write_json_records

# The association fields a saved report keeps; fit diagnostics stay private.
REPORTED = (
    "model", "predictor", "primary", "status", "odds_ratio", "ci_lower", "ci_upper", "p_value", "p_holm",
    "cases_analyzed", "controls_analyzed", "sets_analyzed", "case_with_condition", "control_with_condition",
    "suppressed",
)


def build_report(
    matched: MatchResult, results: DataFrame, flow: DataFrame, study: StudySpec, spec: ReportSpec | None = None,
    trail: tuple = (),
) -> Report:
    """Summaries, associations, flow and balance, screened before anything is formatted.

    ``trail`` are further (stage, item, value) rows of what a run did, added to what the definitions fix.
    """
    content = spec or default_report_spec(study)
    labels = {**study.labels, **{k: i.label for k, i in content.characteristics.items() if i.label}}
    predictors = sorted({p for model in study.models for p in model.predictors})
    people = cut(screened_characteristics(characteristics(matched.members, study, content)))
    associations = cut(screened_associations(results, matched.members, predictors).select(*REPORTED))
    sizes = screened_group_sizes(group_sizes(matched.members)).collect()
    return Report(
        tables={
            "characteristics": publication_characteristics(people, labels),
            "associations": publication_associations(associations, study.labels),
            "flow": publication_flow(screened_flow(full_flow(flow, matched.summary))),
            "balance": screened_balance(matched.balance, matched.summary),
        },
        screened={"characteristics": people, "associations": associations},
        metadata={
            "study_id": study.study_id,
            "protocol_version": study.version,
            "labels": labels,
            "report_spec": content.to_dict(),
            "report_spec_hash": content.digest(),
            "group_sizes": {r["group"]: SUPPRESSED if r["suppressed"] else r["n"] for r in sizes},
            "age_reference_date": str(study.age_reference_date),
            "clinical_cutoff": str(study.clinical_cutoff),
            "dataset": study.dataset,
        },
        methods=methods_frame(people.sparkSession, [*method_rows(study, content), *trail]),
    )


#: Prefix of the display tables in a saved report; screened tables keep their names.
SHOWN = "shown_"


def save_report(spark: SparkSession, directory: str, report: Report) -> str:
    """Save every table of a report, its methods and review status in one snapshot."""
    if report.methods is None:
        raise DataContractError("A report is saved with its methods.")
    tables = {**report.screened, **{SHOWN + name: t for name, t in report.tables.items()}, "methods": report.methods}
    return save_snapshot(spark, directory, tables, report.metadata)


def load_report(spark: SparkSession, directory: str) -> Report:
    """The last saved report of a folder, as it was; an error if anything in it changed."""
    tables, metadata = load_snapshot(spark, directory)
    methods = tables.pop("methods", None)
    if methods is None:
        raise DataContractError("The saved report has no methods.")
    shown = {name.removeprefix(SHOWN): t for name, t in tables.items() if name.startswith(SHOWN)}
    screened = {name: t for name, t in tables.items() if not name.startswith(SHOWN)}
    return Report(tables=shown, screened=screened, metadata=metadata, methods=methods)


class StudyRun:
    """Runs the stages in order and keeps each stage's frame in a store under ``directory``."""

    def __init__(self, spark: SparkSession, study: StudySpec, directory: str, *, synthetic: bool = False):
        self.spark, self.study, self.directory, self.synthetic = spark, study, directory, synthetic
        self.store = FrameStore(spark, f"{directory}/private")
        self.features = self.classified = self.matched = self.results = self.feature_hash = None
        self.trail: list[tuple[str, str, str]] = []
        self._freeze()

    def _freeze(self) -> None:
        """A run directory belongs to one configuration."""
        entry = self.store.entry("specification")
        if entry is None:
            row = [(json.dumps(self.study.to_dict(), sort_keys=True),)]
            self.store.save("specification", self.spark.createDataFrame(row, "study string"), self.study.to_dict())
        elif self.store.load("specification", self.study.to_dict()) is None:
            raise DataContractError("This directory holds another study; use a new version and directory.")

    def extract(self, source: OmopSource, *, reuse: bool = True) -> DataFrame:
        resolved = resolve_study(source, self.study)
        identity = {
            "extraction": self.study.extraction_digest(),
            "vocabulary": {name: fingerprint(frame) for name, frame in resolved.items()},
        }
        kept = self.store.load("features", identity) if reuse else None
        origin = "extracted" if kept is None else "stored by an earlier run of the same definitions"
        if kept is None:
            kept = self.store.save("features", extract_features(source, self.study, resolved), identity)
        return self._take(unique_people(kept), origin)

    def use_features(self, features: DataFrame) -> DataFrame:
        """Start from a given feature frame instead of a source; only for synthetic runs."""
        if not self.synthetic:
            raise DataContractError("Only a synthetic run may be given its features.")
        return self._take(unique_people(cut(features)), "given to a synthetic run")

    def reuse_features(self, other: StudyRun) -> DataFrame:
        """Take another run's features if they were extracted by the same definitions and are unchanged."""
        same = self.study.extraction_digest() == other.study.extraction_digest()
        if other.features is None or not same or self.synthetic != other.synthetic:
            raise DataContractError("Features are reused only between identical extractions.")
        if fingerprint(other.features) != other.feature_hash:
            raise DataContractError("The other run's features changed after extraction.")
        return self._take(other.features, f"taken from version {other.study.version}")

    def _take(self, features: DataFrame, origin: str) -> DataFrame:
        self.features, self.feature_hash = features, fingerprint(features)
        self.trail = [("features", "origin", origin), ("features", "content", self.feature_hash)]
        return features

    def build_groups(self) -> DataFrame:
        if self.features is None:
            raise DataContractError("Extract features first.")
        self.classified = cut(build_cohorts(self.features, self.study, checked=True))
        return self.classified

    def match(self, *, limits: MatchLimits = MatchLimits()) -> MatchResult:
        if self.classified is None:
            raise DataContractError("Build the groups first.")
        people = cases_and_controls(self.classified)
        self.matched = match_groups(people, self.study.matching, limits=limits, checked=True, stored=True)
        identity = {"study": self.study.digest(), "features": self.feature_hash}
        self.matched.members = self.store.save("members", self.matched.members, identity)
        self.matched.unmatched = self.store.save("unmatched", self.matched.unmatched, identity)
        self.matched.balance = self.store.save("balance", self.matched.balance, identity)
        return self.matched

    def analyze(self) -> DataFrame:
        if self.matched is None:
            raise DataContractError("Match the groups first.")
        self.results = cut(fit_models(self.matched.members, self.study.models))
        write_json_records(self.results, f"{self.directory}/private/model_results")
        return self.results

    def report(self, spec: ReportSpec | None = None) -> Report:
        if self.results is None:
            raise DataContractError("Fit the models first.")
        trail = [*self.trail, ("models", "fitted to members", fingerprint(self.matched.members))]
        report = build_report(
            self.matched, self.results, flow_counts(self.classified), self.study, spec, tuple(trail))
        report.metadata["synthetic"] = self.synthetic
        save_report(self.spark, f"{self.directory}/review/snapshot", report)
        for name, table in report.tables.items():
            write_csv(table, f"{self.directory}/review/{name}")
        return report
