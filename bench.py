"""Times the stages of the example study and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each stage is timed to the end of a full evaluation on inputs that were materialised before it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import study as st
from cohortlane import MatchSpec
from cohortlane.operators import features as ft, models as md, summaries as sm
from cohortlane.operators.cohorts import build_cohorts, flow_counts
from cohortlane.operators.matching import match_groups
from cohortlane.operators.screening import screened_characteristics
from cohortlane.session import cut


def run(frame) -> None:
    """Evaluate every row and column without moving them to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def stages(spark, sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name, make):
        start = time.perf_counter()
        result = make()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    source = timed("vocabulary_tables", lambda: st.source_of(spark, sf_dir))
    study = st.STUDY
    resolved = timed("v_resolve_study", lambda: ft.resolve_study(source, study))
    concepts = resolved["concepts"]
    measured = concepts.filter("feature = 'quantity'")
    timed("f1_conditions", lambda: run(ft.dated_evidence(source, study, concepts)))
    timed("f4_surveys", lambda: run(
        ft.reduce_surveys(ft.survey_events(source), resolved["surveys"], study.surveys, study.clinical_cutoff)))
    timed("f5_measurements", lambda: run(
        ft.reduce_measurements(ft.measurement_rows(source, study, measured, resolved["units"]), ["quantity"])))
    features = timed("f6_features", lambda: cut(ft.extract_features(source, study, resolved)))
    classified = timed("h_groups", lambda: cut(build_cohorts(features, study)))
    timed("h4_flow", lambda: flow_counts(classified).collect())
    people = cut(classified.filter("is_case is not null").drop("reason", "eligible"))
    matched = {}
    for name, changes in (("m5_ratio_2", {}), ("m5_ratio_4", {"ratio": 4}), ("m6_replacement", {"replace": True})):
        spec = MatchSpec.from_dict({**st.MATCHING, **changes})
        matched[name] = timed(name, lambda s=spec: match_groups(people, s, checked=True, stored=True))
    timed("b_balance", lambda: matched["m5_ratio_4"].balance.collect())
    members = matched["m5_ratio_4"].members
    timed("a4_conditional_fit", lambda: md.fit_model(members, study.models[0], "exposed"))
    timed("a7_a8_firth_fit", lambda: md.fit_model(members, study.models[1], "exposed"))
    timed("r_summaries", lambda: run(screened_characteristics(sm.characteristics(members, study))))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        stages(spark, small)  # let the JVM compile the code paths once
    spark.catalog.clearCache()
    st._kept.clear()
    seconds = stages(spark, sf_dir)
    print(json.dumps({
        "metric": "matched case-control study, all stages",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
