"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the input tables; BENCH_CPUS: local cores. Every query is planned and
executed in full (noop sink). Matching and estimation read the written feature table, as they do
in a campaign run; household_features times the whole way from the sources to that table.
"""

from __future__ import annotations

import json
import os
import time

from checks.compare import session
from checks.queries import QUERIES, written

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "identity_households",
    "household_conversions",
    "household_assignment",
    "household_demographic_features",
    "household_purchase_features",
    "household_features",
    "stratified_match",
    "propensity_match",
    "match_report",
    "lift_strata_linear",
    "lift_psm_linear",
    "placebo_psm_linear",
    "lift_psm_trees",
)


def main() -> None:
    spark = session(CPUS)
    # Not timed: class loading, and the tables that several queries start from.
    for name in ("AllFeatures", "StratifiedFeatures", "PSMMatchedFeatures"):
        written(spark, FOLDER, name).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")),
        "cpus": int(CPUS),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
