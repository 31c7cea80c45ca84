"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urnalake.checks import audit_checks, quality_checks, report_checks, silver_checks  # noqa: F401
from urnalake.checks import inputs
from urnalake.checks.registry import QUERIES
from urnalake.operators.silver import to_silver
from urnalake.plans.bronze import ingest_year
from urnalake.plans.lake import Lake
from urnalake.session import build_session, scratch_folder
from urnalake.sources import tables

RUNS = 3
SMALL_RESULTS = [
    "national_by_year", "regional_by_year", "state_by_year", "rollups_fused", "doc_rates_by_year",
    "doc_by_region", "top10_turnout", "null_drop_stats", "rule_violations", "type_conformance",
    "consistency", "sample_exact", "audit_latest", "plan_silver",
]
ROW_RESULTS = ["silver_null_drop", "typed_casts"]


def seconds(job) -> float:
    """Median of a few runs after one that warms up code generation."""
    job()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("OFF")
    timed = {}
    for name in SMALL_RESULTS:
        timed[name] = seconds(lambda name=name: QUERIES[name](spark, sf_dir).collect())
    for name in ROW_RESULTS:
        timed[name] = seconds(
            lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )

    # The table path: bronze written once, silver built from it, rollups read from silver.
    root = scratch_folder(spark, "bench")
    tables.write_year(inputs.bronze(spark, sf_dir), f"{root}/bronze", 2022)

    def build_silver():
        tables.write_year(to_silver(tables.read_year(spark, f"{root}/bronze", 2022)), f"{root}/silver", 2022)

    def report():
        from urnalake.operators.rollups import rollups_fused

        rollups_fused(tables.read_years(spark, f"{root}/silver", [2022])).collect()

    # The load from text: landed CSV files to a bronze year, checksum and audit row included.
    landed = f"{root}/landed"
    inputs.bronze(spark, sf_dir).write.options(sep=";", header="true").csv(landed)
    lake = Lake(f"{root}/lake")
    timed["ingest"] = seconds(lambda: ingest_year(spark, lake, 2022, landed))
    timed["table_silver_build"] = seconds(build_silver)
    timed["table_report"] = seconds(report)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, median per query",
                "value": round(sum(timed.values()), 4),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
