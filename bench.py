"""Benchmark the report queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each report query is run once to warm up, then ``BENCH_REPS`` (5) times; the
median wall time (plan + full execution into a ``noop`` sink) is
reported.  Whole-report runs are timed too: the seven CPU sections on one
run, with and without the fleet's CPU rows persisted, and the six health
sections.
The reports are then timed again over a parquet copy of the relations
(``parquet_*``: time series partitioned by day, as a repository export
would be laid out), which measures the reports without the test mapping.
Prints one JSON line; ``value`` is the sum of the reports over the parquet
copy (``parquet_total``); the times over the driver's tables, whose test
mapping folds events per report, are listed beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.plans.context import ReportRun  # noqa: E402
from fleetlens.plans.report import cpu_report, health_report  # noqa: E402
from fleetlens.registry import REPORT_PLANS, REPORTS, cpu_params, growth_params, run_for  # noqa: E402
from fleetlens.session import ensure_checkpoint_dir, local_session  # noqa: E402
from fleetlens.sources import testmap  # noqa: E402
from fleetlens.sources.tables import materialize_tables  # noqa: E402

HEADLINE = [k for k in REPORTS if k != "cpu_spike_batches"]  # the same sixteen in every round


def execute(df) -> None:
    """Run the whole plan without shipping rows to Python (``noop`` sink):
    what is timed is the engine, not driver-side row conversion."""
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="fleetlens-bench")
    per_query = {}
    for k in HEADLINE:
        fn = REPORTS[k]
        execute(fn(spark, sf_dir))  # warm-up
        per_query[k] = round(statistics.median(
            timed(lambda: execute(fn(spark, sf_dir))) for _ in range(reps)), 3)

    def whole_cpu(persist=False):
        run = run_for(spark, sf_dir, persist=persist)
        for df in cpu_report(run).values():
            execute(df)
        run.unpersist()

    def whole_health():
        run = run_for(spark, sf_dir, growth_params())
        for df in health_report(run).values():
            execute(df)

    whole_cpu()
    per_query["report_cpu_all_sections"] = round(statistics.median(
        timed(whole_cpu) for _ in range(reps)), 3)
    per_query["report_cpu_all_sections_persisted"] = round(statistics.median(
        timed(lambda: whole_cpu(True)) for _ in range(reps)), 3)
    whole_health()
    per_query["report_health_all_sections"] = round(statistics.median(
        timed(whole_health) for _ in range(reps)), 3)
    # the same reports over the relations as a monitoring repository holds
    # them: written once as parquet, time series partitioned by day
    root = f"{ensure_checkpoint_dir(spark)}/fleetlens-bench-{uuid.uuid4().hex[:12]}"
    mat = materialize_tables(testmap.load(spark, sf_dir), root)
    for k in HEADLINE:
        fn, is_growth = REPORT_PLANS[k]
        params = growth_params() if is_growth else cpu_params()

        def go():
            execute(fn(ReportRun(mat, params)))
        go()
        per_query[f"parquet_{k}"] = round(statistics.median(timed(go) for _ in range(reps)), 3)
    total = round(sum(per_query[k] for k in HEADLINE), 3)
    per_query["parquet_total"] = round(sum(per_query[f"parquet_{k}"] for k in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    per_query["driver_tables_total"] = total
    print(json.dumps({"metric": "report_queries_parquet_total_median", "value": per_query["parquet_total"], "unit": "sec",
                      "queries": per_query, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
