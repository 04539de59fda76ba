"""Command line: run the CPU or the health report over monitoring tables
stored as parquet and write one dataset per section.

    spark-submit -m fleetlens.cli cpu --tables ROOT --out OUT [--lookback 30] [--threshold 98]
    python -m fleetlens cpu --tables ROOT --out OUT --as-of 2026-03-01T00:00 --html
    python -m fleetlens health --tables ROOT --out OUT [--os AIX Linux]
    python -m fleetlens health --tables ROOT --out OUT --os Linux --run 2026-03-01

A health report replaces the OS values it was asked for and leaves the others.
With ``--run`` the report is kept beside those of other runs and committed as
a whole (:mod:`fleetlens.sources.history`); the same run again replaces it.

``--as-of`` defaults to the current time (the repository clock); give it to
make a run repeatable.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from fleetlens.params import Params
from fleetlens.plans.context import ReportRun
from fleetlens.plans.report import cpu_report, health_report
from fleetlens.sources.history import ReportHistory
from fleetlens.sources.quarantine import quarantine, split_current
from fleetlens.sources.sinks import write_html_rows, write_sections
from fleetlens.sources.tables import read_parquet_tables


def parse(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="fleetlens")
    ap.add_argument("report", choices=("cpu", "health"))
    ap.add_argument("--tables", required=True, help="folder with the five relations")
    ap.add_argument("--out", required=True, help="output folder, one dataset per section")
    ap.add_argument("--as-of", default=None, help="ISO timestamp; default now")
    ap.add_argument("--lookback", type=int, default=Params.lookback_days)
    ap.add_argument("--threshold", type=float, default=Params.spike_threshold)
    ap.add_argument("--os", nargs="+", default=list(Params.os_list))
    ap.add_argument("--html", action="store_true", help="also write html_row text per section")
    ap.add_argument("--mode", default="overwrite", choices=("overwrite", "append"))
    ap.add_argument("--run", default=None, help="keep the report as this run, beside others, committed as a whole")
    ap.add_argument("--quarantine", default=None,
                    help="health: list metric values that are no numbers below this folder and report the others")
    ap.add_argument("--persist", action="store_true",
                    help="cache the fleet's CPU rows for the seven CPU sections; pays off "
                         "when the source is expensive to scan (JDBC), not over pruned parquet")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName(f"fleetlens-{a.report}").getOrCreate()
    as_of = datetime.fromisoformat(a.as_of) if a.as_of else datetime.now()
    params = Params(as_of=as_of, lookback_days=a.lookback, spike_threshold=a.threshold,
                    os_list=tuple(a.os))
    run = ReportRun(read_parquet_tables(spark, a.tables), params,
                    persist=(a.report == "cpu" and a.persist))
    if a.quarantine and a.report == "health":
        split = split_current(run, f"{a.quarantine}/values")
        quarantine(split).write.mode("overwrite").parquet(f"{a.quarantine}/listed")
        run = split.run
    build = cpu_report if a.report == "cpu" else health_report
    sections = build(run, html=a.html)
    split = ("os",) if a.report == "health" else ()  # one health report per OS
    if a.run is not None:
        ReportHistory(spark, a.out).write(a.report, sections, a.run, a.os if split else None)
        run.unpersist()
        return {k: f"{a.out}/{a.report}/{k}" for k in sections}
    own = a.os if split else None
    paths = write_sections({k: (v.drop("html_row") if "html_row" in v.columns else v)
                            for k, v in sections.items()}, f"{a.out}/typed", mode=a.mode, partition_by=split, own=own)
    if a.html:
        write_html_rows({k: v for k, v in sections.items() if "html_row" in v.columns},
                        f"{a.out}/html", mode=a.mode, partition_by=split, own=own)
    run.unpersist()
    return {p.rsplit("/", 1)[-1]: p for p in paths}


if __name__ == "__main__":
    main()
