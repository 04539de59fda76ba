"""Scale-up run: the fleet of an sf folder replicated K times, stored as
partitioned parquet, every CPU report timed in Spark and checked against
DuckDB on the same files.

    python tools/scale_check.py [sf_dir] [K]

Replication is done by Spark from the mapped driver tables: each host row
and each of its hourly readings is copied K times under the names
``r<i>-<host>`` (a generator, not a join).  Databases, disk groups and
tablespaces are left as they are.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fleetlens.oracle import over_stored, reports  # noqa: E402
from fleetlens.plans.context import ReportRun  # noqa: E402
from fleetlens.registry import REPORT_PLANS, cpu_params  # noqa: E402
from fleetlens.session import ensure_checkpoint_dir, local_session  # noqa: E402
from fleetlens.sources import testmap  # noqa: E402
from fleetlens.sources.tables import MonitoringTables, materialize_tables  # noqa: E402
from tools.oracle_check import norm  # noqa: E402

CPU_KEYS = [k for k in REPORT_PLANS if k.startswith("cpu_")]


def replicate(t, k: int) -> MonitoringTables:
    copy = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("i")

    def rename(df):
        return (df.select("*", copy)
                .withColumn("target_name", F.concat(F.lit("r"), F.col("i").cast("string"),
                                                    F.lit("-"), F.col("target_name"))))
    hosts = t.targets.where(F.col("target_type") == "host")
    others = t.targets.where(F.col("target_type") != "host")
    hosts_x = rename(hosts).withColumn("host_name", F.col("target_name")).drop("i")
    hourly_x = rename(t.hourly).drop("i")
    return MonitoringTables(hosts_x.unionByName(others), hourly_x, t.daily, t.current, t.tablespaces)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    k = int(argv[2]) if len(argv) > 2 else 50
    spark = local_session(8, 8, app="fleetlens-scale")
    root = f"{ensure_checkpoint_dir(spark)}/fleetlens-scale-{uuid.uuid4().hex[:8]}"
    t0 = time.perf_counter()
    mat = materialize_tables(replicate(testmap.load(spark, sf_dir), k), root)
    write_s = time.perf_counter() - t0
    n_hourly = mat.hourly.count()
    n_hosts = mat.targets.where("target_type = 'host'").count()

    con = duckdb.connect()
    for name in ("mon_target", "mon_metric_current", "mon_db_tablespaces"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    for name in ("mon_metric_hourly", "mon_metric_daily"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}/**/*.parquet', "
                    f"hive_partitioning = true)")
    sql = reports()
    out = {"sf": sf_dir, "replicas": k, "hourly_rows": n_hourly, "hosts": n_hosts,
           "write_sec": round(write_s, 2), "queries": {}, "match": {}}
    for key in CPU_KEYS:
        fn = REPORT_PLANS[key][0]

        def go():
            fn(ReportRun(mat, cpu_params())).write.format("noop").mode("overwrite").save()
        go()
        times = []
        for _ in range(3):
            t1 = time.perf_counter()
            go()
            times.append(time.perf_counter() - t1)
        out["queries"][key] = round(statistics.median(times), 3)
        rows = fn(ReportRun(mat, cpu_params())).collect()
        cols = fn(ReportRun(mat, cpu_params())).columns
        srows = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in rows)
        rel = con.sql(over_stored(sql[key]))
        dcols = rel.columns
        drows = sorted(tuple(norm(r[dcols.index(c)]) for c in sorted(cols)) for r in rel.fetchall())
        out["match"][key] = srows == drows
    from fleetlens.plans.report import cpu_report
    for persist in (False, True):
        t2 = time.perf_counter()
        run = ReportRun(mat, cpu_params(), persist=persist)
        for df in cpu_report(run).values():
            df.write.format("noop").mode("overwrite").save()
        run.unpersist()
        name = "report_cpu_all_sections" + ("_persisted" if persist else "")
        out["queries"][name] = round(time.perf_counter() - t2, 3)
    out["hourly_rows_per_sec_kpis"] = int(n_hourly / out["queries"]["cpu_dashboard_kpis"])
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
