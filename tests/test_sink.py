import tempfile

from fleetlens.plans.report import cpu_report, health_report
from fleetlens.registry import run_for
from fleetlens.sources.sinks import write_html_rows, write_sections
from tests.conftest import SF_SMALL


def test_write_and_read_back(spark):
    out = tempfile.mkdtemp(prefix="fleetlens-sink-")
    run = run_for(spark, SF_SMALL, persist=True)
    sections = cpu_report(run, html=True)
    paths = write_sections(sections, out + "/typed")
    assert len(paths) == 7
    back = spark.read.parquet(out + "/typed/cpu_spike_days")
    assert back.count() == sections["cpu_spike_days"].count()
    write_html_rows(sections, out + "/html")
    lines = spark.read.text(out + "/html/cpu_weekly_trend").collect()
    assert all(r.value.startswith("<tr>") for r in lines)
    run.unpersist()


def test_health_report_all_os(spark):
    run = run_for(spark, SF_SMALL)
    sections = health_report(run, html=True)
    inv = sections["db_host_inventory"].collect()
    assert {r.os for r in inv} == {"AIX", "Linux"}
    assert sections["asm_not_applicable"].count() == 1


def test_reports_equal_over_partitioned_parquet(spark):
    """Reports over a day/month-partitioned parquet copy of the relations
    equal the reports over the lazily mapped tables, and the plan prunes
    partitions and pushes the metric filters into the scan."""
    from fleetlens.plans.context import ReportRun
    from fleetlens.registry import REPORT_PLANS, cpu_params, growth_params
    from fleetlens.sources import testmap
    from fleetlens.sources.tables import materialize_tables

    root = tempfile.mkdtemp(prefix="fleetlens-mat-")
    lazy = testmap.load(spark, SF_SMALL)
    mat = materialize_tables(lazy, root)
    for key, (fn, is_growth) in REPORT_PLANS.items():
        p = growth_params() if is_growth else cpu_params()
        a = sorted(map(tuple, fn(ReportRun(lazy, p)).collect()))
        b = sorted(map(tuple, fn(ReportRun(mat, p)).collect()))
        assert a == b, key
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        REPORT_PLANS["cpu_spike_days"][0](ReportRun(mat, cpu_params())).explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(rollup_date" in plan
    assert "EqualTo(metric_name,Load)" in plan


def test_append_keeps_earlier_runs(spark):
    out = tempfile.mkdtemp(prefix="fleetlens-append-")
    run = run_for(spark, SF_SMALL)
    sec = {"cpu_weekly_trend": cpu_report(run)["cpu_weekly_trend"]}
    write_sections(sec, out)
    write_sections(sec, out, mode="append")
    n = sec["cpu_weekly_trend"].count()
    assert spark.read.parquet(out + "/cpu_weekly_trend").count() == 2 * n


def test_cli_runs_both_reports(spark):
    from fleetlens.cli import main
    from fleetlens.sources import testmap
    from fleetlens.sources.tables import materialize_tables

    root = tempfile.mkdtemp(prefix="fleetlens-cli-")
    materialize_tables(testmap.load(spark, SF_SMALL), root + "/tables")
    cpu_paths = main(["cpu", "--tables", root + "/tables", "--out", root + "/cpu",
                      "--as-of", "2024-01-31T00:00", "--html"], spark=spark)
    assert len(cpu_paths) == 7
    days = spark.read.parquet(cpu_paths["cpu_spike_days"]).count()
    assert 0 < days <= 31
    html = spark.read.text(root + "/cpu/html/cpu_top_consumers_linux").collect()
    assert html and all(r.value.startswith("<tr><td><strong>") for r in html)
    hc = main(["health", "--tables", root + "/tables", "--out", root + "/health",
               "--as-of", "2001-07-15T00:00"], spark=spark)
    grown = spark.read.parquet(hc["db_growth_monthly"])
    assert grown.count() > 0 and set(grown.columns) >= {"os", "month_dt"}
    main(["health", "--tables", root + "/tables", "--out", root + "/html_health",
          "--as-of", "2001-07-15T00:00", "--html"], spark=spark)
    import os
    for kind in ("typed", "html"):
        for section in ("db_growth_monthly", "host_cpu_current", "tablespace_attention"):
            folders = os.listdir(f"{root}/html_health/{kind}/{section}")
            assert {"os=AIX", "os=Linux"} <= set(folders)
    # the files of one OS, read in turn, are in the order of database and month
    import glob

    import pyarrow.parquet as pq
    for os_name in ("AIX", "Linux"):
        files = sorted(glob.glob(f"{root}/html_health/typed/db_growth_monthly/os={os_name}/*.parquet"))
        written = [(r["target_name"], r["month_dt"]) for f in files for r in pq.ParquetFile(f).read().to_pylist()]
        assert written and written == sorted(written)
        lines = [x for f in sorted(glob.glob(f"{root}/html_health/html/db_growth_monthly/os={os_name}/*.txt"))
                 for x in open(f)]
        names = [x.split("<td>")[1].split("<")[0] for x in lines]
        assert names == sorted(names) and len(names) == len(written)


def test_sections_partitioned_by_os(spark):
    out = tempfile.mkdtemp(prefix="fleetlens-os-")
    run = run_for(spark, SF_SMALL)
    sections = health_report(run)
    write_sections({"host_cpu_current": sections["host_cpu_current"]}, out, partition_by=("os",))
    import os
    assert sorted(d for d in os.listdir(out + "/host_cpu_current") if d.startswith("os=")) == \
        ["os=AIX", "os=Linux"]
    back = spark.read.parquet(out + "/host_cpu_current")
    assert back.count() == sections["host_cpu_current"].count()


def test_register_views_sql(spark):
    from fleetlens.plans.report import register_views
    run = run_for(spark, SF_SMALL)
    names = register_views(run, prefix="fl_")
    assert "fl_cpu_spike_days" in names and "fl_mon_metric_hourly" in names
    n = spark.sql("SELECT sum(incident_count) AS n FROM fl_cpu_spike_days").collect()[0]["n"]
    k = spark.sql("SELECT spike_count FROM fl_cpu_dashboard_kpis").collect()[0]["spike_count"]
    assert n == k


def test_health_report_single_os(spark):
    from fleetlens.params import Params
    from fleetlens.registry import cpu_params
    p = cpu_params()
    run = run_for(spark, SF_SMALL, Params(as_of=p.as_of, os_list=("AIX",)))
    sections = health_report(run)
    assert sections["asm_diskgroup_usage"].count() == 0
    assert sections["asm_not_applicable"].count() == 1
    assert {r.os for r in sections["host_cpu_current"].collect()} == {"AIX"}
    run = run_for(spark, SF_SMALL, Params(as_of=p.as_of, os_list=("Linux",)))
    sections = health_report(run)
    assert sections["asm_not_applicable"].count() == 0
    assert sections["asm_diskgroup_usage"].count() > 0
