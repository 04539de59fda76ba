"""Without any broadcast the same reports run as shuffle joins and give the
same rows; building a report starts no job."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from fleetlens.plans.context import ReportRun
from fleetlens.registry import REPORT_PLANS, cpu_params, growth_params, queries
from fleetlens.sources import testmap
from fleetlens.sources.tables import tables_from_rows
from tests.conftest import SF_SMALL
from tests.helpers import AS_OF, host

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_auto_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_shuffle_joins_give_the_same_rows(spark, request):
    tables = testmap.load(spark, SF_SMALL)

    def run(key):
        fn, is_growth = REPORT_PLANS[key]
        return fn(ReportRun(tables, growth_params() if is_growth else cpu_params()))
    broadcast = {key: sorted(map(tuple, run(key).collect()), key=repr) for key in REPORT_PLANS}
    request.getfixturevalue("no_auto_broadcast")
    for key in REPORT_PLANS:
        assert sorted(map(tuple, run(key).collect()), key=repr) == broadcast[key], key
    plan = _plan(run("cpu_top_consumers_linux"))
    assert "BroadcastExchange" not in plan
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_building_a_report_runs_no_job(spark):
    tables = testmap.load(spark, SF_SMALL)
    for name in ("targets", "hourly", "daily", "current", "tablespaces"):
        getattr(tables, name)  # reads the files' schemas
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for fn, is_growth in REPORT_PLANS.values():
            fn(ReportRun(tables, growth_params() if is_growth else cpu_params()))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ---- rows that the inventory repeats -----------------------------------------

def test_sections_are_ordered_in_several_tasks(spark):
    """Databases of one name on many hosts repeat every row; such rows compress
    so well that an adaptive sort would be merged into one task."""
    names = [f"h-d-{i:02d}" for i in range(40)]
    tables = tables_from_rows(
        spark, targets=[host(n) for n in names] + [("DB1", "oracle_database", "19", None, n) for n in names],
        tablespaces=[("DB1", n, f"TS{i}", "ONLINE", "PERMANENT", 100, 95 - i % 3, AS_OF)
                     for i, n in enumerate(names)])
    plain = REPORT_PLANS["tablespace_attention"][0](ReportRun(tables, cpu_params()))
    spread = REPORT_PLANS["tablespace_attention"][0](ReportRun(tables, cpu_params(), ranges=8))
    got, want = spread.collect(), plain.collect()
    assert len(got) == 1600 and sorted(map(str, got)) == sorted(map(str, want))
    order = lambda rows: [(r["os"], r["database_name"], r["host_name"]) for r in rows]
    assert order(got) == order(want) == sorted(order(want))
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 800


def test_rendered_rows_of_a_section_are_written_by_several_tasks(spark):
    rows = queries()["render_html_row"](spark, SF_SMALL)
    parts = rows.groupBy("section", F.spark_partition_id().alias("task")).count().collect()
    for section in ("asm_diskgroup_usage", "tablespace_attention", "host_cpu_current", "db_growth_monthly"):
        sizes = [r["count"] for r in parts if r["section"] == section]
        assert len(sizes) > 1 and sum(sizes) > max(sizes), (section, sizes)
