"""Values that are no numbers: listed with their databases, the rest reported."""

import tempfile

import pytest

from fleetlens.params import Params
from fleetlens.plans import health
from fleetlens.plans.context import ReportRun
from fleetlens.sources.quarantine import quarantine, split_current
from fleetlens.sources.tables import tables_from_rows
from tests.helpers import AS_OF


def db(name, host_):
    return (name, "oracle_database", "19.1", None, host_)


def host(name, os_="Linux"):
    return (name, "host", os_, "v1", name)


def cpu(target, value):
    return (target, "Load", "cpuUtil", None, value)


def disk(target, group, column, value):
    return (target, "DiskGroup_Usage", column, group, value)


TARGETS = [host("h1"), host("h2"), host("h3", "AIX"), db("A", "h1"), db("B", "h1"), db("C", "h2"), db("D", "h3"),
           ("+ASM1", "osm_instance", None, None, "h2")]
GOOD = [cpu("h1", "12.5"), cpu("h2", "95"), cpu("h3", None), cpu("h3", " 7 "),
        disk("+ASM1", "DATA", "percent_used", "81.5"), disk("+ASM1", "DATA", "total_mb", "2048"),
        disk("+ASM1", "DATA", "free_mb", "1e3")]
BAD = [cpu("h1", "n/a"), cpu("h9", "?"), disk("+ASM1", "FRA", "percent_used", "80 %"), cpu("h3", ""), cpu("h3", "")]
OTHER = [("h1", "Load", "memUsedPct", None, "none"), ("h1", "Other", "cpuUtil", None, "x")]


def run_over(spark, current):
    return ReportRun(tables_from_rows(spark, targets=TARGETS, current=current), Params(as_of=AS_OF))


def split_of(spark, current):
    return split_current(run_over(spark, current), tempfile.mkdtemp(prefix="fleetlens-quarantine-"))


def sections(run):
    return [[tuple(r) for r in f(run).collect()] for f in (health.host_cpu_current, health.asm_diskgroup_usage)]


def test_the_sections_are_those_of_the_good_values(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sections(run_over(spark, GOOD + BAD + OTHER))
    split = split_of(spark, GOOD + BAD + OTHER)
    assert (split.n_good, split.n_bad) == (len(GOOD), len(BAD))
    assert sections(split.run) == sections(run_over(spark, GOOD))
    assert sections(split.run)[0]


def test_bad_values_are_listed_with_their_databases(spark):
    got = [tuple(r) for r in quarantine(split_of(spark, GOOD + BAD + OTHER)).collect()]
    assert sorted(got, key=str) == sorted([
        ("A", "h1", "Linux", *cpu("h1", "n/a")), ("B", "h1", "Linux", *cpu("h1", "n/a")),
        ("C", "h2", "Linux", *disk("+ASM1", "FRA", "percent_used", "80 %")), (None, None, None, *cpu("h9", "?")),
        ("D", "h3", "AIX", *cpu("h3", "")), ("D", "h3", "AIX", *cpu("h3", ""))], key=str)


def test_the_relation_is_read_once(spark):
    """The sections read the written copy, not the relation."""
    split = split_of(spark, GOOD + BAD)
    plan = split.run.t.current._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "parquet" in plan
    assert "PartitionFilters: [isnotnull(quarantined" in \
        split.run.t.current._jdf.queryExecution().executedPlan().toString()


def test_nothing_bad_and_nothing_at_all(spark):
    split = split_of(spark, GOOD)
    assert split.n_bad == 0 and quarantine(split).count() == 0 and sections(split.run) == sections(run_over(spark, GOOD))
    split = split_of(spark, [])
    assert (split.n_good, split.n_bad) == (0, 0) and quarantine(split).count() == 0
    assert sections(split.run) == [[], []]
    split = split_of(spark, BAD)
    assert (split.n_good, split.n_bad) == (0, len(BAD)) and sections(split.run) == [[], []]


def test_cli_goes_on_without_the_bad_values(spark):
    from fleetlens.cli import main
    from fleetlens.sources.tables import materialize_tables
    from datetime import datetime
    root = tempfile.mkdtemp(prefix="fleetlens-quarantine-cli-")
    at = datetime(2026, 1, 1)
    materialize_tables(tables_from_rows(
        spark, targets=TARGETS, current=GOOD + BAD, hourly=[("h1", "host", "Load", "cpuUtil", at, 1.0)],
        daily=[("A", "oracle_database", "DATABASE_SIZE", "USED_GB", at, 1.0)]), root + "/tables")
    paths = main(["health", "--tables", root + "/tables", "--out", root + "/out", "--as-of", "2026-03-01T00:00",
                  "--quarantine", root + "/bad"], spark=spark)
    assert spark.read.parquet(paths["host_cpu_current"]).count() == 5
    assert spark.read.parquet(root + "/bad/listed").count() == 6
