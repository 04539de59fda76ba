"""Scale properties of the physical plans, checked on a day-partitioned
parquet copy of the relations: one fact scan per report, no cross or
nested-loop join, partial aggregation before the shuffle, bounded top-k."""

import contextlib
import io
import re
import tempfile

import pytest

from fleetlens.plans.context import ReportRun
from fleetlens.registry import REPORT_PLANS, cpu_params, growth_params
from fleetlens.sources import testmap
from fleetlens.sources.tables import materialize_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def plans(spark):
    mat = materialize_tables(testmap.load(spark, SF_SMALL), tempfile.mkdtemp(prefix="fleetlens-shape-"))
    out = {}
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # whole filter lists
    for key, (fn, is_growth) in REPORT_PLANS.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(ReportRun(mat, growth_params() if is_growth else cpu_params())).explain()
        out[key] = re.sub(r"#\d+L?", "", buf.getvalue())  # drop expression ids
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    return out


def _hourly_scans(plan: str) -> int:
    return len(re.findall(r"FileScan parquet \[[^\]]*metric_column,rollup_timestamp,average", plan))


@pytest.mark.parametrize("key", [k for k in REPORT_PLANS
                                 if k.startswith("cpu_") and k != "cpu_recurring_pattern"])
def test_cpu_reports_scan_hourly_once_with_pruning(plans, key):
    plan = plans[key]
    assert _hourly_scans(plan) == 1
    assert "PartitionFilters: [isnotnull(rollup_date" in plan
    assert "PushedFilters: [IsNotNull(metric_name)" in plan


def test_recurring_hours_skew_safe(plans):
    """Two pruned scans of the events window: the distinct (host, hour, day)
    rows are deduplicated before the shuffle and joined back; no window
    holds a host's raw rows."""
    plan = plans["cpu_recurring_pattern"]
    scans = re.findall(r"FileScan parquet \[[^\]]*metric_column,rollup_timestamp,average.*", plan)
    assert len(scans) == 2
    for scan in scans:
        assert "PartitionFilters: [isnotnull(rollup_date" in scan
        assert "PushedFilters: [IsNotNull(metric_name)" in scan
    assert "Window" not in plan
    assert "partial_count(distinct" in plan


@pytest.mark.parametrize("key", list(REPORT_PLANS))
def test_no_cross_or_nested_loop_join(plans, key):
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plans[key]


def test_kpis_fold_per_host_without_expand(plans):
    plan = plans["cpu_dashboard_kpis"]
    assert "Expand" not in plan
    assert "partial_sum(cpu_units" in plan and "partial_max(cpu_units" in plan


def test_latest_per_host_is_a_partial_aggregate(plans):
    """One extremum of the whole row's order, combined before the shuffle."""
    assert "partial_max(struct(rollup_timestamp" in plans["cpu_current_snapshot"]


def test_top_k_limits_before_numbering(plans):
    assert "TakeOrderedAndProject(limit=50" in plans["cpu_top_spike_events"]
    assert "TakeOrderedAndProject(limit=20" in plans["cpu_top_consumers_linux"]


@pytest.mark.parametrize("key, keys", [("asm_diskgroup_usage", "target_name, key_value"),
                                       ("tablespace_attention", "target_name, host_name"),
                                       ("db_growth_monthly", "target_name"),
                                       ("host_cpu_current", "cpu_target, value")])
def test_inventory_cut_below_the_fold(plans, key, keys):
    """The semi join to the inventory sits below (printed after) the
    aggregate, so nothing outside the inventory is folded."""
    plan = plans[key]
    assert "LeftSemi" in plan[plan.index(f"Aggregate(keys=[{keys}"):]


@pytest.mark.parametrize("key", ["cpu_spike_days", "cpu_top_spike_events", "cpu_recurring_pattern"])
def test_threshold_reaches_the_fact_scan(plans, key):
    scans = re.findall(r"FileScan parquet \[[^\]]*metric_column,rollup_timestamp,average.*", plans[key])
    assert scans
    for scan in scans:
        assert "GreaterThanOrEqual(average,98.0)" in scan or "average >= 98.0" in scan


@pytest.mark.parametrize("key", list(REPORT_PLANS))
def test_no_single_partition_limit(plans, key):
    assert "GlobalLimit" not in plans[key]
