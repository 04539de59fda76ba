"""Health sections over relations in buckets; the runtime Bloom filter."""

import glob
import re
import tempfile
from datetime import datetime

import pytest

from fleetlens.operators.joins import fleet_semi_join
from fleetlens.plans import growth
from fleetlens.plans.context import ReportRun
from fleetlens.plans.report import health_report
from fleetlens.registry import BUCKETED_KEYS, REPORT_PLANS, cpu_params, growth_params
from fleetlens.sources import testmap
from fleetlens.sources.buckets import BucketedRun, open_buckets, write_buckets
from fleetlens.sources.tables import materialize_tables, tables_from_rows
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def root(spark):
    path = tempfile.mkdtemp(prefix="fleetlens-buckets-")
    write_buckets(testmap.load(spark, SF_SMALL), path, 4)
    return path


@pytest.fixture(scope="module")
def tables(spark):
    return materialize_tables(testmap.load(spark, SF_SMALL), tempfile.mkdtemp(prefix="fleetlens-buckets-src-"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def params(key):
    return growth_params() if REPORT_PLANS[key][1] else cpu_params()


@pytest.mark.parametrize("key", BUCKETED_KEYS)
def test_equal_to_the_direct_sections(spark, root, tables, key):
    fn = REPORT_PLANS[key][0]
    direct = fn(ReportRun(tables, params(key))).collect()
    stored = fn(BucketedRun(spark, root, tables.hourly, params(key))).collect()
    assert sorted(map(str, stored)) == sorted(map(str, direct)) and direct


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def below(plan, scan):
    """The operators from a scan of this table up to the plan's root."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if scan in x)
    depth = lambda x: len(re.match(r"[\s:|+\-*()0-9]*", x).group())
    out, now = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if x.strip() and depth(x) < now:
            out.append(x)
            now = depth(x)
    return out


@pytest.mark.parametrize("key,fact", [("tablespace_attention", "tablespace_name"), ("host_cpu_current", "value"),
                                      ("db_growth_monthly", "maximum")])
def test_no_exchange_of_facts_and_no_self_join(spark, root, tables, no_broadcast, key, fact):
    plan = plan_of(REPORT_PLANS[key][0](BucketedRun(spark, root, tables.hourly, params(key))))
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    scans = re.findall(r"FileScan parquet \S*inventory_by_\w+", plan)
    assert scans and "type_qualifier1" not in plan  # the inventory is stored, not joined again
    # the only exchange is the one that orders the few rows of the result
    exchanges = [x for x in plan.split("\n") if re.search(r"\bExchange\b", x)]
    assert all("rangepartitioning" in x for x in exchanges), exchanges


def test_direct_sections_do_exchange(spark, tables, no_broadcast):
    """What the layout saves: the same section over plain files."""
    plan = plan_of(REPORT_PLANS["tablespace_attention"][0](ReportRun(tables, cpu_params())))
    assert "hashpartitioning" in plan


def test_several_sessions_open_the_same_files(spark, root):
    a, b = open_buckets(spark, root), open_buckets(spark.newSession(), root)
    for name in a:
        assert a[name].count() == b[name].count() > 0
    with pytest.raises(ValueError):
        open_buckets(spark, tempfile.mkdtemp(prefix="fleetlens-buckets-none-"))


def test_a_long_history_makes_few_files_and_is_pruned(spark):
    """A bucket has one file a year: 36 months are 3 files in each bucket."""
    path = tempfile.mkdtemp(prefix="fleetlens-buckets-years-")
    daily = [(f"DB{d}", "oracle_database", "DATABASE_SIZE", "USED_GB", datetime(1999 + m // 12, m % 12 + 1, 5), 1.0 + m)
             for d in range(30) for m in range(36)]
    tables = tables_from_rows(spark, daily=daily)
    write_buckets(tables, path, 4)
    files = glob.glob(f"{path}/daily/**/*.parquet", recursive=True)
    assert len(files) <= 4 * 3
    run = BucketedRun(spark, path, tables.hourly, growth_params())
    assert sorted(map(str, run.t.daily.select(tables.daily.columns).collect())) == sorted(
        map(str, tables.daily.collect()))
    sizes = growth.db_size_monthly(run)
    assert sorted(map(str, sizes.collect())) == sorted(map(str, growth.db_size_monthly(
        ReportRun(tables, growth_params())).collect())) != []
    seen = sizes._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*rollup_year", seen)
    assert all("rollup_year=2001" in f for f in run.t.daily.where("rollup_year = date'2001-01-01'")
               .select("_metadata.file_path").distinct().toPandas()["file_path"])


def test_empty_relations(spark):
    path = tempfile.mkdtemp(prefix="fleetlens-buckets-empty-")
    empty = tables_from_rows(spark)
    write_buckets(empty, path, 2)
    run = BucketedRun(spark, path, empty.hourly, cpu_params())
    got = {k: v.count() for k, v in health_report(run).items()}
    assert got.pop("asm_not_applicable") == 1 and not any(got.values())


# ---- the fleet beyond the broadcast limit ------------------------------------

BLOOM = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


def shuffled_fact_rows(df):
    """Rows that the facts' exchange wrote, from the plan that ran."""
    df.collect()
    seen = [0]

    def walk(node):
        name = node.nodeName().split(" ")[0]
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange" and "rollup_timestamp" in node.toString().split("\n")[0] + str(node.output()):
            seen.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(seen)


def test_bloom_filter_cuts_the_facts_before_their_shuffle(spark, tables):
    from fleetlens.session import REPORT_CONF
    assert REPORT_CONF["spark.sql.optimizer.runtime.bloomFilter.enabled"] == "true"
    r = ReportRun(tables, cpu_params())
    # the name pattern is inferred for the facts as well, the OS cannot be
    run = lambda: fleet_semi_join(r.cpu_rows(30), r.hosts.where("os_type = 'AIX'"))
    want, everything = run().count(), r.fleet_cpu_semi(30).count()
    before = {k: spark.conf.get(k, None) for k in BLOOM}
    try:
        for k, v in BLOOM.items():
            spark.conf.set(k, v)
        df = run()
        rows = shuffled_fact_rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan and "SortMergeJoin" in plan and df.count() == want
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
        plain = run()
        assert shuffled_fact_rows(plain) == everything > want
        assert want <= rows < want + 0.1 * (everything - want) + 5  # the fleet's share, few false hits
    finally:
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
