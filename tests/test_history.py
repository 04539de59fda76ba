"""Runs that replace, keep and survive each other."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetlens.sources.history import ReportHistory
from fleetlens.sources.sinks import write_sections


def section(spark, rows):
    return spark.createDataFrame(rows, "os string, name string, n int").orderBy("os", "name")


def read(df):
    return [tuple(r) for r in df.collect()]


LINUX = [("Linux", "b", 1), ("Linux", "a", 2)]
AIX = [("AIX", "z", 3)]


@pytest.fixture
def history(spark):
    return ReportHistory(spark, tempfile.mkdtemp(prefix="fleetlens-history-"))


def test_runs_for_one_os_each_leave_both(spark, history):
    history.write("health", {"s": section(spark, AIX)}, "r1", ["AIX"])
    history.write("health", {"s": section(spark, LINUX)}, "r1", ["Linux"])
    assert read(history.read("health", "s")) == [("AIX", "z", 3), ("Linux", "a", 2), ("Linux", "b", 1)]
    assert read(history.read("health", "s", os_name="AIX")) == AIX


def test_a_run_done_again_leaves_equal_rows(spark, history):
    for _ in range(2):
        history.write("health", {"s": section(spark, AIX + LINUX)}, "r1", ["AIX", "Linux"])
        assert read(history.read("health", "s")) == sorted(AIX + LINUX)
    assert history.runs("health").count() == 2
    assert read(history.read("health", "s", history=True)) == [(*r, r[0], "r1") for r in sorted(AIX + LINUX)]


def test_a_run_done_again_without_rows_leaves_none(spark, history):
    history.write("health", {"s": section(spark, AIX + LINUX)}, "r1", ["AIX", "Linux"])
    history.write("health", {"s": section(spark, [])}, "r1", ["AIX"])
    assert read(history.read("health", "s")) == sorted(LINUX)
    history.write("health", {"s": section(spark, [])}, "r1", ["Linux"])
    back = history.read("health", "s")
    assert read(back) == [] and back.columns == ["os", "name", "n"]
    assert history.missing("health").count() == 0


class Killed(Exception):
    pass


def test_a_killed_run_leaves_the_old_report(spark, history, monkeypatch):
    history.write("health", {"s": section(spark, AIX), "t": section(spark, AIX)}, "r1", ["AIX"])
    write, calls = history._write_section, []

    def dies(*args):
        if calls:
            raise Killed
        calls.append(1)
        return write(*args)

    monkeypatch.setattr(history, "_write_section", dies)
    new = section(spark, [("AIX", "new", 9)])
    for run in ("r1", "r2"):
        calls.clear()
        with pytest.raises(Killed):
            history.write("health", {"s": new, "t": new}, run, ["AIX"])
    monkeypatch.undo()
    assert read(history.read("health", "s")) == read(history.read("health", "t")) == AIX
    assert history.runs("health").count() == 1
    assert history.vacuum("health") == 0  # not old enough: a run may be under way
    assert history.vacuum("health", older_than_s=-60) == 2
    assert read(history.read("health", "s")) == AIX


def test_runs_stay_side_by_side_in_order(spark, history):
    history.write("cpu", {"k": section(spark, LINUX)}, "2026-03-01")
    history.write("cpu", {"k": section(spark, AIX)}, "2026-03-02")
    assert read(history.read("cpu", "k")) == AIX
    assert read(history.read("cpu", "k", run="2026-03-01")) == sorted(LINUX)
    assert len(read(history.read("cpu", "k", history=True))) == 3
    with pytest.raises(LookupError):
        history.read("cpu", "k", run="none")
    with pytest.raises(LookupError):
        history.read("nothing", "k")


def test_order_of_many_rows(spark, history):
    rows = spark.range(0, 5000, 1, 7).select(F.lit("Linux").alias("os"), (F.col("id") * 7919 % 5000).alias("n"))
    history.write("health", {"s": rows.orderBy(F.col("n").desc())}, "r", ["Linux"])
    assert [r["n"] for r in history.read("health", "s").collect()] == list(range(4999, -1, -1))


def test_an_os_that_the_run_does_not_speak_for(spark, history):
    with pytest.raises(ValueError):
        history.write("health", {"s": section(spark, AIX + LINUX)}, "r1", ["AIX"])
    assert history.runs("health").count() == 0


def test_lost_files_are_noticed(spark, history):
    history.write("health", {"s": section(spark, AIX + LINUX)}, "r1", ["AIX", "Linux"])
    assert history.missing("health").count() == 0
    at = f"{history.path}/health/s/report_os=AIX/report_run=r1"
    for folder, _, names in os.walk(at):
        for n in names:
            if n.endswith(".parquet"):
                os.truncate(f"{folder}/{n}", 0)
                os.rename(f"{folder}/{n}", f"{folder}/_{n}")
    assert read(history.missing("health")) == [("s", "AIX", "r1", 1, 0)]


def test_plain_overwrite_keeps_the_other_os(spark):
    out = tempfile.mkdtemp(prefix="fleetlens-plain-")
    write_sections({"s": section(spark, AIX + LINUX)}, out, partition_by=("os",), own=["AIX", "Linux"])
    write_sections({"s": section(spark, LINUX[:1])}, out, partition_by=("os",), own=["Linux"])
    rows = lambda: sorted((r["os"], r["name"], r["n"]) for r in spark.read.parquet(f"{out}/s").collect())
    assert rows() == [AIX[0], LINUX[0]]
    write_sections({"s": section(spark, [])}, out, partition_by=("os",), own=["Linux"])
    assert rows() == AIX
    write_sections({"s": section(spark, AIX)}, out, mode="append", partition_by=("os",), own=["AIX"])
    assert rows() == AIX + AIX


def test_cli_runs(spark):
    from fleetlens.cli import main
    from fleetlens.sources import testmap
    from fleetlens.sources.tables import materialize_tables
    from tests.conftest import SF_SMALL

    root = tempfile.mkdtemp(prefix="fleetlens-cli-runs-")
    materialize_tables(testmap.load(spark, SF_SMALL), root + "/tables")
    common = ["health", "--tables", root + "/tables", "--as-of", "2001-07-15T00:00"]
    history = ReportHistory(spark, root + "/kept")
    for os_name in ("Linux", "AIX", "Linux"):
        main([*common, "--out", root + "/kept", "--os", os_name, "--run", "2001-07"], spark=spark)
        main([*common, "--out", root + "/plain", "--os", os_name], spark=spark)
    whole = main([*common, "--out", root + "/whole"], spark=spark)
    for name, path in whole.items():
        want = spark.read.parquet(path)
        if name not in ("asm_diskgroup_usage", "asm_not_applicable"):
            assert {r[0] for r in want.select("os").distinct().collect()} == {"AIX", "Linux"}
        columns = sorted(want.columns)
        rows = sorted(map(str, want.select(*columns).collect()))
        assert sorted(map(str, history.read("health", name).select(*columns).collect())) == rows
        assert sorted(map(str, spark.read.parquet(f"{root}/plain/typed/{name}").select(*columns).collect())) == rows
