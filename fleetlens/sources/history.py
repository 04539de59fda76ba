"""Reports of many runs in one folder.

A run writes each section into partitions of its own, by OS, run and attempt,
and then one commit record per OS.  Readers look at committed attempts only,
of each (OS, run) the last one:

- runs for one OS each leave the other's report as it is;
- a run that is done again replaces its rows (a new attempt, then a new
  record), whether it has fewer rows, other ones or none at all;
- a run that is killed has no record, so the report before it stays, all
  sections of it: sections change together, with the record;
- the record holds schemas and row counts, so an empty section reads as an
  empty table and a file lost later is noticed.

:meth:`ReportHistory.vacuum` deletes what no record, or only an outdated one,
points at.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.sources.files import delete, exists, folders, modified_ms, partition_folder

ALL = "all"  # the OS of a report that is not split by OS
_PARTS = ("report_os", "report_run", "report_attempt")
_PLACE = "report_place"
_RECORD = ("report string, os string, run string, attempt string, section string, schema string, rows bigint, "
           "seq bigint, committed_at string")


class ReportHistory:
    """The runs of all reports under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- writing ---------------------------------------------------------
    def write(self, report: str, sections: dict[str, DataFrame], run: str,
              os_list: Sequence[str] | None = None) -> str:
        """Write and commit all sections of a run.  ``os_list``: the values of
        the sections' ``os`` column that the run speaks for; without it the
        report is not split.  Returns the attempt."""
        attempt = uuid.uuid4().hex[:12]
        names = [*dict.fromkeys(os_list)] if os_list else [ALL]
        records = []
        for section, df in sections.items():
            counts = self._write_section(df, f"{self.path}/{report}/{section}", run, attempt, names, bool(os_list))
            records += [(section, df.schema.json(), o, n) for o, n in counts.items()]
        self._commit(report, run, attempt, records)
        return attempt

    def _write_section(self, df: DataFrame, target: str, run: str, attempt: str, names: list[str],
                       split: bool) -> dict[str, int]:
        os_ = F.col("os") if split else F.lit(ALL)
        seen = Observation()
        counts = [F.count(F.when(os_ == v, F.lit(1))).alias(f"n{i}") for i, v in enumerate(names)]
        (df.withColumn(_PLACE, F.monotonically_increasing_id())  # rises along the section's order
         .withColumns(dict(zip(_PARTS, (os_, F.lit(run), F.lit(attempt)))))
         .observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
         .write.mode("append").partitionBy(*_PARTS).parquet(target))
        found = {v: seen.get[f"n{i}"] for i, v in enumerate(names)}
        if sum(found.values()) != seen.get["rows"]:
            raise ValueError(f"{target}: rows of an OS that the run does not speak for")
        return found

    def _commit(self, report: str, run: str, attempt: str, records: list[tuple]) -> None:
        """The record is one file, which appears as a whole."""
        now, at = time.time_ns(), datetime.now(timezone.utc).isoformat(timespec="seconds")
        rows = [(report, o, run, attempt, section, schema, n, now, at) for section, schema, o, n in records]
        (self.spark.createDataFrame(rows, _RECORD).coalesce(1).write.mode("append")
         .parquet(f"{self.path}/{report}/runs"))

    # ---- reading ---------------------------------------------------------
    def records(self, report: str) -> DataFrame:
        """The record in force of each (OS, run): that of its last attempt."""
        path = f"{self.path}/{report}/runs"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], _RECORD)
        rows = self.spark.read.schema(_RECORD).parquet(path)
        last = (rows.groupBy("os", "run").agg(F.max(F.struct("seq", "attempt")).alias("last"))
                .select("os", "run", "last.seq", "last.attempt"))
        return rows.join(last, ["os", "run", "seq", "attempt"], "left_semi").select(*rows.columns)

    def runs(self, report: str) -> DataFrame:
        """``os, run, committed_at, sections, rows`` of each run in force."""
        return (self.records(report).groupBy("os", "run", "committed_at")
                .agg(F.count(F.lit(1)).alias("sections"), F.sum("rows").alias("rows")))

    def read(self, report: str, section: str, run: str | None = None, os_name: str | None = None,
             history: bool = False) -> DataFrame:
        """Rows of a section in its order: of the run committed last for each
        OS, of ``run``, or of all runs (``history``: with ``report_os`` and
        ``report_run``)."""
        found = self.records(report).where(F.col("section") == section)
        if os_name is not None:
            found = found.where(F.col("os") == os_name)
        if run is not None:
            found = found.where(F.col("run") == run)
        elif not history:
            newest = F.row_number().over(Window.partitionBy("os").orderBy(F.col("seq").desc()))
            found = found.withColumn("newest", newest).where(F.col("newest") == 1).drop("newest")
        records = found.collect()  # one per OS and run
        if not records:
            raise LookupError(f"no committed run of {report}, {section}")
        schema = T.StructType.fromJson(json.loads(max(records, key=lambda r: r["seq"])["schema"]))
        full = T.StructType([*schema.fields, T.StructField(_PLACE, T.LongType()),
                             *[T.StructField(c, T.StringType()) for c in _PARTS]])
        path = f"{self.path}/{report}/{section}"
        if sum(r["rows"] for r in records):
            # a filter on folders; an attempt may be in force for one OS and replaced for another
            chosen = F.lit(False)
            for o in sorted({r["os"] for r in records}):
                chosen |= (F.col(_PARTS[0]) == o) & F.col(_PARTS[2]).isin(
                    [r["attempt"] for r in records if r["os"] == o])
            rows = self.spark.read.schema(full).parquet(path).where(chosen)
        else:
            rows = self.spark.createDataFrame([], full)
        extra = _PARTS[:2] if history else ()
        return rows.orderBy(*_PARTS[:2], _PLACE).select(*schema.names, *extra)

    def missing(self, report: str) -> DataFrame:
        """Sections whose files hold fewer or more rows than was committed:
        ``section, os, run, rows, found``."""
        records = self.records(report)
        parts = []
        for section in [r[0] for r in records.select("section").distinct().orderBy("section").collect()]:
            path = f"{self.path}/{report}/{section}"
            own = records.where(F.col("section") == section).select("section", "os", "run", "attempt", "rows")
            names = [T.StructField(c, T.StringType()) for c in _PARTS]
            if any("=" in f for f in folders(self.spark, path)):
                rows = self.spark.read.schema(T.StructType([T.StructField(_PLACE, T.LongType()), *names])).parquet(path)
            else:
                rows = self.spark.createDataFrame([], T.StructType(names))
            n = rows.groupBy(*_PARTS).agg(F.count(F.lit(1)).alias("found")).toDF("os", "run", "attempt", "found")
            parts.append(own.join(n, ["os", "run", "attempt"], "left")
                         .withColumn("found", F.coalesce("found", F.lit(0))).where("found <> rows")
                         .select("section", "os", "run", "rows", "found"))
        out = self.spark.createDataFrame([], "section string, os string, run string, rows bigint, found bigint")
        for p in parts:
            out = out.unionByName(p)
        return out

    # ---- cleaning up -----------------------------------------------------
    def vacuum(self, report: str, older_than_s: float = 24 * 3600) -> int:
        """Delete attempts that are not in force and that nothing was written
        to for ``older_than_s`` seconds (a run may be under way).  Returns how
        many partitions went."""
        keep = {(partition_folder(self.spark, _PARTS[0], r["os"]), r["attempt"])
                for r in self.records(report).select("os", "attempt").distinct().collect()}
        root, gone = f"{self.path}/{report}", 0
        before = time.time() * 1000 - older_than_s * 1000
        for section in folders(self.spark, root):
            if section == "runs":
                continue
            for os_ in folders(self.spark, f"{root}/{section}"):
                for run in folders(self.spark, f"{root}/{section}/{os_}"):
                    for attempt in folders(self.spark, f"{root}/{section}/{os_}/{run}"):
                        path = f"{root}/{section}/{os_}/{run}/{attempt}"
                        if (os_, attempt.partition("=")[2]) not in keep and modified_ms(self.spark, path) <= before:
                            delete(self.spark, path)
                            gone += 1
        return gone
