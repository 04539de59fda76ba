"""Report sinks: one dataset per section.

The scripts overwrite the report file once, then append every section to
it.  Here each section is its own dataset under one folder: typed rows as
parquet (overwrite per run, or append to keep history), and optionally the
``html_row`` text of each section.

An overwriting run that is split by a column (``partition_by=("os",)``)
replaces its own partitions only (dynamic partition overwrite): a report for
one OS leaves the other one's.  With ``own`` the run also says which values it
speaks for, and those that have no rows any more lose their partition.  Runs
that are kept side by side, and reports that change as a whole or not at all,
are the business of :mod:`fleetlens.sources.history`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens.sources.files import delete, exists, partition_folder


def _save(df: DataFrame, target: str, mode: str, fmt: str, cols: list[str], own: Sequence[str] | None) -> None:
    """One dataset.  The rows per own value are counted as they are written."""
    own = [*dict.fromkeys(own or ())] if mode == "overwrite" and len(cols) == 1 else []
    seen = Observation()
    if own:
        df = df.observe(seen, *[F.count(F.when(F.col(cols[0]) == v, F.lit(1))).alias(f"v{i}")
                                for i, v in enumerate(own)])
    w = df.write.mode(mode).format(fmt)
    if cols:
        w = w.partitionBy(*cols).option("partitionOverwriteMode", "dynamic")
    w.save(target)
    spark = df.sparkSession
    for i, v in enumerate(own):
        gone = f"{target}/{partition_folder(spark, cols[0], v)}"
        if not seen.get[f"v{i}"] and exists(spark, gone):
            delete(spark, gone)


def write_sections(sections: dict[str, DataFrame], path: str, mode: str = "overwrite",
                   fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                   own: Sequence[str] | None = None) -> list[str]:
    """Write each section to ``path/<name>``; returns the paths written.
    Sections are small report tables, so each is written by as few tasks as
    it has partitions after AQE coalescing; nothing passes the driver.
    ``own``: the values of the one partition column that this run speaks for."""
    out = []
    for name, df in sections.items():
        target = f"{path.rstrip('/')}/{name}"
        _save(df, target, mode, fmt, [c for c in partition_by if c in df.columns], own)
        out.append(target)
    return out


def write_html_rows(sections: dict[str, DataFrame], path: str, mode: str = "overwrite",
                    partition_by: tuple[str, ...] = (), own: Sequence[str] | None = None) -> list[str]:
    """Write the ``html_row`` text of each rendered section, in the section's
    order; ``partition_by=("os",)`` gives one folder per OS."""
    out = []
    for name, df in sections.items():
        target = f"{path.rstrip('/')}/{name}"
        cols = [c for c in partition_by if c in df.columns]
        _save(df.select(*cols, "html_row"), target, mode, "text", cols, own)
        out.append(target)
    return out
