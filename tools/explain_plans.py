"""Print the physical plan of each report over a day-partitioned parquet
copy of the relations (what a repository export looks like).

    python tools/explain_plans.py [sf_dir] > docs/plans.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlens.plans.context import ReportRun  # noqa: E402
from fleetlens.registry import REPORT_PLANS, cpu_params, growth_params  # noqa: E402
from fleetlens.session import ensure_checkpoint_dir, local_session  # noqa: E402
from fleetlens.sources import testmap  # noqa: E402
from fleetlens.sources.tables import materialize_tables  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    text = re.sub(r"file:[^,\]]+", "<root>", text)           # scratch paths
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    return text


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    root = f"{ensure_checkpoint_dir(spark)}/fleetlens-explain-{uuid.uuid4().hex[:8]}"
    mat = materialize_tables(testmap.load(spark, sf_dir), root)
    for key, (fn, is_growth) in REPORT_PLANS.items():
        p = growth_params() if is_growth else cpu_params()
        print(f"### {key}\n")
        print(plan_text(fn(ReportRun(mat, p))))


if __name__ == "__main__":
    main(sys.argv)
