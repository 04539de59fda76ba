from datetime import datetime

from fleetlens.params import Params
from fleetlens.plans.context import ReportRun
from fleetlens.sources.tables import tables_from_rows

AS_OF = datetime(2026, 3, 1, 0, 0)


def host(name, os_="Linux", ver="v1"):
    return (name, "host", os_, ver, name)


def hr(name, ts, avg, metric_column="cpuUtil"):
    return (name, "host", "Load", metric_column, ts, avg)


def run_of(spark, params=None, **rows):
    return ReportRun(tables_from_rows(spark, **rows), params or Params(as_of=AS_OF))


def rows(df):
    return [r.asDict() for r in df.collect()]
