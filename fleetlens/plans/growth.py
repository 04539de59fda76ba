"""Monthly database growth over the last months (current month included)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.dates import day_label, month_label
from fleetlens.functions.numbers import as_double, growth_pct
from fleetlens.operators.aggregates import agg_monthly_avg, pivot_sum
from fleetlens.operators.filters import month_window_filter, positive_filter, type_in_filter
from fleetlens.operators.joins import in_inventory, inventory_join
from fleetlens.operators.windows import lag_prev
from fleetlens.params import DB_TARGET_TYPES, GROWTH_COLUMNS
from fleetlens.plans.context import ReportRun


def db_size_monthly(run: ReportRun, inventory: DataFrame | None = None) -> DataFrame:
    """Monthly average of the daily allocated and used size per database (of
    ``inventory``, if given), 2 places, one row per database and month."""
    p = run.p
    d = run.t.daily.where(F.col("metric_name") == "DATABASE_SIZE")
    d = type_in_filter(type_in_filter(d, "target_type", DB_TARGET_TYPES), "metric_column", GROWTH_COLUMNS)
    if inventory is not None:
        d = in_inventory(d, inventory, "target_name", "database_name")
    d = positive_filter(month_window_filter(d, p.as_of, p.growth_months_back), "maximum")
    monthly = agg_monthly_avg(d, ("target_name",), p.value_scale)
    return pivot_sum(monthly, ["target_name", "month_dt"], "metric_column", F.col("avg_value"),
                     {"USED_GB": "used_gb", "ALLOCATED_GB": "allocated_gb"})


def with_previous_month(monthly: DataFrame) -> DataFrame:
    """Previous row's sizes per database.  One database has a handful of
    months, so the window partitions are tiny whatever the fleet size."""
    return lag_prev(monthly, "target_name", "month_dt",
                    {"allocated_gb": "prev_allocated_gb", "used_gb": "prev_used_gb"})


def db_growth_monthly(run: ReportRun, os_list=None) -> DataFrame:
    """Per inventory database and month: allocated and used GB and their
    growth in percent against the previous month present."""
    p = run.p
    inv = run.members(p.os_list if os_list is None else os_list, "database_name")
    g = inventory_join(with_previous_month(db_size_monthly(run, inv)), inv, "target_name", "database_name")
    a, u = F.col("allocated_gb"), F.col("used_gb")
    return run.ordered(g.select(
        "target_name", "server", "os",
        day_label("month_dt").alias("month_dt"), month_label("month_dt").alias("month_label"),
        as_double(F.coalesce(a, F.lit(0))).alias("allocated_gb"),
        as_double(F.coalesce(u, F.lit(0))).alias("used_gb"),
        as_double(growth_pct(a, "prev_allocated_gb", p.growth_noise_floor)).alias("allocated_growth_pct"),
        as_double(growth_pct(u, "prev_used_gb", p.growth_noise_floor)).alias("used_growth_pct"),
    ), "os", "target_name", "server", "month_dt")
