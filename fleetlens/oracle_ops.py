"""DuckDB SQL for the operator-level queries."""

from __future__ import annotations

from fleetlens.oracle import (GROWTH_AS_OF, GROWTH_CTES, TSU, action, avg_colour, badge, dayl,
                              fixed2, hc_status, inc_colour, inner, minute, monthl, num,
                              peak_colour, plain, q, r2, ravg, ravg_dec, semi, short, since,
                              snap_colour, stddev0, ts_status, week_end, growth)


def _cpu_out(src: str, extra: str = "") -> str:
    return (f"SELECT target_name, {minute('rollup_timestamp')} AS ts_label, "
            f"cast(cpu_val AS DOUBLE) AS cpu_val{extra} FROM {src} x")


_LATEST = f"""latest AS (
  SELECT h.target_name, l.ts, l.v, l.raw FROM hosts h LEFT JOIN (
    SELECT target_name, rollup_timestamp AS ts, cpu_val AS v, average AS raw,
           row_number() OVER (PARTITION BY target_name ORDER BY rollup_timestamp DESC, average DESC NULLS LAST) AS rn
    FROM {semi(2)} y) l ON h.target_name = l.target_name AND l.rn = 1)"""

_STATS = f"""stats AS (
  SELECT target_name, os_type, avg2, min2, max2, stddev_cpu, incidents,
         {action('incidents', 'avg2')} AS action, {avg_colour('avg2')} AS avg_colour,
         {peak_colour('max2')} AS max_colour, {inc_colour('incidents')} AS incident_colour
  FROM (
    SELECT target_name, os_type, {ravg_dec('cpu_val')} AS avg2, round(min(cpu_val), 2) AS min2,
           round(max(cpu_val), 2) AS max2, round({stddev0('cpu_val')}, 2) AS stddev_cpu,
           count(CASE WHEN average >= 98 THEN 1 END) AS incidents
    FROM {inner(30)} c GROUP BY target_name, os_type) s)"""

_DG = """dgr AS (SELECT * FROM mon_metric_current WHERE metric_name = 'DiskGroup_Usage'
        AND metric_column IN ('percent_used', 'free_mb', 'total_mb'))"""

_GROWTH_WIN = (f"rollup_timestamp BETWEEN date_trunc('month', {GROWTH_AS_OF}) - INTERVAL 6 MONTH "
               f"AND {GROWTH_AS_OF}")


def _d(col: str) -> str:
    return f"cast({col} AS DOUBLE)"


def operator_sql() -> dict[str, str]:
    lag_cols = ", ".join(_d(c) + f" AS {c.split('.')[-1]}" for c in
                         ("allocated_gb", "used_gb"))
    return {
        "fleet_filter": q("SELECT * FROM hosts"),
        "metric_filter": q(_cpu_out("cpu_all")),
        "lookback_filter": q(_cpu_out(f"(SELECT * FROM cpu_all WHERE {since(14)})")),
        "month_window_filter": q(f"""
SELECT target_name, metric_column, {dayl('rollup_timestamp')} AS day, maximum
FROM mon_metric_daily WHERE {_GROWTH_WIN}"""),
        "threshold_filter": q(_cpu_out(f"(SELECT * FROM cpu_all WHERE {since(30)} AND average >= 98)")),
        "type_in_filter": q("""
SELECT target_name, target_type, type_qualifier1 FROM mon_target
WHERE target_type IN ('rac_database', 'oracle_database', 'oracle_pdb')"""),
        "positive_filter": q(f"""
SELECT target_name, metric_column, {dayl('rollup_timestamp')} AS day, maximum
FROM mon_metric_daily WHERE maximum IS NOT NULL AND maximum > 0"""),
        "having_filter": q("""
SELECT target_name, key_value, count(*) AS row_count FROM dgr
GROUP BY target_name, key_value HAVING count(*) >= 1""", _DG),
        "distinct_hosts": q("SELECT DISTINCT target_name FROM hosts"),
        "fleet_semi_join": q(_cpu_out(semi(30))),
        "fleet_inner_join": q(_cpu_out(inner(30), ", os_type")),
        "two_key_join": q(_cpu_out("""(
  SELECT h.target_name, h.rollup_timestamp, cast(h.average AS DECIMAL(18,6)) AS cpu_val,
         t.type_qualifier1 AS os_type
  FROM mon_metric_hourly h JOIN mon_target t
    ON h.target_name = t.target_name AND h.target_type = t.target_type
  WHERE h.metric_name = 'Load' AND h.metric_column = 'cpuUtil')""", ", os_type")),
        "latest_left_join": q(f"""
SELECT target_name, cast(v AS DOUBLE) AS cpu_val, {minute('ts')} AS ts_label FROM latest""", _LATEST),
        "self_join_hosts": q("SELECT * FROM inv WHERE os = 'Linux'"),
        "instance_join": q("""
SELECT d.target_name, d.key_value, d.metric_column, d.value, t.host_name AS instance_host
FROM dgr d JOIN mon_target t ON d.target_name = t.target_name AND t.target_type = 'osm_instance'""",
                           _DG),
        "inventory_join": q("""
SELECT i.database_name, i.server, c.value
FROM mon_metric_current c JOIN inv i ON c.target_name = i.server
WHERE c.metric_name = 'Load' AND c.metric_column = 'cpuUtil'"""),
        "agg_global": q(f"""
SELECT count(DISTINCT target_name) AS total_hosts, {ravg('cpu_val')} AS avg_cpu, {r2('max(cpu_val)')} AS max_cpu,
       count(CASE WHEN average >= 98 THEN 1 END) AS spike_count,
       count(DISTINCT CASE WHEN average >= 98 THEN target_name END) AS hosts_with_spikes
FROM {semi(30)} c"""),
        "agg_by_day": q(f"""
SELECT {dayl('d')} AS day, count(DISTINCT target_name) AS hosts_affected, count(*) AS incident_count,
       {r2('max(cpu_val)')} AS peak_cpu
FROM (SELECT *, cast(rollup_timestamp AS DATE) AS d FROM {semi(30)} c WHERE average >= 98) t GROUP BY d"""),
        "agg_by_iso_week": q(f"""
SELECT {dayl('w')} AS week_end, {ravg('cpu_val')} AS avg_cpu, {r2('max(cpu_val)')} AS max_cpu,
       count(CASE WHEN average >= 98 THEN 1 END) AS spike_count
FROM (SELECT *, {week_end('rollup_timestamp')} AS w FROM {semi(30)} c) t GROUP BY w"""),
        "agg_host_stats": q(f"""
SELECT target_name, os_type, {_d('avg2')} AS avg_cpu, {_d('min2')} AS min_cpu,
       {_d('max2')} AS max_cpu, stddev_cpu, incidents FROM stats""", _STATS),
        "agg_conditional_count": q(f"""
SELECT target_name, count(CASE WHEN average >= 98 THEN 1 END) AS incidents
FROM {semi(30)} c GROUP BY target_name"""),
        "agg_conditional_distinct": q(f"""
SELECT {dayl('cast(rollup_timestamp AS DATE)')} AS day,
       count(DISTINCT CASE WHEN average >= 98 THEN target_name END) AS hosts_with_spikes
FROM {semi(30)} c GROUP BY 1"""),
        "agg_distinct_values": q("""
SELECT value, count(*) AS row_count FROM mon_metric_current
WHERE metric_name = 'Load' AND metric_column = 'cpuUtil' GROUP BY value"""),
        "pivot_max": q(f"""
SELECT target_name, key_value,
       {_d(f"max(CASE WHEN metric_column = 'percent_used' THEN {num('value')} END)")} AS percent_used,
       {_d(f"max(CASE WHEN metric_column = 'free_mb' THEN {num('value')} END)")} AS free_mb,
       {_d(f"max(CASE WHEN metric_column = 'total_mb' THEN {num('value')} END)")} AS total_mb
FROM dgr GROUP BY target_name, key_value""", _DG),
        "pivot_sum": q(f"""
SELECT target_name, {dayl('month_dt')} AS month_dt, {_d('used_gb')} AS used_gb,
       {_d('allocated_gb')} AS allocated_gb FROM growth_pivot""", GROWTH_CTES),
        "agg_monthly_avg": q(f"""
SELECT target_name, {dayl('m')} AS month_dt, metric_column,
       {_d(ravg_dec('cast(maximum AS DECIMAL(18,6))'))} AS avg_value
FROM (SELECT *, date_trunc('month', rollup_timestamp) AS m FROM mon_metric_daily
      WHERE metric_name = 'DATABASE_SIZE' AND {_GROWTH_WIN}
        AND maximum IS NOT NULL AND maximum > 0) d
GROUP BY target_name, m, metric_column"""),
        "listagg_ordered": q(f"""
SELECT target_name, host_name, critical_tablespaces, {_d('max_used')} AS max_used, tablespace_list
FROM tss""", TSU),
        "latest_per_host": q(_cpu_out(f"""(
  SELECT target_name, rollup_timestamp, cpu_val FROM (
    SELECT *, row_number() OVER (PARTITION BY target_name ORDER BY rollup_timestamp DESC, average DESC NULLS LAST) AS rn
    FROM {semi(2)} y) z WHERE rn = 1)""")),
        "latest_per_host_rank": q(_cpu_out(f"""(
  SELECT target_name, max(rollup_timestamp) AS rollup_timestamp,
         arg_max(cpu_val, rollup_timestamp) AS cpu_val
  FROM {semi(2)} y GROUP BY target_name)""")),
        "rank_global": q(_cpu_out(f"""(
  SELECT *, row_number() OVER (ORDER BY average DESC, rollup_timestamp DESC, target_name) AS rn
  FROM {semi(30)} y WHERE average >= 98)""", ", rn") + " WHERE rn <= 50"),
        "lag_month": q(f"""
SELECT target_name, {dayl('month_dt')} AS month_dt, {lag_cols},
       {_d('pa')} AS prev_allocated_gb, {_d('pu')} AS prev_used_gb FROM growth_lag""", GROWTH_CTES),
        "top_k": q(f"""
SELECT target_name, os_type, {_d('max2')} AS max_cpu, {_d('avg2')} AS avg_cpu FROM stats
ORDER BY max2 DESC NULLS FIRST, avg2 DESC NULLS FIRST, target_name LIMIT 20""", _STATS),
        "short_hostname": q(f"""
SELECT target_name, target_type, {short('target_name')} AS hostname FROM mon_target"""),
        "number_fixed2": q(f"""
SELECT target_name, {fixed2(_exact_avg_dec('cpu_val'))} AS avg_text,
       {fixed2('min(cpu_val)')} AS min_text
FROM {semi(30)} c GROUP BY target_name"""),
        "number_plain": q(f"""
SELECT target_name, {dayl('month_dt')} AS month_dt,
       {plain('coalesce(allocated_gb, 0)')} AS allocated_text,
       {plain('coalesce(used_gb, 0)')} AS used_text,
       {plain(_growth_dec('used_gb', 'pu'))} AS used_growth_text
FROM growth_lag""", GROWTH_CTES),
        "text_to_number": q(f"""
SELECT target_name, metric_column, key_value, {_d(num('value'))} AS value_num
FROM mon_metric_current"""),
        "date_labels": q(f"""
SELECT target_name, {dayl('rollup_timestamp')} AS day, {minute('rollup_timestamp')} AS minute,
       {monthl('rollup_timestamp')} AS month FROM {semi(30)} c"""),
        "date_buckets": q(f"""
SELECT {dayl('cast(rollup_timestamp AS DATE)')} AS day, {dayl(week_end('rollup_timestamp'))} AS week_end,
       {dayl("date_trunc('month', rollup_timestamp)")} AS month_start, count(*) AS samples
FROM cpu_all WHERE {since(30)} GROUP BY 1, 2, 3"""),
        "unit_conversion": q(f"""
SELECT target_name, tablespace_name,
       {_mb('tablespace_used_size')} AS used_mb, {_mb('tablespace_size')} AS total_mb,
       {_mb('tablespace_size - tablespace_used_size')} AS free_mb,
       {_d('used_percent')} AS used_percent
FROM tsu""", TSU),
        "null_default": q(f"""
SELECT target_name, cast(coalesce(v, 0) AS DOUBLE) AS cpu_or_zero,
       coalesce({minute('ts')}, 'N/A') AS last_measured FROM latest""", _LATEST),
        "classify_snapshot_colour": q(f"SELECT target_name, {snap_colour('raw')} AS colour FROM latest",
                                      _LATEST),
        "classify_snapshot_badge": q(f"SELECT target_name, {badge('raw')} AS status FROM latest", _LATEST),
        "classify_peak_colour": q(f"SELECT target_name, {_d('max2')} AS max_cpu, max_colour FROM stats",
                                  _STATS),
        "classify_avg_colour": q(f"SELECT target_name, {_d('avg2')} AS avg_cpu, avg_colour FROM stats",
                                 _STATS),
        "classify_incident_colour": q("SELECT target_name, incidents, incident_colour FROM stats",
                                      _STATS),
        "classify_action": q(f"SELECT target_name, incidents, {_d('avg2')} AS avg_cpu, action FROM stats",
                             _STATS),
        "classify_asm": q(f"""
SELECT target_name, key_value,
       {hc_status(f"max(CASE WHEN metric_column = 'percent_used' THEN round({num('value')}, 0) END)", 'normal')} AS status
FROM dgr GROUP BY target_name, key_value""", _DG),
        "classify_tablespace": q(f"SELECT target_name, {ts_status('max_used')} AS status FROM tss",
                                 TSU),
        "classify_host_cpu": q(f"""
SELECT target_name, {hc_status(f"round({num('value')}, 0)", 'low')} AS status
FROM mon_metric_current WHERE metric_name = 'Load' AND metric_column = 'cpuUtil'"""),
        "growth_pct": q(f"""
SELECT target_name, {dayl('month_dt')} AS month_dt,
       {growth('allocated_gb', 'pa')} AS allocated_growth_pct,
       {growth('used_gb', 'pu')} AS used_growth_pct FROM growth_lag""", GROWTH_CTES),
    }


def _mb(x: str) -> str:
    from fleetlens.oracle import rdiv
    return rdiv(f"cast({x} AS HUGEINT)", "1048576")


def _exact_avg_dec(x: str) -> str:
    """Exact avg at 10 decimals, rounded half away (the text rounds it to 2)."""
    from fleetlens.oracle import scaled
    n = scaled(f"sum({x})", 6)
    d = f"count({x}) * {10 ** 6}"
    # round(n/d, 10): integer of quotient * 1e10, half away from zero
    return (f"(cast(sign({n}) * ((abs({n}) * {2 * 10 ** 10} + ({d})) // (2 * ({d}))) "
            f"AS DECIMAL(38,0)) * 0.0000000001)")


def _growth_dec(c: str, p: str) -> str:
    from fleetlens.oracle import rdiv_dec
    return (f"CASE WHEN {p} IS NOT NULL AND {p} > 0 AND abs({c} - {p}) > 0.01 "
            f"THEN {rdiv_dec(f'cast(({c} - {p}) * 10000 AS HUGEINT)', f'cast({p} * 100 AS HUGEINT)')} "
            f"ELSE 0 END")
