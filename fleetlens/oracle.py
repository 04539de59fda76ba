"""DuckDB SQL for every registered query: the independent check.

Each statement rebuilds the five monitoring relations from the driver's
tables (the same mapping as :mod:`fleetlens.sources.testmap`, written again
in SQL) and then states the report in plain SQL.  DuckDB divides decimals
in binary floating point, so exact quotients (averages, ratios) are rounded
here with integer arithmetic: ``round(n / d, 2)`` half away from zero is
``sign(n) * ((|n| * 200 + d) // (2 d)) / 100``.
"""

from __future__ import annotations

CPU_AS_OF = "TIMESTAMP '2024-01-25 12:30:00'"
GROWTH_AS_OF = "DATE '2001-07-15'"
DB_TYPES = "('rac_database', 'oracle_database', 'oracle_pdb')"


# ---- expression helpers ---------------------------------------------------
def host(u: str) -> str:
    return (f"concat('Srv', CASE WHEN ({u}) % 4 = 0 THEN '-P-' ELSE '-d-' END, "
            f"lpad(cast(({u}) AS VARCHAR), 5, '0'), '.example.com')")


def os_of(k: str) -> str:
    return f"CASE WHEN ({k}) % 3 = 0 THEN 'AIX' ELSE 'Linux' END"


def db(b: str) -> str:
    return f"concat('DB', lpad(cast(({b}) AS VARCHAR), 3, '0'))"


def dbtype(b: str) -> str:
    return (f"CASE ({b}) % 3 WHEN 0 THEN 'oracle_database' WHEN 1 THEN 'rac_database' "
            f"ELSE 'oracle_pdb' END")


def short(c: str) -> str:
    return f"lower(nullif(regexp_extract({c}, '^[^.]+'), ''))"


def fixed2(c: str) -> str:
    return f"cast(cast(round(cast({c} AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS VARCHAR)"


def plain(c: str) -> str:
    return (f"regexp_replace(regexp_replace(cast(cast({c} AS DECIMAL(38,2)) AS VARCHAR), "
            f"'\\.?0+$', ''), '^(-?)0\\.', '\\1.')")


def _rint(n: str, d: str) -> str:
    """Integer of round(n / d, 2) * 100, half away from zero (d > 0)."""
    return f"(sign({n}) * ((abs({n}) * 200 + ({d})) // (2 * ({d}))))"


def rdiv(n: str, d: str) -> str:
    """round(n / d, 2) as DOUBLE for HUGEINT n, d (NULL when d = 0)."""
    return f"(CASE WHEN ({d}) = 0 THEN NULL ELSE {_rint(n, d)} END)::DOUBLE / 100"


def rdiv_dec(n: str, d: str) -> str:
    """round(n / d, 2) as DECIMAL(38,2)."""
    return f"(CASE WHEN ({d}) = 0 THEN NULL ELSE cast({_rint(n, d)} AS DECIMAL(38,0)) * 0.01 END)"


def scaled(x: str, s: int = 6) -> str:
    return f"cast(({x}) * {10 ** s} AS HUGEINT)"


def ravg(x: str) -> str:
    """Exact round(avg(x), 2) as DOUBLE for a DECIMAL(18,6) column."""
    return rdiv(scaled(f"sum({x})"), f"count({x}) * {10 ** 6}")


def ravg_dec(x: str) -> str:
    return rdiv_dec(scaled(f"sum({x})"), f"count({x}) * {10 ** 6}")


def r2(x: str) -> str:
    """round(x, 2) of an exact decimal, as DOUBLE."""
    return f"cast(round({x}, 2) AS DOUBLE)"


def growth(c: str, p: str) -> str:
    return (f"CASE WHEN {p} IS NOT NULL AND {p} > 0 AND abs({c} - {p}) > 0.01 "
            f"THEN {rdiv(f'cast(({c} - {p}) * 10000 AS HUGEINT)', f'cast({p} * 100 AS HUGEINT)')} "
            f"ELSE 0 END")


def stddev0(x: str) -> str:
    """Sample standard deviation of a DECIMAL(18,6) column, from whole-number
    moments; 0 for one value."""
    u = scaled(x)
    spread = f"(count({x}) * sum({u} * {u}) - sum({u}) * sum({u}))"
    return (f"(CASE WHEN count({x}) = 1 THEN 0.0 WHEN count({x}) > 1 THEN "
            f"sqrt(cast({spread} AS DOUBLE) / (cast(count({x}) AS DOUBLE) * (count({x}) - 1))) / 1000000 END)")


def badge(v: str) -> str:
    return f"CASE WHEN {v} >= 90 THEN 'CRITICAL' WHEN {v} >= 80 THEN 'WARNING' ELSE 'NORMAL' END"


def status4(v: str) -> str:
    return (f"CASE WHEN {v} >= 90 THEN 'CRITICAL' WHEN {v} >= 80 THEN 'WARNING' "
            f"WHEN {v} >= 50 THEN 'ELEVATED' ELSE 'NORMAL' END")


def snap_colour(v: str) -> str:
    return (f"CASE WHEN {v} >= 90 THEN '#dc3545' WHEN {v} >= 80 THEN '#fd7e14' "
            f"WHEN {v} >= 50 THEN '#ffc107' ELSE '#212529' END")


def peak_colour(v: str) -> str:
    return f"CASE WHEN {v} >= 90 THEN '#dc3545' WHEN {v} >= 80 THEN '#fd7e14' ELSE '#212529' END"


def avg_colour(v: str) -> str:
    return f"CASE WHEN {v} >= 80 THEN '#dc3545' WHEN {v} >= 50 THEN '#fd7e14' ELSE '#212529' END"


def inc_colour(n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN '#dc3545' ELSE '#212529' END"


def action(n: str, a: str) -> str:
    return (f"CASE WHEN {n} >= 10 THEN 'RCA REQUIRED' WHEN {n} >= 5 THEN 'REVIEW' "
            f"WHEN {a} >= 50 THEN 'OPTIMIZE' ELSE 'TRACK' END")


def hc_status(v: str, low: str) -> str:
    return f"CASE WHEN {v} >= 90 THEN 'critical' WHEN {v} >= 80 THEN 'warning' ELSE '{low}' END"


def ts_status(v: str) -> str:
    return (f"CASE WHEN coalesce({v}, 0) >= 90 THEN 'critical' "
            f"WHEN coalesce({v}, 0) >= 85 THEN 'warning' ELSE 'ok' END")


def minute(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M')"


def dayl(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def week_end(c: str) -> str:
    return f"(cast(date_trunc('week', {c}) AS DATE) + 6)"


def monthl(c: str) -> str:
    return f"upper(strftime({c}, '%b-%Y'))"


def num(c: str) -> str:
    return f"cast({c} AS DECIMAL(38,10))"


# ---- the monitoring relations, rebuilt in SQL ----------------------------
_BASE = f"""
users AS (SELECT DISTINCT user_id AS u FROM events),
dbs AS (SELECT DISTINCT cast(c_custkey // 10 AS INTEGER) AS b FROM customer),
mon_target AS (
  SELECT {host('u')} AS target_name, 'host' AS target_type, {os_of('u')} AS type_qualifier1,
         concat('v', cast(u % 3 AS VARCHAR)) AS type_qualifier2, {host('u')} AS host_name FROM users
  UNION ALL
  SELECT concat('Idle-d-', lpad(cast(s_suppkey AS VARCHAR), 5, '0'), '.example.com'), 'host',
         {os_of('s_suppkey')}, 'v0',
         concat('Idle-d-', lpad(cast(s_suppkey AS VARCHAR), 5, '0'), '.example.com')
  FROM supplier
  UNION ALL
  SELECT {db('b')}, {dbtype('b')}, concat('19.', cast(b % 5 AS VARCHAR)), NULL, {host('b')} FROM dbs
  UNION ALL
  SELECT concat('+ASM_', lpad(cast(u AS VARCHAR), 5, '0')), 'osm_instance', NULL, NULL, {host('u')}
  FROM users
),
hour_groups AS (
  SELECT user_id AS u, date_trunc('hour', ts) - (user_id % 4) * INTERVAL 5 DAY AS h, avg(value) AS a
  FROM events GROUP BY 1, 2
),
mon_metric_hourly AS (
  SELECT {host('u')} AS target_name, 'host' AS target_type, 'Load' AS metric_name,
         'cpuUtil' AS metric_column, h AS rollup_timestamp,
         CASE WHEN u % 10 = 7 THEN 50.0 + a * 0.05
              ELSE least(100.0, a * (1 + u % 5) * 0.4) END AS average
  FROM hour_groups
  UNION ALL
  SELECT {host('u')}, 'host', 'Load', 'memUsedPct', h, 99.0 FROM hour_groups WHERE u % 2 = 0
),
mon_metric_daily AS (
  SELECT {db('o_custkey // 10')} AS target_name, {dbtype('o_custkey // 10')} AS target_type,
         'DATABASE_SIZE' AS metric_name, 'USED_GB' AS metric_column, o_orderdate AS rollup_timestamp,
         CASE WHEN o_orderkey % 50 = 0 THEN 0.0 ELSE o_totalprice / 1000 END AS maximum
  FROM orders
  UNION ALL
  SELECT {db('o_custkey // 10')}, {dbtype('o_custkey // 10')}, 'DATABASE_SIZE', 'ALLOCATED_GB',
         o_orderdate,
         CASE WHEN (o_custkey // 10) % 2 = 0 THEN 1000.0 + (o_custkey // 10)
              ELSE o_totalprice / 500 END
  FROM orders
),
last_value AS (SELECT user_id AS u, max_by(value, event_id) AS v FROM events GROUP BY 1),
dg AS (
  SELECT concat('+ASM_', lpad(cast(s_suppkey AS VARCHAR), 5, '0')) AS target_name,
         concat('DG', cast(s_suppkey AS VARCHAR)) AS key_value,
         cast(abs(s_acctbal) % 100 AS DECIMAL(10,2)) AS p, 102400 + s_suppkey * 1024 AS tot
  FROM supplier
),
mon_metric_current AS (
  SELECT {host('u')} AS target_name, 'Load' AS metric_name, 'cpuUtil' AS metric_column,
         ' ' AS key_value,
         cast(cast(CASE u WHEN 1 THEN 85.0 WHEN 2 THEN 79.5 WHEN 3 THEN 89.5
                   ELSE least(100.0, cast(v AS DECIMAL(18,2)) * 0.9) END AS DECIMAL(10,2)) AS VARCHAR) AS value
  FROM last_value
  UNION ALL SELECT target_name, 'DiskGroup_Usage', 'percent_used', key_value, cast(p AS VARCHAR) FROM dg
  UNION ALL SELECT target_name, 'DiskGroup_Usage', 'total_mb', key_value, cast(tot AS VARCHAR) FROM dg
  UNION ALL SELECT target_name, 'DiskGroup_Usage', 'free_mb', key_value,
         cast(cast(cast(tot AS DECIMAL(20,0)) * (100 - p) * 0.01 AS DECIMAL(18,2)) AS VARCHAR) FROM dg
),
ts_base AS (
  SELECT *, cast(p_partkey // 13 AS INTEGER) AS b,
         CASE WHEN p_partkey % 97 = 96 THEN cast(0 AS BIGINT) ELSE cast(5000 AS BIGINT) * 1048576 END AS size
  FROM part
),
mon_db_tablespaces AS (
  SELECT {db('b')} AS target_name, {host('b')} AS host_name,
         concat('TS', lpad(cast(p_partkey AS VARCHAR), 6, '0')) AS tablespace_name,
         'ONLINE' AS status, 'PERMANENT' AS contents, size AS tablespace_size,
         cast(size * p_size * (CASE b % 3 WHEN 0 THEN 60 WHEN 1 THEN 88 ELSE 100 END) / 5000 AS BIGINT)
           AS tablespace_used_size,
         TIMESTAMP '2024-01-31 00:00:00' AS collection_timestamp
  FROM ts_base
)"""

# Relations derived from the five (shared by the mapped and the stored form).
_DERIVED = f"""
hosts AS (
  SELECT target_name, type_qualifier1 AS os_type FROM mon_target
  WHERE target_type = 'host' AND upper(target_name) LIKE '%-D-%'
),
cpu_all AS (
  SELECT target_name, rollup_timestamp, average, cast(average AS DECIMAL(18,6)) AS cpu_val
  FROM mon_metric_hourly
  WHERE metric_name = 'Load' AND metric_column = 'cpuUtil' AND target_type = 'host'
),
inv AS (
  SELECT d.target_name AS database_name, d.type_qualifier1 AS database_version,
         o.target_name AS server, o.type_qualifier1 AS os, o.type_qualifier2 AS os_version
  FROM mon_target d, mon_target o
  WHERE d.host_name = o.target_name AND d.target_type IN {DB_TYPES}
    AND o.target_type = 'host' AND o.type_qualifier1 IN ('AIX', 'Linux')
)"""


def since(days: int, as_of: str = CPU_AS_OF) -> str:
    return f"rollup_timestamp BETWEEN {as_of} - INTERVAL {days} DAY AND {as_of}"


def semi(days: int) -> str:
    """Fleet CPU rows in the last ``days`` days (semi join)."""
    return (f"(SELECT * FROM cpu_all WHERE {since(days)} "
            f"AND target_name IN (SELECT target_name FROM hosts))")


def inner(days: int) -> str:
    return (f"(SELECT c.*, h.os_type FROM cpu_all c JOIN hosts h ON c.target_name = h.target_name "
            f"WHERE {since(days)})")


def q(body: str, extra: str = "") -> str:
    """A statement over the driver's tables (mapping + derived relations)."""
    ctes = _BASE + "," + _DERIVED + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def over_stored(sql: str) -> str:
    """The same statement over stored ``mon_*`` relations (views of that
    name must exist): the mapping CTEs are dropped, the derived kept."""
    head = "WITH " + _BASE + ","
    assert head in sql
    return sql.replace(head, "WITH ", 1)


# ---- reports ---------------------------------------------------------------
def _consumers(os_upper: str) -> str:
    return q(f"""
SELECT target_name, {short('target_name')} AS hostname, os_type,
       cast(avg2 AS DOUBLE) AS avg_cpu, cast(min2 AS DOUBLE) AS min_cpu, cast(max2 AS DOUBLE) AS max_cpu,
       stddev_cpu, incidents, {action('incidents', 'avg2')} AS action,
       {avg_colour('avg2')} AS avg_colour, {peak_colour('max2')} AS max_colour,
       {inc_colour('incidents')} AS incident_colour
FROM (
  SELECT target_name, os_type, {ravg_dec('cpu_val')} AS avg2, round(min(cpu_val), 2) AS min2,
         round(max(cpu_val), 2) AS max2, round({stddev0('cpu_val')}, 2) AS stddev_cpu,
         count(CASE WHEN average >= 98 THEN 1 END) AS incidents
  FROM {inner(30)} c WHERE upper(os_type) = '{os_upper}'
  GROUP BY target_name, os_type
) s
ORDER BY max2 DESC NULLS FIRST, avg2 DESC NULLS FIRST, target_name
LIMIT 20""")


def _snapshot_body(cols: str) -> str:
    return f"""
SELECT {cols}
FROM hosts h
LEFT JOIN (
  SELECT target_name, rollup_timestamp AS ts, cpu_val AS v, average AS raw,
         row_number() OVER (PARTITION BY target_name ORDER BY rollup_timestamp DESC, average DESC NULLS LAST) AS rn
  FROM {semi(2)} x
) l ON h.target_name = l.target_name AND l.rn = 1"""


SNAPSHOT_COLS = (f"h.target_name, {short('h.target_name')} AS hostname, h.os_type, "
                 f"cast(round(coalesce(l.v, 0), 2) AS DOUBLE) AS cpu_pct, {badge('l.raw')} AS status, "
                 f"{snap_colour('l.raw')} AS colour, coalesce({minute('l.ts')}, 'N/A') AS last_measured, "
                 f"{status4('l.raw')} AS status4")


def reports() -> dict[str, str]:
    return {
        "cpu_dashboard_kpis": q(f"""
SELECT count(DISTINCT target_name) AS total_hosts, {ravg('cpu_val')} AS avg_cpu,
       {r2('max(cpu_val)')} AS max_cpu,
       count(CASE WHEN average >= 98 THEN 1 END) AS spike_count,
       count(DISTINCT CASE WHEN average >= 98 THEN target_name END) AS hosts_with_spikes
FROM {semi(30)} c"""),
        "cpu_current_snapshot": q(_snapshot_body(SNAPSHOT_COLS)),
        "cpu_spike_days": q(f"""
SELECT {dayl('d')} AS spike_day, hosts_affected, incident_count, peak_cpu FROM (
  SELECT cast(rollup_timestamp AS DATE) AS d, count(DISTINCT target_name) AS hosts_affected,
         count(*) AS incident_count, {r2('max(cpu_val)')} AS peak_cpu
  FROM {semi(30)} c WHERE average >= 98 GROUP BY 1) t
ORDER BY spike_day DESC"""),
        "cpu_weekly_trend": q(f"""
SELECT {dayl('w')} AS week_end, {ravg('cpu_val')} AS avg_cpu, {r2('max(cpu_val)')} AS max_cpu,
       count(CASE WHEN average >= 98 THEN 1 END) AS spike_count,
       {peak_colour('round(max(cpu_val), 2)')} AS colour
FROM (SELECT *, {week_end('rollup_timestamp')} AS w FROM {semi(30)} c) t
GROUP BY w ORDER BY week_end DESC"""),
        "cpu_top_spike_events": q(f"""
SELECT target_name, {short('target_name')} AS hostname, os_type,
       {minute('rollup_timestamp')} AS event_ts, {r2('cpu_val')} AS cpu_pct, rn,
       'Check for recurring HH:MI pattern' AS pattern_hint
FROM (
  SELECT *, row_number() OVER (ORDER BY average DESC, rollup_timestamp DESC, target_name) AS rn
  FROM {inner(30)} c WHERE average >= 98
) r WHERE rn <= 50 ORDER BY rn"""),
        "cpu_top_consumers_linux": _consumers("LINUX"),
        "cpu_top_consumers_aix": _consumers("AIX"),
        "db_host_inventory": q("SELECT * FROM inv ORDER BY database_name"),
        "asm_diskgroup_usage": q(f"""
SELECT i.database_name, i.server, i.os, g.target_name, g.key_value AS diskgroup,
       g.total_gb, g.free_gb, cast(g.pct2 AS DOUBLE) AS used_pct,
       {hc_status('g.pct_int', 'normal')} AS status
FROM (
  SELECT target_name, key_value,
         max(CASE WHEN metric_column = 'percent_used' THEN round({num('value')}, 0) END) AS pct_int,
         max(CASE WHEN metric_column = 'percent_used' THEN round({num('value')}, 2) END) AS pct2,
         {rdiv(scaled(f"max(CASE WHEN metric_column = 'total_mb' THEN {num('value')} END)", 10), f'1024 * {10 ** 10}')} AS total_gb,
         {rdiv(scaled(f"max(CASE WHEN metric_column = 'free_mb' THEN {num('value')} END)", 10), f'1024 * {10 ** 10}')} AS free_gb
  FROM mon_metric_current
  WHERE metric_name = 'DiskGroup_Usage' AND metric_column IN ('percent_used', 'free_mb', 'total_mb')
  GROUP BY target_name, key_value HAVING count(*) > 0
) g
JOIN mon_target mt ON g.target_name = mt.target_name AND mt.target_type = 'osm_instance'
JOIN inv i ON mt.host_name = i.server
WHERE i.os = 'Linux'"""),
        "asm_not_applicable": q(
            "SELECT 'AIX' AS os, 'Not Applicable for AIX Servers' AS status FROM (SELECT count(*) FROM inv) n"),
        "tablespace_attention": q(f"""
SELECT i.database_name, s.host_name, i.server, i.os, s.critical_tablespaces,
       cast(s.max_used AS DOUBLE) AS max_used_pct,
       CASE WHEN coalesce(s.critical_tablespaces, 0) > 0 THEN s.tablespace_list
            ELSE 'No tablespace used 85% above' END AS tablespace_list,
       {ts_status('s.max_used')} AS status
FROM tss s JOIN inv i ON s.target_name = i.database_name""", TSU),
        "host_cpu_current": q(f"""
SELECT i.database_name, i.server, i.os, {r2(num('c.value'))} AS cpu_pct,
       {hc_status(f"round({num('c.value')}, 0)", 'low')} AS status
FROM (SELECT DISTINCT target_name, value FROM mon_metric_current
      WHERE metric_name = 'Load' AND metric_column = 'cpuUtil') c
JOIN inv i ON c.target_name = i.server"""),
        "db_growth_monthly": q(f"""
SELECT g.target_name, i.server, i.os, {dayl('month_dt')} AS month_dt, {monthl('month_dt')} AS month_label,
       cast(coalesce(allocated_gb, 0) AS DOUBLE) AS allocated_gb,
       cast(coalesce(used_gb, 0) AS DOUBLE) AS used_gb,
       {growth('allocated_gb', 'pa')} AS allocated_growth_pct,
       {growth('used_gb', 'pu')} AS used_growth_pct
FROM growth_lag g JOIN inv i ON g.target_name = i.database_name""", GROWTH_CTES),
        "cpu_recurring_pattern": q(f"""
SELECT s.target_name, {short('s.target_name')} AS hostname, {minute('s.rollup_timestamp')} AS event_ts,
       {r2('s.cpu_val')} AS cpu_pct, cast(s.spike_hour AS BIGINT) AS spike_hour, h.days_at_hour,
       CASE WHEN h.days_at_hour >= 3
            THEN concat('Recurring batch @ ', lpad(cast(s.spike_hour AS VARCHAR), 2, '0'), ':00')
            ELSE 'Isolated' END AS pattern_hint
FROM spk s JOIN (
  SELECT target_name, spike_hour, count(DISTINCT cast(rollup_timestamp AS DATE)) AS days_at_hour
  FROM spk GROUP BY 1, 2) h
ON s.target_name = h.target_name AND s.spike_hour = h.spike_hour""",
                                   f"spk AS (SELECT *, hour(rollup_timestamp) AS spike_hour FROM {semi(30)} c WHERE average >= 98)"),
        "cpu_spike_batches": q(f"""
SELECT b.target_name, {short('b.target_name')} AS hostname, {minute('first_ts')} AS start_ts,
       {minute('last_ts')} AS last_spike_ts, strftime(first_ts, '%H:%M') AS start_hhmi,
       date_diff('minute', first_ts, last_ts) + 60 AS length_minutes, samples, {r2('peak')} AS peak_cpu,
       CASE WHEN open_start THEN 0 ELSE days_at_start END AS days_at_start, open_start, open_end,
       CASE WHEN NOT open_start AND days_at_start >= 3
            THEN concat('Recurring batch @ ', strftime(first_ts, '%H:%M')) ELSE 'Isolated' END AS pattern_hint
FROM islands b LEFT JOIN (
  SELECT target_name, strftime(first_ts, '%H:%M') AS hhmi, count(DISTINCT cast(first_ts AS DATE)) AS days_at_start
  FROM islands WHERE NOT open_start GROUP BY 1, 2) d
ON b.target_name = d.target_name AND strftime(b.first_ts, '%H:%M') = d.hhmi""",
                               f"""instants AS (
  SELECT target_name, rollup_timestamp AS ts, max(cpu_val) AS v FROM {semi(30)} c WHERE average >= 98 GROUP BY 1, 2),
marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 60 MINUTE THEN 0 ELSE 1 END AS new
  FROM instants WINDOW w AS (PARTITION BY target_name ORDER BY ts)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY target_name ORDER BY ts) AS island FROM marked),
islands AS (
  SELECT target_name, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS samples, max(v) AS peak,
         min(ts) < {CPU_AS_OF} - INTERVAL 30 DAY + INTERVAL 60 MINUTE AS open_start,
         max(ts) + INTERVAL 60 MINUTE > {CPU_AS_OF} AS open_end
  FROM numbered GROUP BY target_name, island)"""),
        "cpu_rolling_7d": q(f"""
SELECT {dayl('d')} AS day, {rdiv(scaled('s'), 'n * 1000000')} AS daily_avg_cpu,
       {rdiv(scaled('ws'), 'wn * 1000000')} AS rolling_avg_cpu, days_in_window
FROM (
  SELECT d, s, n, sum(s) OVER w AS ws, sum(n) OVER w AS wn, count(*) OVER w AS days_in_window
  FROM (SELECT cast(rollup_timestamp AS DATE) AS d, sum(cpu_val) AS s, count(cpu_val) AS n
        FROM {semi(30)} c GROUP BY 1) t
  WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
) x ORDER BY day"""),
        "cpu_elevated_hosts": q(_snapshot_body(
            f"h.target_name, {short('h.target_name')} AS hostname, h.os_type, "
            f"cast(round(coalesce(l.v, 0), 2) AS DOUBLE) AS cpu_pct, {badge('l.raw')} AS status, "
            f"{status4('l.raw')} AS status4")),
    }


# exact used percent: round(used * 100 / size, 2)
TSU = f"""tsu AS (
  SELECT target_name, host_name, tablespace_name, tablespace_size, tablespace_used_size,
         {rdiv_dec('cast(tablespace_used_size AS HUGEINT) * 100', 'cast(tablespace_size AS HUGEINT)')} AS used_percent
  FROM mon_db_tablespaces WHERE tablespace_size > 0),
over_cutoff AS (SELECT * FROM tsu WHERE used_percent >= 85),
tss AS (
  SELECT d.target_name, d.host_name, count(o.tablespace_name) AS critical_tablespaces,
         max(o.used_percent) AS max_used,
         listagg(concat(o.tablespace_name, '(', {plain('o.used_percent')}, '%)'), ', '
                 ORDER BY o.used_percent DESC, o.tablespace_name)
           FILTER (WHERE o.tablespace_name IS NOT NULL) AS tablespace_list
  FROM (SELECT DISTINCT target_name, host_name FROM tsu) d
  LEFT JOIN over_cutoff o ON o.target_name = d.target_name AND o.host_name = d.host_name
  GROUP BY d.target_name, d.host_name)"""

# Sizes by month, used and allocated side by side; each month against the
# latest earlier month that the database has.
GROWTH_CTES = f"""size_rows AS (
  SELECT target_name, metric_column, cast(maximum AS DECIMAL(18,6)) AS gb,
         make_date(year(rollup_timestamp), month(rollup_timestamp), 1) AS month_dt
  FROM mon_metric_daily
  WHERE maximum > 0 AND metric_name = 'DATABASE_SIZE' AND target_type IN {DB_TYPES}
    AND rollup_timestamp BETWEEN date_trunc('month', {GROWTH_AS_OF}) - INTERVAL 6 MONTH AND {GROWTH_AS_OF}),
used_sizes AS (
  SELECT target_name, month_dt, {ravg_dec('gb')} AS used_gb
  FROM size_rows WHERE metric_column = 'USED_GB' GROUP BY ALL),
allocated_sizes AS (
  SELECT target_name, month_dt, {ravg_dec('gb')} AS allocated_gb
  FROM size_rows WHERE metric_column = 'ALLOCATED_GB' GROUP BY ALL),
growth_pivot AS (
  SELECT target_name, month_dt, used_gb, allocated_gb
  FROM used_sizes FULL JOIN allocated_sizes USING (target_name, month_dt)),
growth_lag AS (
  SELECT g.*, earlier.allocated_gb AS pa, earlier.used_gb AS pu
  FROM growth_pivot g ASOF LEFT JOIN growth_pivot earlier
    ON g.target_name = earlier.target_name AND g.month_dt > earlier.month_dt)"""


def oracle_sql() -> dict[str, str]:
    out = reports()
    from fleetlens.oracle_ops import operator_sql  # finer operators
    out.update(operator_sql())
    from fleetlens.oracle_html import html_sql
    out.update(html_sql())
    from fleetlens.registry import BUCKETED_KEYS, ROLLUP_KEYS
    # the same questions, answered from day partials and from relations in buckets
    out.update({f"rollup_{k}": out[k] for k in ROLLUP_KEYS})
    out.update({f"bucketed_{k}": out[k] for k in BUCKETED_KEYS})
    return out
