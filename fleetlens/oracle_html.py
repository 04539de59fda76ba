"""DuckDB SQL for the rendered report rows (``html_<report>``)."""

from __future__ import annotations

from fleetlens.oracle import fixed2, plain, reports

# The row markup that the reports must reproduce.
_BADGE = ("CASE WHEN {c} IN ('CRITICAL', 'RCA REQUIRED') THEN 'badge-critical' "
          "WHEN {c} IN ('WARNING', 'REVIEW', 'OPTIMIZE') THEN 'badge-warning' "
          "ELSE 'badge-secondary' END")


def _v(c: str) -> str:
    return f"cast({c} AS VARCHAR)"


def _card(value: str, label: str) -> str:
    return (f"'<div class=\"metric-card\"><div class=\"metric-value\">', {value}, "
            f"'</div><div class=\"metric-label\">{label}</div></div>'")


HTML = {
    "cpu_dashboard_kpis": ", ".join([
        _card(_v("total_hosts"), "Total Hosts Monitored"),
        _card(f"{fixed2('avg_cpu')}, '%'", "Average CPU (30d)"),
        _card(f"{fixed2('max_cpu')}, '%'", "Peak CPU (30d)"),
        _card(_v("spike_count"), "Spike Events ≥98%"),
        _card(_v("hosts_with_spikes"), "Hosts With Spikes")]),
    "cpu_current_snapshot": (
        "'<tr>', '<td><strong>', hostname, '</strong></td>', '<td>', os_type, '</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:', colour, ';\">', "
        f"{fixed2('cpu_pct')}, '%</td>', '<td><span class=\"badge ', {_BADGE.format(c='status')}, "
        "'\">', status, '</span></td>', '<td>', last_measured, '</td>', '</tr>'"),
    "cpu_spike_days": (
        "'<tr>', '<td>', spike_day, '</td>', '<td style=\"text-align:center;\">', "
        f"{_v('hosts_affected')}, '</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:#dc3545;\">', "
        f"{_v('incident_count')}, '</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:#dc3545;\">', "
        f"{fixed2('peak_cpu')}, '%</td>', '</tr>'"),
    "cpu_weekly_trend": (
        "'<tr>', '<td>', week_end, '</td>', '<td style=\"text-align:center;\">', "
        f"{fixed2('avg_cpu')}, '%</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:', colour, ';\">', "
        f"{fixed2('max_cpu')}, '%</td>', '<td style=\"text-align:center;\">', "
        f"{_v('spike_count')}, '</td>', '</tr>'"),
    "cpu_top_spike_events": (
        "'<tr>', '<td><strong>', hostname, '</strong></td>', '<td>', os_type, '</td>', "
        "'<td>', event_ts, '</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:#dc3545;\">', "
        f"{fixed2('cpu_pct')}, '%</td>', "
        "'<td><em>Check for recurring HH:MI pattern</em></td>', '</tr>'"),
    "cpu_top_consumers_linux": (
        "'<tr>', '<td><strong>', hostname, '</strong></td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:', avg_colour, ';\">', "
        f"{fixed2('avg_cpu')}, '%</td>', '<td style=\"text-align:center;\">', "
        f"{fixed2('min_cpu')}, '%</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:', max_colour, ';\">', "
        f"{fixed2('max_cpu')}, '%</td>', '<td style=\"text-align:center;color:#6c757d;\">', "
        f"{fixed2('stddev_cpu')}, '</td>', "
        "'<td style=\"text-align:center;font-weight:bold;color:', incident_colour, ';\">', "
        f"{_v('incidents')}, '</td>', '<td><span class=\"badge ', {_BADGE.format(c='action')}, "
        "'\">', action, '</span></td></tr>'"),
    "asm_diskgroup_usage": (
        "'<tr class=\"', status, '\">', '<td>', target_name, '</td>', '<td>', diskgroup, '</td>', "
        f"'<td>', {plain('total_gb')}, '</td>', '<td>', {plain('free_gb')}, '</td>', "
        f"'<td>', {plain('used_pct')}, '%</td>', '</tr>'"),
    "asm_not_applicable": (
        "'<tr class=\"ok\"><td style=\"text-align: center; padding: 20px; font-weight: bold;\">"
        "Not Applicable for AIX Servers</td></tr>'"),
    "tablespace_attention": (
        "'<tr class=\"', status, '\">', '<td>', database_name, '</td>', '<td>', host_name, '</td>', "
        "'<td>', tablespace_list, '</td>', '</tr>'"),
    "host_cpu_current": (
        "'<tr class=\"', status, '\">', '<td>', server, '</td>', "
        f"'<td>', {plain('cpu_pct')}, '%</td>', '</tr>'"),
    "db_growth_monthly": (
        "'<tr><td>', target_name, '</td>', '<td>', server, '</td>', '<td>', month_label, '</td>', "
        f"'<td>', {plain('allocated_gb')}, '</td>', '<td>', {plain('used_gb')}, '</td>', "
        f"'<td>', {plain('allocated_growth_pct')}, '%</td>', "
        f"'<td>', {plain('used_growth_pct')}, '%</td></tr>'"),
}
HTML["cpu_top_consumers_aix"] = HTML["cpu_top_consumers_linux"]


def html_sql() -> dict[str, str]:
    base = reports()
    out = {f"html_{k}": f"SELECT concat({expr}) AS html_row FROM (\n{base[k]}\n) r"
           for k, expr in HTML.items()}
    out["render_html_row"] = "\nUNION ALL\n".join(
        f"SELECT '{k}' AS section, html_row FROM (\n{out[f'html_{k}']}\n) s" for k in HTML)
    return out
