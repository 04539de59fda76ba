"""Optional ``html_row`` column: each report row rendered as the table row
the repository scripts print.  NULL columns render as empty text.

Numbers are printed the two ways the scripts print them: ``fixed2`` (two
decimals, leading zero) where the script formats, ``plain`` (no leading
zero, no trailing zeros) where it lets the database convert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import classify as C
from fleetlens.functions.text import number_fixed2 as fx
from fleetlens.functions.text import number_plain as pl
from fleetlens.params import Params

# Fixed values that must equal the reference's: the HTML fragments of each
# report row, in the order they are printed.
TD = "<td>"
TD_END = "</td>"
TR = "<tr>"
TR_END = "</tr>"
TD_HOST = "<td><strong>"
TD_HOST_END = "</strong></td>"
TD_CENTER = '<td style="text-align:center;">'
TD_BOLD_COLOUR = '<td style="text-align:center;font-weight:bold;color:'
TD_BOLD_RED = '<td style="text-align:center;font-weight:bold;color:#dc3545;">'
TD_MUTED = '<td style="text-align:center;color:#6c757d;">'
COLOUR_END = ';">'
PCT_TD_END = "%</td>"
BADGE_OPEN = '<td><span class="badge '
BADGE_CLOSE = "</span></td>"
HINT_CELL = "<td><em>Check for recurring HH:MI pattern</em></td>"
TR_CLASS = '<tr class="'
TR_CLASS_END = '">'
CARD_OPEN = '<div class="metric-card"><div class="metric-value">'
CARD_MID = '</div><div class="metric-label">'
CARD_END = "</div></div>"
NOT_APPLICABLE_ROW = ('<tr class="ok"><td style="text-align: center; padding: 20px; '
                      'font-weight: bold;">Not Applicable for AIX Servers</td></tr>')


def _l(s: str) -> Column:
    return F.lit(s)


def _cat(*parts) -> Column:
    return F.concat_ws("", *[_l(p) if isinstance(p, str) else p for p in parts])


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _badge_class(c: str) -> Column:
    """CSS class of a status or action badge, from its text."""
    x = F.col(c)
    return (F.when(x.isin(C.BADGE_CRITICAL, C.ACTION_RCA), _l("badge-critical"))
            .when(x.isin(C.BADGE_WARNING, C.ACTION_REVIEW, C.ACTION_OPTIMIZE), _l("badge-warning"))
            .otherwise(_l("badge-secondary")))


def kpis_html(p: Params) -> Column:
    d, s = p.lookback_days, p.spike_threshold
    spike_txt = str(int(s)) if float(s).is_integer() else str(s)
    return _cat(CARD_OPEN, _s("total_hosts"), CARD_MID, "Total Hosts Monitored", CARD_END,
                CARD_OPEN, fx("avg_cpu"), "%", CARD_MID, f"Average CPU ({d}d)", CARD_END,
                CARD_OPEN, fx("max_cpu"), "%", CARD_MID, f"Peak CPU ({d}d)", CARD_END,
                CARD_OPEN, _s("spike_count"), CARD_MID, f"Spike Events ≥{spike_txt}%", CARD_END,
                CARD_OPEN, _s("hosts_with_spikes"), CARD_MID, "Hosts With Spikes", CARD_END)


def snapshot_html(p: Params) -> Column:
    return _cat(TR, TD_HOST, F.col("hostname"), TD_HOST_END, TD, F.col("os_type"), TD_END,
                TD_BOLD_COLOUR, F.col("colour"), COLOUR_END, fx("cpu_pct"), PCT_TD_END,
                BADGE_OPEN, _badge_class("status"), '">', F.col("status"), BADGE_CLOSE,
                TD, F.col("last_measured"), TD_END, TR_END)


def spike_days_html(p: Params) -> Column:
    return _cat(TR, TD, F.col("spike_day"), TD_END, TD_CENTER, _s("hosts_affected"), TD_END,
                TD_BOLD_RED, _s("incident_count"), TD_END, TD_BOLD_RED, fx("peak_cpu"), PCT_TD_END,
                TR_END)


def weekly_html(p: Params) -> Column:
    return _cat(TR, TD, F.col("week_end"), TD_END, TD_CENTER, fx("avg_cpu"), PCT_TD_END,
                TD_BOLD_COLOUR, F.col("colour"), COLOUR_END, fx("max_cpu"), PCT_TD_END,
                TD_CENTER, _s("spike_count"), TD_END, TR_END)


def events_html(p: Params) -> Column:
    return _cat(TR, TD_HOST, F.col("hostname"), TD_HOST_END, TD, F.col("os_type"), TD_END,
                TD, F.col("event_ts"), TD_END, TD_BOLD_RED, fx("cpu_pct"), PCT_TD_END,
                HINT_CELL, TR_END)


def consumers_html(p: Params) -> Column:
    badge = F.concat(_badge_class("action"), _l('">'), F.col("action"))
    return _cat(TR, TD_HOST, F.col("hostname"), TD_HOST_END,
                TD_BOLD_COLOUR, F.col("avg_colour"), COLOUR_END, fx("avg_cpu"), PCT_TD_END,
                TD_CENTER, fx("min_cpu"), PCT_TD_END,
                TD_BOLD_COLOUR, F.col("max_colour"), COLOUR_END, fx("max_cpu"), PCT_TD_END,
                TD_MUTED, fx("stddev_cpu"), TD_END,
                TD_BOLD_COLOUR, F.col("incident_colour"), COLOUR_END, _s("incidents"), TD_END,
                BADGE_OPEN, badge, BADGE_CLOSE, TR_END)


def asm_html(p: Params) -> Column:
    return _cat(TR_CLASS, F.col("status"), TR_CLASS_END, TD, F.col("target_name"), TD_END,
                TD, F.col("diskgroup"), TD_END, TD, pl("total_gb"), TD_END,
                TD, pl("free_gb"), TD_END, TD, pl("used_pct"), PCT_TD_END, TR_END)


def tablespace_html(p: Params) -> Column:
    return _cat(TR_CLASS, F.col("status"), TR_CLASS_END, TD, F.col("database_name"), TD_END,
                TD, F.col("host_name"), TD_END, TD, F.col("tablespace_list"), TD_END, TR_END)


def host_cpu_html(p: Params) -> Column:
    return _cat(TR_CLASS, F.col("status"), TR_CLASS_END, TD, F.col("server"), TD_END,
                TD, pl("cpu_pct"), PCT_TD_END, TR_END)


def growth_html(p: Params) -> Column:
    return _cat("<tr><td>", F.col("target_name"), TD_END, TD, F.col("server"), TD_END,
                TD, F.col("month_label"), TD_END, TD, pl("allocated_gb"), TD_END,
                TD, pl("used_gb"), TD_END, TD, pl("allocated_growth_pct"), PCT_TD_END,
                TD, pl("used_growth_pct"), "%</td></tr>")


def not_applicable_html(p: Params) -> Column:
    return _l(NOT_APPLICABLE_ROW)


RENDERERS = {
    "cpu_dashboard_kpis": kpis_html,
    "cpu_current_snapshot": snapshot_html,
    "cpu_spike_days": spike_days_html,
    "cpu_weekly_trend": weekly_html,
    "cpu_top_spike_events": events_html,
    "cpu_top_consumers_linux": consumers_html,
    "cpu_top_consumers_aix": consumers_html,
    "asm_diskgroup_usage": asm_html,
    "asm_not_applicable": not_applicable_html,
    "tablespace_attention": tablespace_html,
    "host_cpu_current": host_cpu_html,
    "db_growth_monthly": growth_html,
}


def render_html_row(df: DataFrame, report: str, params: Params | None = None) -> DataFrame:
    """``df`` with an ``html_row`` column for report ``report``."""
    return df.withColumn("html_row", RENDERERS[report](params or Params()))
