"""Threshold classifiers (the domain logic of the reports).

Each returns a Column built from ``when/otherwise``; NULL input falls to the
last branch, as a searched CASE does.  Callers decide whether the input is
the raw or the rounded value: the snapshot classifies raw readings, weekly
trend and top consumers classify rounded aggregates, the health checks
classify values rounded to an integer (or to 2 places for tablespaces).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: colours, badges, actions,
# status classes and the fallback text of the tablespace list.
RED = "#dc3545"
ORANGE = "#fd7e14"
YELLOW = "#ffc107"
DARK = "#212529"
BADGE_CRITICAL = "CRITICAL"
BADGE_WARNING = "WARNING"
BADGE_NORMAL = "NORMAL"
STATUS_ELEVATED = "ELEVATED"
ACTION_RCA = "RCA REQUIRED"
ACTION_REVIEW = "REVIEW"
ACTION_OPTIMIZE = "OPTIMIZE"
ACTION_TRACK = "TRACK"
CLASS_CRITICAL = "critical"
CLASS_WARNING = "warning"
CLASS_NORMAL = "normal"
CLASS_OK = "ok"
CLASS_LOW = "low"
NO_TABLESPACE_TEXT = "No tablespace used 85% above"
ASM_NOT_APPLICABLE_TEXT = "Not Applicable for AIX Servers"
PATTERN_HINT_TEXT = "Check for recurring HH:MI pattern"
RCA_INCIDENTS = 10
REVIEW_INCIDENTS = 5


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snapshot_colour(v, high=90, warn=80, elevated=50) -> Column:
    v = _c(v)
    return (F.when(v >= high, RED).when(v >= warn, ORANGE)
            .when(v >= elevated, YELLOW).otherwise(DARK))


def snapshot_badge(v, high=90, warn=80) -> Column:
    v = _c(v)
    return F.when(v >= high, BADGE_CRITICAL).when(v >= warn, BADGE_WARNING).otherwise(BADGE_NORMAL)


def snapshot_status4(v, high=90, warn=80, elevated=50) -> Column:
    """Four classes, with the ELEVATED band the legend describes."""
    v = _c(v)
    return (F.when(v >= high, BADGE_CRITICAL).when(v >= warn, BADGE_WARNING)
            .when(v >= elevated, STATUS_ELEVATED).otherwise(BADGE_NORMAL))


def peak_colour(v, high=90, warn=80) -> Column:
    v = _c(v)
    return F.when(v >= high, RED).when(v >= warn, ORANGE).otherwise(DARK)


def avg_colour(v, warn=80, elevated=50) -> Column:
    """Averages use a lower scale than peaks: >=80 red, >=50 orange."""
    v = _c(v)
    return F.when(v >= warn, RED).when(v >= elevated, ORANGE).otherwise(DARK)


def incident_colour(n) -> Column:
    return F.when(_c(n) > 0, RED).otherwise(DARK)


def action(incidents, avg, elevated=50) -> Column:
    n, a = _c(incidents), _c(avg)
    return (F.when(n >= RCA_INCIDENTS, ACTION_RCA).when(n >= REVIEW_INCIDENTS, ACTION_REVIEW)
            .when(a >= elevated, ACTION_OPTIMIZE).otherwise(ACTION_TRACK))


def asm_status(pct_int, crit=90, warn=80) -> Column:
    v = _c(pct_int)
    return F.when(v >= crit, CLASS_CRITICAL).when(v >= warn, CLASS_WARNING).otherwise(CLASS_NORMAL)


def tablespace_status(max_pct, crit=90, warn=85) -> Column:
    v = F.coalesce(_c(max_pct), F.lit(0))
    return F.when(v >= crit, CLASS_CRITICAL).when(v >= warn, CLASS_WARNING).otherwise(CLASS_OK)


def host_cpu_status(pct_int, crit=90, warn=80) -> Column:
    v = _c(pct_int)
    return F.when(v >= crit, CLASS_CRITICAL).when(v >= warn, CLASS_WARNING).otherwise(CLASS_LOW)
