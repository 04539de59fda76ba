"""Run parameters of the reports (one frozen object per run)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# Fixed values that must equal the reference's for the same report:
# severity cutoffs, spike threshold, windows, list sizes and fleet pattern.
HIGH_CUTOFF = 90
WARN_CUTOFF = 80
ELEVATED_CUTOFF = 50
SPIKE_THRESHOLD = 98
LOOKBACK_DAYS = 30
SNAPSHOT_DAYS = 2
EVENTS_DAYS = 30
EVENTS_K = 50
CONSUMERS_K = 20
FLEET_NAME_LIKE = "%-D-%"
GROWTH_MONTHS_BACK = 6
OS_LIST = ("AIX", "Linux")
TABLESPACE_WARN = 85
TABLESPACE_CRITICAL = 90
HEALTH_WARN = 80
HEALTH_CRITICAL = 90
GROWTH_NOISE_FLOOR = "0.01"
DB_TARGET_TYPES = ("rac_database", "oracle_database", "oracle_pdb")
DISKGROUP_COLUMNS = ("percent_used", "free_mb", "total_mb")
GROWTH_COLUMNS = ("ALLOCATED_GB", "USED_GB")


@dataclass(frozen=True)
class Params:
    """All knobs of a run.  ``as_of`` replaces the database clock: every
    relative window is measured back from it, so a run is repeatable."""

    as_of: datetime = field(default_factory=lambda: datetime(2024, 1, 31))
    lookback_days: int = LOOKBACK_DAYS
    spike_threshold: float = SPIKE_THRESHOLD
    snapshot_days: int = SNAPSHOT_DAYS
    events_days: int = EVENTS_DAYS
    events_k: int = EVENTS_K
    consumers_k: int = CONSUMERS_K
    name_like: str = FLEET_NAME_LIKE
    growth_months_back: int = GROWTH_MONTHS_BACK
    os_list: tuple[str, ...] = OS_LIST
    high_cutoff: float = HIGH_CUTOFF
    warn_cutoff: float = WARN_CUTOFF
    elevated_cutoff: float = ELEVATED_CUTOFF
    tablespace_warn: float = TABLESPACE_WARN
    tablespace_critical: float = TABLESPACE_CRITICAL
    health_warn: float = HEALTH_WARN
    health_critical: float = HEALTH_CRITICAL
    growth_noise_floor: str = GROWTH_NOISE_FLOOR
    # re-aimed reports (described by the reference, not computed there)
    recurring_min_days: int = 3
    rolling_days: int = 7
    # sums and printed values count readings in BIGINT units of
    # 10^-value_scale; tests are made on the stored reading
    value_scale: int = 6

    def __post_init__(self):
        for name in ("lookback_days", "snapshot_days", "events_days", "events_k",
                     "consumers_k", "recurring_min_days", "rolling_days"):
            if int(getattr(self, name)) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.growth_months_back < 0:
            raise ValueError("growth_months_back must not be negative")
        if not 0 <= self.value_scale <= 9:
            raise ValueError("value_scale must be between 0 and 9")
        if not self.os_list:
            raise ValueError("os_list must name at least one OS")
