"""Text renderings of names and numbers, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def short_hostname(c) -> Column:
    """Lower-case host name up to the first dot; NULL when the name starts
    with a dot (a regex substring that does not match is NULL)."""
    return F.lower(F.regexp_substr(_c(c), F.lit("^[^.]+")))


def number_fixed2(c) -> Column:
    """Two decimals, leading zero kept: 0.58 -> '0.58', 100 -> '100.00'."""
    return F.round(_c(c).cast("decimal(38,10)"), 2).cast("decimal(38,2)").cast("string")


def number_plain(c) -> Column:
    """A number as the repository prints it without a format: no leading
    zero and no trailing zeros (0.63 -> '.63', 2 -> '2', 14.10 -> '14.1')."""
    s = _c(c).cast("decimal(38,2)").cast("string")
    s = F.regexp_replace(s, r"\.?0+$", "")
    return F.regexp_replace(s, r"^(-?)0\.", "$1.")
