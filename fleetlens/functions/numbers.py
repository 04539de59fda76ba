"""Exact-number helpers: readings in integer units, text to number,
growth ratio."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_NUMBER_TYPE = "decimal(38,10)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Readings on the hot path (the hourly series) are held as whole numbers of
# 10^-scale units in a BIGINT: the conversion is one multiply and a rint
# per row (a DECIMAL cast goes through text), sums of them are exact long
# additions, and only aggregated values are turned back into DECIMAL.
def to_units(c, scale: int = 6) -> Column:
    """A reading as a count of 10^-scale units (BIGINT), for sums and printed
    values; tests are made on the stored reading.  A reading that is not a
    finite number is missing (:func:`finite`); a finite one beyond the BIGINT
    range fails the job."""
    return F.rint(finite(c) * F.lit(float(10 ** scale))).cast("bigint")


def finite(c) -> Column:
    """The stored reading; NULL if it is NaN or infinite (binary exports)."""
    return F.when(F.abs(_c(c)) < float("inf"), _c(c))


def at_least(c, cutoff) -> Column:
    """A finite reading at or above ``cutoff``, as plain predicates on the
    stored column, so that a filter reaches the scan."""
    return (_c(c) >= F.lit(float(cutoff))) & (_c(c) < F.lit(float("inf")))


def wide_sum(c) -> Column:
    """Sum of per-group long sums that cannot overflow."""
    return F.sum(_c(c).cast("decimal(24,0)"))


def from_units(c, scale: int = 6) -> Column:
    """Units back to the exact DECIMAL reading."""
    return _c(c).cast("decimal(24,0)") * F.lit(Decimal(1).scaleb(-scale))


def units_avg2(sum_units, n, scale: int = 6) -> Column:
    """round(sum / n, 2) in reading terms, exact: the quotient keeps 14
    decimals before rounding half away from zero."""
    den = _c(n).cast("decimal(24,0)") * F.lit(10 ** scale)
    return F.round(_c(sum_units).cast("decimal(24,0)") / den.cast("decimal(24,0)"), 2)


def _dec(c, digits: int = 38) -> Column:
    return _c(c).cast(f"decimal({digits},0)")


def square_sums(u) -> list[Column]:
    """Sums from which :func:`square_sum` puts the exact sum of squares of a
    BIGINT together: ``u = a * 2**31 + b``, so ``u * u`` is ``a * a * 2**62 +
    a * b * 2**32 + b * b``.  ``a`` is 0 for every reading of a usual size, so
    what is done per row is long arithmetic."""
    a, b = F.shiftright(_c(u), 31), _c(u).bitwiseAND(F.lit((1 << 31) - 1))
    far = a != 0
    bb = b * b
    return [F.coalesce(F.sum(F.when(far, _dec(a, 10) * _dec(a, 10))), F.lit(0).cast("decimal(30,0)")).alias("sq_aa"),
            F.coalesce(F.sum(F.when(far, _dec(a, 10) * _dec(b, 10))), F.lit(0).cast("decimal(30,0)")).alias("sq_ab"),
            F.coalesce(F.sum(F.shiftright(bb, 31)), F.lit(0)).alias("sq_hi"),
            F.coalesce(F.sum(bb.bitwiseAND(F.lit((1 << 31) - 1))), F.lit(0)).alias("sq_lo")]


def square_sum() -> Column:
    """The exact sum of squares from the columns of :func:`square_sums`; NULL
    beyond 38 digits."""
    def times(c: str, power: int) -> Column:
        return F.try_multiply(_dec(c), _dec(F.lit(Decimal(1 << power)), 19))
    parts = [times("sq_ab", 32), times("sq_hi", 31), _dec("sq_lo")]
    total = times("sq_aa", 62)
    for part in parts:
        total = _dec(F.try_add(total, part))
    return total


def units_stddev2(sum_units, n, squares, scale: int = 6) -> Column:
    """Sample standard deviation of unit readings, in reading terms, 2
    places; 0 (not NULL) for a single reading.  ``n * sum(u * u) - sum(u)**2`` is
    exact, whatever order the sums came in, and only the root is a double."""
    n_ = _dec(n, 20)
    spread = F.try_subtract(_dec(F.try_multiply(n_, _dec(squares))), _dec(F.try_multiply(_dec(sum_units, 19),
                                                                                        _dec(sum_units, 19))))
    pairs = _c(n).cast("double") * (_c(n) - 1).cast("double")
    sd = F.sqrt(spread.cast("double") / F.when(_c(n) > 1, pairs)) / F.lit(float(10 ** scale))
    return F.round(F.when(_c(n) == 1, F.lit(0.0)).otherwise(sd), 2)


def text_to_number(c, strict: bool = True) -> Column:
    """A text metric value as an exact number.  Strict mode fails the job on
    text that is not a number (ANSI cast); tolerant mode gives NULL."""
    c = _c(c)
    return c.cast(TEXT_NUMBER_TYPE) if strict else c.try_cast(TEXT_NUMBER_TYPE)


def as_double(c) -> Column:
    return _c(c).cast("double")


def growth_pct(cur, prev, floor: str = "0.01") -> Column:
    """Month-over-month growth in percent, 2 decimals.  0 when there is no
    previous value, it is not positive, or the change is not above the
    noise floor.  Inputs are DECIMAL, so 7.31 -> 7.32 is exactly 0.01."""
    cur, prev = _c(cur), _c(prev)
    diff = (cur - prev).cast("decimal(16,2)")
    moved = F.abs(diff) > F.lit(Decimal(floor))
    # narrow types keep 18 exact decimals in the quotient before rounding
    ratio = F.round(diff * F.lit(Decimal(100)) / prev.cast("decimal(16,2)"), 2)
    return (F.when(prev.isNotNull() & (prev > 0) & moved, ratio)
            .otherwise(F.lit(0)).cast("decimal(38,2)"))
