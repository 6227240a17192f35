"""Rounded averages, exact rounding of whole-unit ratios, and guarded statistics.

Averages are taken over the values as they are and only the result is rounded. Minutes
of deviation are ratios of whole seconds and are rounded on integers (HALF_UP), so a
value such as 59.46 / 12 does not depend on how a double represents it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def units(col, scale: int) -> Column:
    """Value scaled by 10**scale as an exact BIGINT (e.g. scale 2 -> cents)."""
    c = _c(col)
    if scale == 0:
        return F.round(c).cast("long")
    return F.round(c * F.lit(float(10 ** scale))).cast("long")


def floor_div(num: Column, den: Column) -> Column:
    """Integer floor division (den > 0), exact for BIGINT operands."""
    return F.call_function("div", num - F.pmod(num, den), den)


def half_up_div(num: Column, den: Column) -> Column:
    """num / den rounded HALF_UP (away from zero) to an integer; den > 0."""
    two_den = den * F.lit(2)
    pos = floor_div(num * F.lit(2) + den, two_den)
    neg = -floor_div(-num * F.lit(2) + den, two_den)
    return F.when(num >= 0, pos).otherwise(neg)


def rounded_avg(col, digits: int = 2) -> Column:
    """Aggregate: avg(col) rounded to `digits`; NULLs are left out, a NaN makes it NaN.

    The mean is first rounded to ten digits: (24.99 + 30.0) / 2 is 27.494999999999997 as a
    double, and sums in another order differ in such digits, so without it the result
    could depend on the partitioning."""
    return F.round(F.round(F.avg(_c(col)), 10), digits)


def not_nan(col) -> Column:
    """The value, or NULL where it is NaN (for the summaries that skip missing readings)."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def corr_safe(a, b, digits: int = 6) -> Column:
    """Pearson correlation over the rows where both values are present; NULL (not an
    error) for a constant column or fewer than two such rows."""
    both = _c(a).isNotNull() & _c(b).isNotNull()
    a, b = F.when(both, _c(a)), F.when(both, _c(b))
    denom = F.stddev_samp(a) * F.stddev_samp(b)
    return F.round(F.covar_samp(a, b) / F.nullif(denom, F.lit(0.0)), digits)


# Correlation verdict thresholds and labels.
CORR_STRONG = 0.3
VERDICT_POSITIVE = "positive"
VERDICT_NEGATIVE = "negative"
VERDICT_WEAK = "weak"
VERDICT_UNDEFINED = "undefined"


def corr_verdict(c) -> Column:
    c = _c(c)
    return (F.when(c.isNull(), F.lit(VERDICT_UNDEFINED))
            .when(c > CORR_STRONG, F.lit(VERDICT_POSITIVE))
            .when(c < -CORR_STRONG, F.lit(VERDICT_NEGATIVE))
            .otherwise(F.lit(VERDICT_WEAK)))
