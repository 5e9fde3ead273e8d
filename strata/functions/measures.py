"""Money sums and exact rounding.

Sums of doubles depend on the order rows arrive in, so the same query can
print different cents on two runs.  Money is therefore summed as
``decimal(18,2)`` (exact, order-free, and still a fixed-width aggregation
buffer) and turned back into a double only at the end.

Averages that are reported rounded are computed from integer numerators and
denominators and rounded half away from zero with integer division, so the
result does not depend on floating-point summation order either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    """A money value as an exact decimal with cents."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact partial sum of money; combine further with ``F.sum`` again."""
    return F.sum(money(c))


def to_money_double(decimal_sum: str | Column) -> Column:
    """Round a decimal money sum to cents and return it as a double."""
    decimal_sum = F.col(decimal_sum) if isinstance(decimal_sum, str) else decimal_sum
    return F.round(decimal_sum, 2).cast("double")


def rounded_ratio(num: str | Column, den: str | Column, scale: int) -> Column:
    """``round(num / den, scale)`` half away from zero, exactly, for integers.

    ``num`` and ``den`` are integral (den > 0).  The quotient is formed in
    ``decimal(38,0)`` integer division so large sums cannot overflow; the
    result is ``q / 10**scale`` as a double, which is the same IEEE value in
    every engine because ``q`` is an exact integer (exactly representable
    while ``|num/den| · 10**scale < 2**53``, far above any average reported).
    """
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    den = F.when(den != 0, den)  # x / 0 → NULL, like AVG over no values
    big = "decimal(38,0)"
    # half-up on |num|: floor((2·|num|·10^s + den) / (2·den)), all non-negative
    top = (F.abs(num).cast(big) * F.lit(2 * 10**scale).cast(big) + den.cast(big)).cast(big)
    bottom = (den.cast(big) * F.lit(2).cast(big)).cast(big)
    q = ((top - top % bottom).cast(big) / bottom).cast("long")
    return (F.signum(num) * q / float(10**scale)).cast("double")


def cents_of_days(days_2dp: str | Column) -> Column:
    """A value already rounded to 2 decimals as an exact integer count of hundredths."""
    days_2dp = F.col(days_2dp) if isinstance(days_2dp, str) else days_2dp
    return F.round(days_2dp * 100).cast("long")
