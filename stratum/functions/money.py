"""Money arithmetic that stays exact until the last step.

Money is ``decimal(10,2)`` in Silver.  Sums stay decimal; averages and
ratios are rounded half-up on integer cents, and only the final value is
emitted as ``double``.  This avoids double-rounding (``avg`` of a decimal
is first rounded to 6 places) and makes results independent of summation
order, so partial aggregates can be combined in any order on a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    """Exact integer cents of a non-null decimal(…,2) value."""
    return (c * 100).cast("bigint")


def div_round_half_up(num: Column, den: Column) -> Column:
    """round(num / den) half-up for integers num >= 0, den > 0; NULL when den is 0 or NULL."""
    d = F.when(den > 0, den.cast("decimal(38,0)"))
    n = num.cast("decimal(38,0)")
    return int_div(F.lit(2).cast("decimal(38,0)") * n + d, F.lit(2).cast("decimal(38,0)") * d)


def int_div(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative integers.

    ``a - a % b`` is a multiple of ``b``; dividing as decimal(38,0) keeps
    every digit (a double would round above 2^53, i.e. ~9e13 in money).
    """
    a, b = a.cast("decimal(38,0)"), b.cast("decimal(38,0)")
    return ((a - a % b) / b).cast("decimal(38,0)").cast("bigint")


def money_sum(c: Column) -> Column:
    """SUM of a money column as double (exact decimal sum, one final cast)."""
    return F.sum(c).cast("double")


def money_avg(c: Column) -> Column:
    """AVG of a money column rounded half-up to cents, as double."""
    s = F.sum(cents(c))
    n = F.count(c)
    return (div_round_half_up(s, n).cast("double") / 100)


def money_ratio(total: Column, count: Column) -> Column:
    """total / count rounded half-up to cents (total money, count integer)."""
    return div_round_half_up(cents(total), count.cast("bigint")).cast("double") / 100


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; NULL when whole is 0 (plain IEEE ops)."""
    return F.when(whole != 0, part.cast("double") * 100.0 / whole.cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))
