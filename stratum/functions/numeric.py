"""Exact, engine-independent numeric helpers.

Double sums depend on the order rows arrive in, so two engines (or two runs
with different partitioning) can disagree in the last bit. Money is therefore
summed as DECIMAL(18,2), which is exact, and every rounded figure goes through
DECIMAL(38,10) so that rounding is half-up on a decimal value, never on a
binary fraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    """A double amount as an exact two-decimal value."""
    return _c(col).cast(MONEY)


def rounded(x: Column | str, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` in DOUBLE; NULL stays NULL.

    Casting a double to DECIMAL, or ``round`` on a double, is done differently
    by different engines near .5 boundaries; this form is plain IEEE
    arithmetic, so every engine (and every run) produces the same bits.
    """
    scale = float(10 ** digits)
    return (F.floor(_c(x).cast("double") * F.lit(scale) + F.lit(0.5)).cast("double")
            / F.lit(scale))


def cents(col: Column | str) -> Column:
    """A two-decimal amount as exact integer cents (LONG)."""
    return F.rint(_c(col).cast("double") * F.lit(100.0)).cast("long")


def from_cents(total: Column) -> Column:
    """Integer cents back to a DOUBLE amount (the nearest double to the exact sum)."""
    return total.cast("double") / F.lit(100.0)


def exact_sum(col: Column | str) -> Column:
    """Order-independent sum of a money column, as DOUBLE."""
    return from_cents(F.sum(cents(col)))


def exact_mean(col: Column | str) -> Column:
    """Mean of a money column from its exact sum; NULL for an empty group."""
    return F.try_divide(exact_sum(col), F.count(_c(col)).cast("double"))


def rounded_ratio(num: Column | str, den: Column | str, digits: int,
                  scale: float = 1.0) -> Column:
    """``round(scale * num / den, digits)`` with NULL instead of a division error."""
    q = F.try_divide(_c(num).cast("double") * F.lit(float(scale)), _c(den).cast("double"))
    return rounded(q, digits)


def pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """Percentage ``100 * num / den`` rounded half-up."""
    return rounded_ratio(num, den, digits, scale=100.0)


def flag_sum(cond: Column) -> Column:
    """``sum(cast(cond as int))``: rows where ``cond`` holds (NULL counts as 0)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def pct_decimal(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """``round(100.0 * num / den, digits)`` in DECIMAL, as SQL engines with a
    decimal ``100.0`` literal compute it (half-up on the exact quotient)."""
    return F.round(F.expr("100.0") * _c(num) / _c(den), digits)


def mean_decimal(col: Column | str, digits: int) -> Column:
    """``round(avg(x), digits)`` with ``avg`` over DECIMAL values, half-up."""
    return F.round(F.avg(_c(col)), digits)
