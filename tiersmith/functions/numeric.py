"""Numeric column helpers.

Sums go through DECIMAL where every value of the group fits, so that a result does not depend on the
order in which partial sums meet; a group with larger or finer values is summed as doubles, and no
value is left out. Roundings go through DECIMAL so that a tie such as 2.05 rounds as written.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Unit factors and Epley divisor.
LB_TO_KG = 0.453592
IN_TO_CM = 2.54
EPLEY_DIVISOR = 30

# Six decimals (enough to take off the noise of a product of doubles) and 22 digits before them. What
# does not fit is noticed, never dropped.
SUM_TYPE = "decimal(28,6)"
ROUND_TYPE = "decimal(38,8)"
# A value fits if the decimal is this close to it, relatively.
FIT = 1e-9


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Coercing cast to double: text that is no number becomes null."""
    return col(c).try_cast("double")


def rounded(c: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the decimal value, as a double; numbers beyond it are whole anyway."""
    c = col(c)
    return F.coalesce(F.round(c.try_cast(ROUND_TYPE), digits).cast("double"), c.try_cast("double"))


def _total(c: Column | str, over: WindowSpec | None = None) -> Column:
    value = number(c)
    exact = value.try_cast(SUM_TYPE)
    fits = F.abs(exact.cast("double") - value) <= FIT * F.abs(value)
    parts = [F.max(value.isNotNull() & ~F.coalesce(fits, F.lit(False))), F.try_sum(exact), F.sum(value)]
    misfit, as_decimal, as_double = (p.over(over) if over else p for p in parts)
    return F.when(misfit, as_double).otherwise(F.coalesce(as_decimal.cast("double"), as_double))


def total(c: Column | str) -> Column:
    """Sum as a double, null without values: exact and order-independent where all values fit."""
    return _total(c)


def mean(c: Column | str) -> Column:
    """Mean over the non-null values as a double."""
    return F.try_divide(_total(c), F.count(number(c)))


def mean_over(c: Column | str, window: WindowSpec) -> Column:
    """Mean over the non-null values of a window frame."""
    return F.try_divide(_total(c, window), F.count(number(c)).over(window))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as doubles, null where b is 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def volume(weight: Column | str, reps: Column | str) -> Column:
    return number(weight) * number(reps)


def e1rm(weight: Column | str, reps: Column | str, exact_single: bool = False) -> Column:
    """Estimated one-rep maximum. ``exact_single`` returns the weight itself for one repetition."""
    w, r = number(weight), number(reps)
    estimate = rounded(w * (1 + r / EPLEY_DIVISOR), 1)
    return F.when(r == 1, w).otherwise(estimate) if exact_single else estimate


def kilograms(weight: Column | str, unit: Column | str) -> Column:
    """Weight in kilograms given a unit column; an unknown unit counts as kilograms."""
    pounds = F.lower(F.trim(col(unit))).isin("lbs", "lb", "pounds")
    return F.when(pounds, number(weight) * LB_TO_KG).otherwise(number(weight))


def centimetres(inches: Column | str) -> Column:
    return number(inches) * IN_TO_CM
