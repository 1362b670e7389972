"""Rounding on whole units, equal in every engine and for every row order.

A price is counted in cents, a return in 1/10000 percent. Sums of whole units
are exact, so a mean does not depend on how Spark split the rows; the one
division rounds to a whole unit, half away from zero, in long arithmetic.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_DIGITS = 2
RETURN_DIGITS = 4


def to_units(value: Column, digits: int) -> Column:
    """Whole units of ``10**-digits`` of a value with at most ``digits`` decimals."""
    if digits == 0:
        return value.cast("long")
    # Such a product is a whole number but for floating noise, which rint removes
    # without the decimal detour that Spark's round takes.
    return F.rint(value * float(10**digits)).cast("long")


def from_units(units: Column, digits: int) -> Column:
    return units / F.lit(float(10**digits))


def round_to(value: Column, digits: int) -> Column:
    """Any double, rounded half away from zero to ``digits`` decimals."""
    return F.round(value * float(10**digits)) / F.lit(float(10**digits))


def divide(part: Column, whole: Column) -> Column:
    """Quotient of whole numbers, rounded half away from zero; NULL for divisor zero."""
    size = F.nullif(F.abs(whole), F.lit(0).cast("long"))
    quotient = F.call_function("div", F.abs(part) * 2 + size, size * 2)
    return F.when((part < 0) != (whole < 0), -quotient).otherwise(quotient)


def mean_of_units(total: Column, count: Column, digits: int) -> Column:
    """Mean of ``count`` values whose units add up to ``total``; NULL for none."""
    return from_units(divide(total, count), digits)


def exact_sum(units: Column) -> Column:
    """Aggregate: sum of longs that may exceed a long, as a decimal.

    The upper bits and the lower 20 bits are summed apart: long additions for each
    row, and decimals only for each group. Good for groups of up to 8e12 rows.
    """
    upper, lower = F.shiftright(units, 20), units.bitwiseAND(F.lit(2**20 - 1))
    return F.sum(upper).cast("decimal(20,0)") * 2**20 + F.sum(lower)


def mean(value: Column, digits: int) -> Column:
    """Aggregate: mean of values with at most ``digits`` decimals, nulls skipped."""
    units = to_units(value, digits)
    # A group has no bound on its rows, so its sum may exceed a long.
    return mean_of_units(exact_sum(units), F.count(units), digits)


def ratio_of_units(part: Column, whole: Column, digits: int) -> Column:
    """Quotient of two counts of equal units, rounded; NULL for divisor zero."""
    return from_units(divide(part * 10**digits, whole), digits)


def percent_of_units(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, both counts of equal units, rounded."""
    return from_units(divide(part * 10 ** (digits + 2), whole), digits)


def stddev(value: Column, digits: int) -> Column:
    """Aggregate: sample deviation of values with at most ``digits`` decimals.

    From exact sums, with one root at the end; NULL for fewer than two values. Good
    for values of up to 12 digits.
    """
    units = to_units(value, digits)
    exact = units.cast("decimal(12,0)")
    n, total, squares = F.count(units), exact_sum(units), F.sum(exact * exact)
    spread = (squares * n - total * total).cast("double")
    pairs = F.nullif(n * (n - 1), F.lit(0).cast("long"))
    return from_units(F.round(F.sqrt(spread / pairs.cast("double"))), digits)
