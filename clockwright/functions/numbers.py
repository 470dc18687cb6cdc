"""Hours, money, identifiers and feature values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from clockwright import settings


def money(amount: Column) -> Column:
    """Two decimals, half up on the shortest decimal text of the double."""
    return F.round(amount, 2)


def regular_hours(worked: Column) -> Column:
    return F.least(worked, F.lit(settings.DAILY_REGULAR_HOURS))


def overtime_hours(worked: Column) -> Column:
    return F.greatest(worked - F.lit(settings.DAILY_REGULAR_HOURS), F.lit(0.0))


def regular_pay(worked: Column, rate: Column) -> Column:
    return money(regular_hours(worked) * rate)


def overtime_pay(worked: Column, rate: Column) -> Column:
    return money(overtime_hours(worked) * rate * F.lit(settings.OVERTIME_MULTIPLIER))


def gross_pay(regular: Column, overtime: Column) -> Column:
    """Sum of the rounded parts, rounded again."""
    return money(regular + overtime)


def clip(value: Column, low: float, high: float) -> Column:
    if low > high:
        raise ValueError(f"clip range is reversed: {low} > {high}")
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))


def numbered_id(kind: str, number: Column) -> Column:
    """Prefix and number, zero-padded to a minimum width; numbers start at one."""
    prefix, width = settings.ID_FORMATS[kind]
    text = F.when(number >= 1, number.cast("string")).otherwise(
        F.raise_error(F.concat(F.lit(f"{kind} number must be at least 1, got "),
                               F.coalesce(number.cast("string"), F.lit("NULL")))).cast("string"))
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def zero_if_not_finite(value: Column) -> Column:
    number = value.cast("double")
    bad = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.coalesce(F.when(~bad, number), F.lit(0.0))


def largest_column(names: tuple[str, ...]) -> Column:
    """Name of the column with the largest value; the first one wins a tie."""
    best = F.greatest(*[F.col(n) for n in names])
    first, *rest = names
    return reduce(lambda acc, n: acc.when(F.col(n) == best, F.lit(n)), rest,
                  F.when(F.col(first) == best, F.lit(first)))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Zero where the deviation is zero or unknown."""
    return F.coalesce(F.when(std != 0.0, (value - mean) / std), F.lit(0.0))


def round3(value: Column) -> Column:
    """Three decimals, nearest by the exact binary value, exact ties to even.

    ``round`` decides ties on the shortest decimal text instead, which is wrong
    for values such as 0.0625 or 1.0005.  Splitting the value in two halves makes
    the distance to the nearest half step exact.
    """
    steps = F.rint(value * 2000.0)
    high = value * 134217729.0 - (value * 134217729.0 - value)
    beyond = (high * 2000.0 - steps) + (value - high) * 2000.0
    below, above = (steps - 1.0) / 2.0, (steps + 1.0) / 2.0
    thousandths = (
        F.when(F.pmod(steps, F.lit(2.0)) == 0.0, steps / 2.0)
        .when(beyond > 0.0, above)
        .when(beyond < 0.0, below)
        .when(F.pmod(below, F.lit(2.0)) == 0.0, below)
        .otherwise(above)
    )
    return thousandths / 1000.0


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
