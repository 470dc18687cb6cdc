"""Exact order statistics without sorting a table in one task."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_SORTABLE = 100_000
_ACCURACY = 10_000


def _numbers(df: DataFrame, column: str) -> DataFrame:
    """The column as ``v``, without NULL and NaN."""
    v = F.col("v")
    kept = df.select(F.col(column).alias("v")).where(v.isNotNull())
    return kept.where(~F.isnan(v)) if kept.schema["v"].dataType.typeName() in ("double", "float") else kept


def order_statistics(df: DataFrame, column: str, first: int, second: int, rows: int | None = None) -> tuple:
    """The values of rank ``first`` and ``second`` (0-based, equal or adjacent).

    Approximate percentiles bracket the ranks, one pass counts how many values
    lie below and on the borders, and the search goes on strictly between them.
    Each round keeps about one part in ``_ACCURACY`` of the values and drops the
    border values whole, so heavy ties end the search rather than prolong it.
    Only scalars reach the driver.  ``df`` is scanned twice per round and should
    be a written table; ``rows`` is the number of its values, if known.
    """
    values = _numbers(df, column)
    below, inside = 0, values.count() if rows is None else rows
    if not (0 <= first <= second <= first + 1 and second < inside):
        raise ValueError(f"ranks {first}, {second} are outside 0..{inside - 1}")
    while inside > _SORTABLE:
        slack = max(2.0 / _ACCURACY, 2.0 / inside)
        low_share = max(0.0, (first - below) / inside - slack)
        high_share = min(1.0, (second - below + 1) / inside + slack)
        low, high = values.select(F.percentile_approx("v", [low_share, high_share], _ACCURACY)).first()[0]
        v = F.col("v")
        counts = values.agg(
            F.count_if(v < low).alias("lt_low"), F.count_if(v <= low).alias("le_low"),
            F.count_if(v < high).alias("lt_high"), F.count_if(v <= high).alias("le_high"),
            F.min(F.when(v > low, v)).alias("after_low"), F.max(F.when(v < high, v)).alias("before_high"),
            F.min(F.when(v > high, v)).alias("after_high"), F.max(F.when(v < low, v)).alias("before_low"),
        ).first()

        def located(rank: int):
            """The value at a rank on or next to a border, if it is that near."""
            at = rank - below
            if counts.lt_low <= at < counts.le_low:
                return low
            if counts.lt_high <= at < counts.le_high:
                return high
            if at == counts.lt_low - 1:
                return counts.before_low
            if at == counts.le_low and counts.after_low is not None:
                return counts.after_low
            if at == counts.lt_high - 1:
                return counts.before_high
            if at == counts.le_high:
                return counts.after_high
            return None

        found = (located(first), located(second))
        if None not in found:
            return found
        at_first, at_second = first - below, second - below
        if counts.le_low <= at_first and at_second < counts.lt_high:
            values = values.where((v > low) & (v < high))
            below, inside = below + counts.le_low, counts.lt_high - counts.le_low
        elif at_second < counts.lt_low:
            values = values.where(v < low)
            inside = counts.lt_low
        else:
            values = values.where(v > high)
            below, inside = below + counts.le_high, inside - counts.le_high
    found = values.orderBy("v").offset(first - below).limit(second - first + 1).collect()
    return found[0].v, found[-1].v


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """Quantile with linear interpolation between order statistics; None for no values."""
    n = _numbers(df, column).count()
    if n == 0:
        return None
    position = (n - 1) * share
    rank = math.floor(position)
    low, high = order_statistics(df, column, rank, min(rank + 1, n - 1), n)
    return low + (high - low) * (position - rank)


@dataclass(frozen=True)
class Cut:
    """Marks the rows up to a (value, tie) pair; ``tie`` None takes all equal values."""

    value: object
    tie: object = None

    def holds(self, value: Column, tie: Column) -> Column:
        if self.tie is None:
            return value <= F.lit(self.value)
        return (value < F.lit(self.value)) | ((value == F.lit(self.value)) & (tie <= F.lit(self.tie)))


def smallest_cut(df: DataFrame, column: str, k: int, tie: str, rows: int | None = None) -> Cut:
    """The cut below which exactly the ``k`` smallest rows by (column, tie) lie.

    ``tie`` has to identify a row; only rows on the cut value are ordered by it.
    """
    value, _ = order_statistics(df, column, k - 1, k - 1, rows)
    counts = df.agg(F.count_if(F.col(column) < value).alias("lower"),
                    F.count_if(F.col(column) <= value).alias("upto")).first()
    if counts.upto == k:
        return Cut(value)
    last = (df.where(F.col(column) == value).select(tie).orderBy(tie)
            .offset(k - counts.lower - 1).limit(1).first()[0])
    return Cut(value, last)
