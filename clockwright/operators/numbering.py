"""Consecutive numbers in a given order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clockwright.scratch import materialize

_PART = "__part"
_TAG = "__tag"


def number_rows(df: DataFrame, order: tuple[str, ...], column: str, start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … by ``order``, NULLs last.

    The sorted rows are written with their part and position; the parts are then
    counted and each gets the number of rows before it.  A hash of the whole row
    closes the order, so rows with equal order values spread over parts too.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranked = materialize(
        df.withColumn("__hash", row_hash)
        .orderBy(*keys, "__hash")
        .withColumns({_PART: F.spark_partition_id(), _TAG: F.monotonically_increasing_id()})
        .drop("__hash"),
        "ranked",
    )
    # one row per part of the sort: the window sorts as many rows as there were partitions
    parts = ranked.groupBy(_PART).agg(F.count(F.lit(1)).alias("__rows"), F.min(_TAG).alias("__base"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(_PART, "__base", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return (
        ranked.join(F.broadcast(offsets), _PART)
        .withColumn(column, F.col("__offset") + F.col(_TAG) - F.col("__base") + F.lit(start))
        .drop(_PART, _TAG, "__base", "__offset")
    )
