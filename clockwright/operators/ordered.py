"""Values from the previous row of a group and group statistics, hot groups split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clockwright import settings
from clockwright.scratch import materialize

_CHUNK = "__chunk"


def hot_keys(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows: at most ``rows / max_rows`` of them."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).where(F.col("key_rows") > max_rows).select(key)


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, *, counts: str = "key_rows",
                 max_rows_per_key: int = settings.MAX_ROWS_PER_KEY) -> DataFrame:
    """Join rows with a written table of one row per key, which counts the rows of its key.

    A shuffle join followed by an aggregate on the same key would leave all rows
    of a hot key in one task.  Rows of keys above the limit are joined by
    broadcasting just those keys, at most ``rows / max_rows_per_key`` of them;
    the rest are joined in whichever way the size of ``per_key`` suggests.
    """
    hot = per_key.where(F.col(counts) > max_rows_per_key).drop(counts)
    ordinary = per_key.where(F.col(counts) <= max_rows_per_key).drop(counts)
    if hot.isEmpty():
        return rows.join(ordinary, key)
    few = F.broadcast(hot)
    return rows.join(few, key).unionByName(rows.join(few, key, "left_anti").join(ordinary, key))


def with_previous_and_stats(
    df: DataFrame,
    key: str,
    order: tuple[str, ...],
    previous: tuple[str, str],
    stats: dict[str, Column],
    *,
    max_rows_per_key: int = settings.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Add the previous row's value and per-key statistics to every row.

    ``previous`` is (source column, new column); ``stats`` maps new columns to
    aggregates over the key.  ``df`` must be cheap to read again (a table).

    NULL is a key of its own.

    Groups of ordinary size go through one exchange on the key, which serves
    the ordered and the unordered window alike.  Groups above the limit are cut
    into ranges of (key, order) that are written as numbered chunks; each chunk
    is a group of its own, the value that crosses a chunk border comes from the
    last row of the chunk before, and the statistics come from an aggregate.
    """
    hot = hot_keys(df, key, max_rows_per_key)
    if hot.isEmpty():
        return _by_window(df, key, order, previous, stats)
    # a NULL key is a key like any other, also in the joins
    hot = materialize(hot, "hot-keys").withColumnRenamed(key, "__hot")
    is_hot = df[key].eqNullSafe(hot["__hot"])
    ordinary = _by_window(df.join(hot, is_hot, "left_anti"), key, order, previous, stats)
    split = _by_chunk(df.join(hot, is_hot, "left_semi"), key, order, previous, stats)
    return ordinary.unionByName(split)


def _by_window(df, key, order, previous, stats):
    source, target = previous
    group = Window.partitionBy(key)
    added = {target: F.lag(source).over(group.orderBy(*order))}
    added |= {name: agg.over(group) for name, agg in stats.items()}
    return df.withColumns(added)


def _by_chunk(df, key, order, previous, stats):
    source, target = previous
    chunked = materialize(
        df.repartitionByRange(key, *order).withColumn(_CHUNK, F.spark_partition_id()),
        "chunks",
    )
    inside = Window.partitionBy(key, _CHUNK).orderBy(*order)
    # one row per chunk and key: bounded by the number of shuffle partitions plus hot keys
    borders = (
        chunked.groupBy(key, _CHUNK)
        .agg(F.max_by(source, F.struct(*order)).alias("__last"))
        .withColumn("__carried", F.lag("__last").over(Window.partitionBy(key).orderBy(_CHUNK)))
        .select(F.col(key).alias("__border_key"), F.col(_CHUNK).alias("__border_chunk"), "__carried")
    )
    # one row per hot key
    totals = chunked.groupBy(F.col(key).alias("__total_key")).agg(*[agg.alias(name) for name, agg in stats.items()])
    return (
        chunked
        .withColumns({"__position": F.row_number().over(inside), "__before": F.lag(source).over(inside)})
        .join(F.broadcast(borders), F.col(key).eqNullSafe(F.col("__border_key")) & (F.col(_CHUNK) == F.col("__border_chunk")))
        .join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("__total_key")))
        .withColumn(target, F.when(F.col("__position") == 1, F.col("__carried")).otherwise(F.col("__before")))
        .select(*df.columns, target, *stats)
    )
