"""Differences between two snapshots of a keyed table, reading closely only what differs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: buckets of keys that are compared as wholes
BUCKETS = 4096
_BUCKET = "__bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def bucket_digests(table: DataFrame, key: str, columns: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, digest): rows per bucket of keys, and the sum of their 64-bit digests, which no order changes."""
    digest = F.xxhash64(key, *columns).cast("decimal(20,0)")
    return table.groupBy(_bucket(key, buckets).alias(_BUCKET)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest"))


def changed_buckets(before: DataFrame, after: DataFrame, key: str, columns: tuple[str, ...],
                    buckets: int = BUCKETS) -> DataFrame:
    """Numbers of the buckets in which the snapshots differ."""
    old, new = (bucket_digests(t, key, columns, buckets) for t in (before, after))
    sides = old.unionByName(new).groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("sides"), F.min("rows").alias("r0"), F.max("rows").alias("r1"),
        F.min("digest").alias("d0"), F.max("digest").alias("d1"))
    return sides.where((F.col("sides") < 2) | (F.col("r0") != F.col("r1")) | (F.col("d0") != F.col("d1"))).select(_BUCKET)


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: tuple[str, ...],
                 buckets: int = BUCKETS) -> DataFrame:
    """(key, change) of every key whose columns differ: ``added``, ``removed`` or ``changed``.

    Equal snapshots of a bucket are told by their digests and go no further; rows
    of the others meet by key.  A key is in a snapshot once; NULL columns are
    equal to NULL.  The bucket numbers, ``buckets`` at most, are broadcast.
    """
    different = F.broadcast(changed_buckets(before, after, key, columns, buckets))

    def side(table: DataFrame, name: str) -> DataFrame:
        rows = table.select(F.col(key), F.struct(*columns).alias(name), _bucket(key, buckets).alias(_BUCKET))
        return rows.join(different, _BUCKET, "left_semi").drop(_BUCKET)

    both = side(before, "__before").join(side(after, "__after"), key, "full")
    change = (F.when(F.col("__before").isNull(), "added").when(F.col("__after").isNull(), "removed")
              .when(~F.col("__before").eqNullSafe(F.col("__after")), "changed"))
    return both.select(key, change.alias("change")).where(F.col("change").isNotNull())
