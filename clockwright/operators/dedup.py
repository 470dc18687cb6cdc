"""First occurrence per key, exact for copies of any number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clockwright.scratch import materialize

_TAG = "__row_tag"
_HASH = "__key_hash"
_OPEN = "__eligible"
_FIRST = "__first_tag"


def flag_later_copies(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...],
                      flag: str, eligible: Column | None = None) -> DataFrame:
    """Add ``flag``: true for every eligible row but the first of its key by ``order``.

    A window over the keys would put all copies of one event in one task and
    sort the whole table.  Instead the rows are written once, each with a tag,
    and three narrow steps follow:

    1. count rows by a 64-bit hash of the key, combined map-side;
    2. among rows whose hash occurs twice or more, find the first tag of every
       key that really does, again combined map-side;
    3. join those tags back: every other row of such a key is a later copy.

    The joined tables are written, so the planner knows their size: it
    broadcasts them when small and otherwise shuffles, where adaptive execution
    splits hot partitions.  NULL keys are equal; rows that agree on every order
    column are told apart by their tag.
    """
    allowed = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    tagged = materialize(
        df.withColumns({_OPEN: allowed, _HASH: F.xxhash64(*keys), _TAG: F.monotonically_increasing_id()}),
        "tagged",
    )
    candidates = tagged.where(_OPEN)
    repeated = materialize(
        candidates.groupBy(_HASH).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(_HASH),
        "repeated",
    )
    firsts = materialize(
        candidates.join(repeated, _HASH, "left_semi")
        .groupBy(_HASH, *keys)
        .agg(F.min(F.struct(*order, _TAG)).alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select(F.col(_HASH).alias("__hash"), *[F.col(k).alias(f"__{k}") for k in keys],
                F.col(f"first.{_TAG}").alias(_FIRST)),
        "firsts",
    )
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys],
                      F.col(_HASH) == F.col("__hash"))
    later = F.col(_OPEN) & F.coalesce(F.col(_TAG) != F.col(_FIRST), F.lit(False))
    return (
        tagged.join(firsts, same_key, "left")
        .withColumn(flag, later)
        .drop(_OPEN, _HASH, _TAG, _FIRST, "__hash", *[f"__{k}" for k in keys])
    )
