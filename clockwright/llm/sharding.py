"""Placement by a permutation-filled look-up table.

Every shard has its own permutation of the slots of a prime-sized table, from
two hashes of its name.  Shards take turns; each claims the first slot of its
permutation that is still free, until the table is full.  Shares differ by one
slot at most, and when a shard joins or leaves, few slots change hands.

The table has a fixed size that the caller names (``MAX_SLOTS`` at most), so it
is broadcast; a row finds its shard by one hash and one look-up, without a
shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_SLOTS = 1_000_003
#: md5 digits that make a key's number: 60 bits, which fit a bigint in any engine
DIGITS = 15


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def fill_table(shards: Sequence[str], slots: int) -> list[int]:
    """Which shard, by its place in ``shards``, owns each slot."""
    if not _prime(slots) or slots > MAX_SLOTS:
        raise ValueError(f"slots must be a prime of at most {MAX_SLOTS}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    first = [_number(f"{name}:first") % slots for name in shards]
    step = [_number(f"{name}:step") % (slots - 1) + 1 for name in shards]
    tried = [0] * len(shards)
    owner = [-1] * slots
    free = slots
    while free:
        for shard in range(len(shards)):
            if not free:
                break
            while True:
                slot = (first[shard] + tried[shard] * step[shard]) % slots
                tried[shard] += 1
                if owner[slot] < 0:
                    owner[slot], free = shard, free - 1
                    break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """One row per slot: slot, shard."""
    owners = ",".join(shards[i].replace(",", "") for i in fill_table(shards, slots))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard"))


def slot_of(key: Column, slots: int) -> Column:
    return (F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("bigint") % slots).cast("int")


def place(rows: DataFrame, shards: Sequence[str], slots: int, *, key: str = "doc_id",
          otherwise: str | None = "text") -> DataFrame:
    """Add ``slot`` and ``shard`` to every row; columns of these names are replaced.

    The shard depends on the key alone, not on order, partitions or other rows:
    repeated keys meet in one shard.  A null key is placed by ``otherwise`` so
    that rows without keys still spread, and by the empty text if that is null
    too.  An empty table gives an empty result.
    """
    if any("," in name for name in shards):
        raise ValueError("names of shards must not contain a comma")
    own = F.col(key).cast("string")
    placed_by = F.coalesce(own, F.col(otherwise), F.lit("")) if otherwise else F.coalesce(own, F.lit(""))
    table = lookup_table(rows.sparkSession, shards, slots)
    kept = [c for c in rows.columns if c not in ("slot", "shard")]
    return (rows.withColumn("slot", slot_of(placed_by, slots)).select(*kept, "slot")
            .join(F.broadcast(table), "slot").select(*kept, "slot", "shard"))
