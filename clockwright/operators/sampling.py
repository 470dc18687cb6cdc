"""Seeded choices that depend on row keys only, never on partitioning.

Draws come from MD5, which every SQL engine has, so a sample can be recomputed
elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clockwright import settings
from clockwright.scratch import materialize

_DIGITS = 13
#: hexadecimal digits by which a round of selection counts
_STEP = 3
_RANGE = float(16 ** _DIGITS)


def draw(key: Column, seed: int, purpose: str) -> Column:
    """A 52-bit whole number from key, seed and purpose."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}:{purpose}")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")


def uniform(key: Column, seed: int, purpose: str) -> Column:
    """A double in [0, 1)."""
    return draw(key, seed, purpose).cast("double") / F.lit(_RANGE)


def sample_size(rows: int, rate: float = settings.ANOMALY_RATE) -> int:
    """At least one row of a non-empty table; halves round to even."""
    if rows < 0:
        raise ValueError(f"a row count cannot be negative: {rows}")
    return max(1, round(rows * rate)) if rows else 0


def row_tag(df: DataFrame) -> Column:
    """Digits from the text of a whole row, so that only rows that repeat in full have the same ones."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]
    return F.substring(F.md5(F.concat_ws("\x1f", *texts)), 1, _DIGITS)


@dataclass(frozen=True)
class Cut:
    """Up to where a sample goes: places before ``bound``, and ``copies`` of the rows that stand on it."""

    bound: str
    copies: int
    on_bound: int


def smallest_places(places: DataFrame, k: int) -> Cut:
    """The cut below which the ``k`` smallest of the texts in column ``place`` lie, by selection on their digits.

    Each round counts the texts per next ``_STEP`` digits under the prefix found
    so far and goes on in the one group that holds the cut.  The groups are
    bounded by the number of digits, and nothing is ordered but them.
    """
    prefix, wanted = "", k
    while True:
        under = places.where(F.startswith("place", F.lit(prefix))) if prefix else places
        upto = len(prefix) + _STEP
        groups = under.groupBy(F.substring("place", 1, upto).alias("head")).count().collect()
        for group in sorted(groups, key=lambda g: g["head"]):
            if wanted <= group["count"]:
                break
            wanted -= group["count"]
        else:
            raise ValueError(f"{k} places of {k - wanted}")
        prefix = group["head"]
        if wanted == group["count"] or upto >= 2 * _DIGITS:
            return Cut(prefix, wanted, group["count"])


@dataclass(frozen=True)
class _Choice:
    """Eligible rows, their places, and the cut; no cut: all or none of them."""

    allowed: Column
    place: Column
    cut: Cut | None
    whole: bool

    @staticmethod
    def of(df: DataFrame, key: str, rate: float, seed: int, eligible: Column | None) -> _Choice:
        allowed = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
        name = F.coalesce(F.col(key).cast("string"), F.lit(""))
        place = F.concat(F.substring(F.md5(F.concat(name, F.lit(f":{seed}:sample"))), 1, _DIGITS), row_tag(df))
        places = materialize(df.where(allowed).select(place.alias("place")), "places")
        rows = places.count()
        size = sample_size(rows, rate)
        cut = smallest_places(places, size) if 0 < size < rows else None
        return _Choice(allowed, place, cut, size >= rows > 0)

    def before(self) -> Column:
        """Rows that are in for certain."""
        if self.cut is None:
            return self.allowed & F.lit(self.whole)
        head = F.substring(self.place, 1, len(self.cut.bound))
        return self.allowed & (head <= F.lit(self.cut.bound) if self.cut.copies == self.cut.on_bound
                               else head < F.lit(self.cut.bound))


def choose(df: DataFrame, key: str, rate: float, seed: int, eligible: Column | None = None) -> Column:
    """A predicate for the sampled rows, to be applied map-side; see ``seeded_sample``.

    No predicate tells rows apart that repeat in full: if the cut falls among
    such rows, this is an error.
    """
    choice = _Choice.of(df, key, rate, seed, eligible)
    if choice.cut is not None and choice.cut.copies < choice.cut.on_bound:
        raise ValueError(f"{choice.cut.on_bound} rows that repeat in full stand on the border of the sample")
    return choice.before()


def seeded_sample(df: DataFrame, key: str, *, rate: float = settings.ANOMALY_RATE,
                  seed: int = settings.SEED, eligible: Column | None = None) -> DataFrame:
    """Exactly ``sample_size`` of the eligible rows: those with the smallest draws of their key.

    Rows of one key have one draw; among them the text of the whole row decides,
    so the cut splits a key of any size.  Of rows that repeat in full, as many
    copies are taken as are needed.  A NULL key draws like an empty one.  Only
    counts per digit reach the driver; the table is filtered where it lies.
    """
    choice = _Choice.of(df, key, rate, seed, eligible)
    sample = df.where(choice.before())
    cut = choice.cut
    if cut is None or cut.copies == cut.on_bound:
        return sample
    copies = materialize(df.where(choice.allowed & (choice.place == F.lit(cut.bound))), "copies")
    return sample.unionByName(_some_rows(copies, cut.copies))


def _some_rows(written: DataFrame, k: int) -> DataFrame:
    """``k`` rows of a written table, whole partitions first, without moving a row."""
    per_part = written.groupBy(F.spark_partition_id().alias("part")).count().collect()
    left, part = k, 0
    for row in sorted(per_part, key=lambda r: r["part"]):
        part = row["part"]
        if left <= row["count"]:
            break
        left -= row["count"]
    number = F.monotonically_increasing_id()        # the partition above 33 bits, the row in it below
    at, row = F.shiftright(F.col("__number"), 33), F.col("__number").bitwiseAND(F.lit((1 << 33) - 1))
    return (written.withColumn("__number", number)
            .where((at < part) | ((at == part) & (row < left))).drop("__number"))


def weighted_choice(share: Column, weights: dict[str, float]) -> Column:
    """The category whose slice of the cumulated weights holds ``share`` (in [0, 1))."""
    total = sum(weights.values())
    names = list(weights)
    picked, upto = None, 0.0
    for name in names[:-1]:
        upto += weights[name]
        hit = share < F.lit(upto / total)
        picked = F.when(hit, F.lit(name)) if picked is None else picked.when(hit, F.lit(name))
    return F.lit(names[-1]) if picked is None else picked.otherwise(F.lit(names[-1]))
