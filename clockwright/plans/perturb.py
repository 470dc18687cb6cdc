"""Labelled perturbation of a punch table, for measuring detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clockwright import settings
from clockwright.functions.numbers import numbered_id
from clockwright.functions.parsing import parse_timestamp
from clockwright.functions.times import iso_text, nearest_minute
from clockwright.operators import quality
from clockwright.operators.numbering import number_rows
from clockwright.operators.sampling import choose, draw, uniform, weighted_choice
from clockwright.schemas import LABEL_COLUMNS
from clockwright.scratch import materialize

_TYPE = "anomaly_type"
_EARLY = "extremely_early_clock_in"


def _hours(key: Column, seed: int, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return F.lit(float(low)) + F.lit(float(high - low)) * uniform(key, seed, "hours")


def perturb_punches(punches: DataFrame, *, rate: float = settings.ANOMALY_RATE,
                    seed: int = settings.SEED) -> tuple[DataFrame, DataFrame]:
    """(punches with moved times, one label per moved punch).

    A share ``rate`` of the complete punches with readable times is moved: the
    clock-in earlier, or the clock-out later, to whole minutes.  Which, how and how far depends on
    punch_id and seed alone, so the punches are changed where they lie; only
    the labels are ordered, to number them.
    """
    quality.require_columns(punches, "punches")
    key = F.col("punch_id")
    came, left = parse_timestamp(F.col("clock_in")), parse_timestamp(F.col("clock_out"))
    movable = (F.col("punch_status") == "complete") & came.isNotNull() & left.isNotNull()
    picked = choose(punches, "punch_id", rate, seed, movable)
    kind = F.when(picked, weighted_choice(uniform(key, seed, "type"), settings.ANOMALY_WEIGHTS))
    early = iso_text(nearest_minute(came, -_hours(key, seed, settings.EARLY_CLOCK_IN_HOURS)))
    late = iso_text(nearest_minute(left, _hours(key, seed, settings.EXTENDED_CLOCK_OUT_HOURS)))
    moved = (
        punches.withColumn(_TYPE, kind)
        .withColumns({
            "injected_clock_in": F.when(F.col(_TYPE) == _EARLY, early).otherwise(F.col("clock_in")),
            "injected_clock_out": F.when(F.col(_TYPE) != _EARLY, late).otherwise(F.col("clock_out")),
        })
    )
    changed = moved.select(*[
        F.col(f"injected_{c}").alias(c) if c in ("clock_in", "clock_out") else F.col(c)
        for c in punches.columns
    ])
    reasons = F.create_map(*[F.lit(part) for pair in settings.ANOMALY_REASONS.items() for part in pair])
    picked_rows = materialize(moved.where(F.col(_TYPE).isNotNull()).withColumn("draw", draw(key, seed, "sample")),
                              "perturbed")
    labels = number_rows(picked_rows, ("draw", "punch_id"), "number").select(
        numbered_id("anomaly", F.col("number")).alias("anomaly_id"),
        "punch_id", "shift_id", "employee_id", _TYPE,
        F.col("clock_in").alias("original_clock_in"),
        F.col("clock_out").alias("original_clock_out"),
        "injected_clock_in", "injected_clock_out",
        reasons[F.col(_TYPE)].alias("anomaly_reason"),
        F.lit(True).alias("is_anomaly"),
    ).select(*LABEL_COLUMNS)
    return changed, labels
