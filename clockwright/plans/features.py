"""Model features of clean punches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clockwright import settings
from clockwright.functions.numbers import largest_column, zero_if_not_finite, zscore
from clockwright.functions.times import hours_between
from clockwright.operators.ordered import with_previous_and_stats
from clockwright.schemas import SCORE_KEY_COLUMNS

HINT = "reason_hint"
_MICROS = 3.6e9     # of an hour


def feature_inputs(punches: DataFrame) -> DataFrame:
    """Only the columns the features need, so that the shuffle carries no others."""
    return punches.select(
        *SCORE_KEY_COLUMNS, "clock_out", "worked_hours", "daily_overtime_hours",
        "arrival_minutes", "departure_minutes", "scheduled_hours",
    )


def build_features(punches: DataFrame, *, max_rows_per_key: int = settings.MAX_ROWS_PER_KEY) -> DataFrame:
    """Identifying columns plus the nine features, all finite doubles.

    ``punches`` is a stored table: it is counted per employee first, to keep
    employees with very many punches out of a single sort.
    """
    worked = F.col("worked_hours")
    # whole microseconds add up to the same number in any order, so that a table's
    # size, which decides how groups are split, never shows in a statistic
    micros = F.rint(worked * _MICROS).cast("decimal(16,0)")
    enriched = with_previous_and_stats(
        feature_inputs(punches), "employee_id", ("clock_in", "punch_id"),
        ("clock_out", "__previous_clock_out"),
        {"__n": F.count(worked), "__sum": F.sum(micros), "__squares": F.sum((micros * micros).cast("decimal(28,0)")),
         "__low": F.min(worked), "__high": F.max(worked)},
        max_rows_per_key=max_rows_per_key,
    )
    n, total = F.col("__n"), F.col("__sum").cast("double")
    spread = F.greatest(F.col("__squares").cast("double") - total * (total / n), F.lit(0.0)) / (n - 1)
    first_rest = F.lit(settings.FIRST_PUNCH_REST_HOURS)
    measured = enriched.withColumns({
        "rest_hours_before_shift":
            F.coalesce(hours_between(F.col("__previous_clock_out"), F.col("clock_in")), first_rest),
        "employee_mean_worked_hours": total / n / _MICROS,
        "employee_std_worked_hours": F.when((n > 1) & (F.col("__low") < F.col("__high")), F.sqrt(spread) / _MICROS)
                                      .otherwise(F.lit(0.0)),
    }).withColumn(
        "worked_hours_zscore",
        zscore(worked, F.col("employee_mean_worked_hours"), F.col("employee_std_worked_hours")),
    )
    return measured.select(
        *SCORE_KEY_COLUMNS,
        *[zero_if_not_finite(F.col(c)).alias(c) for c in settings.FEATURE_COLUMNS],
    )


def with_reason_hint(features: DataFrame) -> DataFrame:
    """Name of the largest raw feature of each row."""
    return features.withColumn(HINT, largest_column(settings.FEATURE_COLUMNS))


def feature_scaling(features: DataFrame) -> DataFrame:
    """Mean and population deviation per feature (a zero deviation scales by one), long form."""
    stats = features.agg(F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(c).alias("mean"),
            F.when(F.stddev_pop(c) == 0.0, 1.0).otherwise(F.stddev_pop(c)).alias("scale"),
        ) for c in settings.FEATURE_COLUMNS
    ]).alias("stats"))
    return stats.select(F.inline("stats"))


def scale_features(features: DataFrame, scaling: DataFrame) -> DataFrame:
    """Features shifted and scaled by a fitted scaling table (nine rows)."""
    fitted = {r.feature: (r["mean"], r["scale"]) for r in scaling.collect()}
    return features.withColumns({
        c: (F.col(c) - F.lit(mean)) / F.lit(scale) for c, (mean, scale) in fitted.items()
    })
