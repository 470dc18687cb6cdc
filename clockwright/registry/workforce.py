"""The tables one query works on, built on first use."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from clockwright.operators.forest import fit_forest
from clockwright.plans import features as feature_plans, review, transform
from clockwright.plans.scoring import ScoredModel, flag_top, results_table, train_model
from clockwright.scratch import materialize
from clockwright.sources import driver_tables


class Workforce:
    """Raw, clean and scored tables over one folder of driver tables.

    Every query makes its own instance, so no work is shared between queries.
    Tables that several steps read are written to scratch, as the stored
    processed tables are in a real run.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def source(self, name: str) -> DataFrame:
        return driver_tables.driver_table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> driver_tables.RawWorkforce:
        return driver_tables.RawWorkforce(self.spark, self.sf_dir)

    @cached_property
    def employees(self) -> DataFrame:
        return transform.employee_columns(self.raw.employees)

    @cached_property
    def shifts(self) -> DataFrame:
        return transform.shift_columns(self.raw.shifts)

    @cached_property
    def classified(self) -> DataFrame:
        return transform.classified_punches(self.raw.punches, self.shifts, self.employees)

    @cached_property
    def split(self) -> transform.PunchSplit:
        return transform.split_punches(self.classified, self.raw.punches.columns)

    @cached_property
    def clean(self) -> DataFrame:
        """Clean punches, not stored: for queries that read them once."""
        return self.split.clean

    @cached_property
    def punches(self) -> DataFrame:
        """Clean punches as a stored table."""
        return materialize(self.clean, "punches")

    @cached_property
    def labels(self) -> DataFrame:
        return transform.label_columns(self.raw.labels, self.punches)

    @cached_property
    def features(self) -> DataFrame:
        return feature_plans.build_features(self.punches)

    @cached_property
    def flagged(self) -> tuple[DataFrame, float | None]:
        """Deterministic scores: how many deviations the worked hours lie off the employee's mean."""
        scored = feature_plans.with_reason_hint(self.features).withColumn(
            "anomaly_score", F.round(F.abs("worked_hours_zscore"), 6))
        return flag_top(materialize(results_columns(scored), "scores"), "anomaly_score")

    @cached_property
    def scores(self) -> DataFrame:
        return results_table(self.flagged[0])

    @cached_property
    def updates(self) -> DataFrame:
        return driver_tables.review_updates(self.spark, self.sf_dir)

    @cached_property
    def review_view(self) -> DataFrame:
        return review.apply_updates(review.seed(self.scores), self.updates)

    @cached_property
    def stored_features(self) -> DataFrame:
        return materialize(feature_plans.with_reason_hint(self.features), "features")

    @cached_property
    def nodes(self) -> DataFrame:
        return fit_forest(self.stored_features, "punch_id")

    @cached_property
    def model(self) -> ScoredModel:
        return train_model(self.punches)

    @cached_property
    def day_range(self) -> tuple[date, date]:
        """First and last day with a shift."""
        day = F.col("o_orderdate").cast("date")
        first, last = self.source("orders").agg(F.min(day), F.max(day)).first()
        return first, last


def results_columns(scored: DataFrame) -> DataFrame:
    return scored.select("punch_id", "shift_id", "employee_id", "department_id", "clock_in",
                         "anomaly_score", "reason_hint")
