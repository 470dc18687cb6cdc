"""Labels held against the punches before and after the changes they name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clockwright.functions.parsing import parse_flag
from clockwright.operators import quality
from clockwright.operators.snapshots import changed_rows
from clockwright.schemas import LABEL_COLUMNS, REQUIRED_COLUMNS

TIMES = ("clock_in", "clock_out")


def changed_punches(before: DataFrame, after: DataFrame) -> DataFrame:
    """(punch_id, change): punches whose times differ between the snapshots."""
    return changed_rows(before, after, "punch_id", TIMES)


def label_changes(labels: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Each label with whether its punch changed."""
    changed = changed_punches(before, after).select("punch_id", F.lit(True).alias("__changed"))
    return labels.join(changed, "punch_id", "left").withColumn("changed", F.col("__changed").isNotNull()).drop("__changed")


def unlabelled_changes(labels: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Changed punches that no label names."""
    return changed_punches(before, after).join(labels.select("punch_id"), "punch_id", "left_anti")


def label_report(labels: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """All rules on labels, raw or typed, in one report."""
    flag = F.col("is_anomaly") if dict(labels.dtypes)["is_anomaly"] == "boolean" else parse_flag(F.col("is_anomaly"))
    return quality.union_reports(
        quality.table_report(labels, "labels", {
            "every label must be marked true": ~F.coalesce(flag, F.lit(False)),
        }, key="anomaly_id", allow_empty=False),
        quality.table_report(labels, "labels", key="punch_id"),
        quality.reference_report(labels, "labels", "punch_id", before, "punches"),
        quality.table_report(label_changes(labels, before, after), "labels", {
            "every label must change a timestamp": ~F.col("changed"),
        }),
    )


def check_labels(labels: DataFrame, before: DataFrame, after: DataFrame) -> None:
    quality.require_columns(labels, "labels", LABEL_COLUMNS)
    quality.require_columns(before, "punches", REQUIRED_COLUMNS["punches"])
    quality.enforce(label_report(labels, before, after))
