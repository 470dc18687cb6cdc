"""The stricter rules a raw table must meet when it is produced."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clockwright import settings
from clockwright.functions.parsing import not_positive
from clockwright.functions.times import minutes_between
from clockwright.operators import quality
from clockwright.plans.transform import employee_columns, parsed_punches, shift_columns


def departments_report(raw: DataFrame) -> DataFrame:
    quality.require_columns(raw, "departments")
    return quality.table_report(raw, "departments", {
        "department_name must not be null": F.col("department_name").isNull(),
    }, key="department_id", allow_empty=False)


def employees_report(raw: DataFrame, departments: DataFrame, expected_rows: int | None = None) -> DataFrame:
    quality.require_columns(raw, "employees")
    typed = employee_columns(raw)
    return quality.union_reports(
        quality.table_report(typed, "employees", {
            "hourly_rate must be positive": not_positive(F.col("hourly_rate")),
            "employment_status must be known": quality.not_in("employment_status", settings.EMPLOYMENT_STATUSES),
        }, key="employee_id", expected_rows=expected_rows),
        quality.reference_report(typed, "employees", "department_id", departments, "departments"),
    )


def shifts_report(raw: DataFrame, employees: DataFrame) -> DataFrame:
    quality.require_columns(raw, "shifts")
    typed = shift_columns(raw)
    return quality.union_reports(
        quality.table_report(typed, "shifts", {
            "scheduled_start must be a valid timestamp": F.col("scheduled_start").isNull(),
            "scheduled_end must be a valid timestamp": F.col("scheduled_end").isNull(),
            "scheduled_end must be after scheduled_start": F.col("scheduled_end") <= F.col("scheduled_start"),
            "every shift must have the standard duration":
                F.col("scheduled_hours") != F.lit(float(settings.STANDARD_SHIFT_HOURS)),
        }, key="shift_id", allow_empty=False),
        quality.reference_report(typed, "shifts", "employee_id", employees, "employees", ("department_id",)),
    )


def punches_report(raw: DataFrame, shifts: DataFrame) -> DataFrame:
    quality.require_columns(raw, "punches")
    typed = parsed_punches(raw.withColumn("__out_text", F.col("clock_out")))
    return quality.union_reports(
        quality.table_report(typed, "punches", {
            "clock_in must be a valid timestamp": F.col("clock_in").isNull(),
            "a given clock_out must be a valid timestamp":
                F.col("__out_text").isNotNull() & F.col("clock_out").isNull(),
            "clock_out must be after clock_in": F.col("clock_out") <= F.col("clock_in"),
            "punch_status must be known": quality.not_in("punch_status", settings.PUNCH_STATUSES),
        }, key="punch_id", allow_empty=False),
        quality.reference_report(typed, "punches", "shift_id", shifts, "shifts", ("employee_id", "department_id")),
    )


def offset_report(punches: DataFrame, shifts: DataFrame) -> DataFrame:
    """Punches that start or end outside the expected offsets, counted per punch_status."""
    plan = shifts.select("shift_id", "scheduled_start", "scheduled_end")
    arrival = minutes_between(F.col("scheduled_start"), F.col("clock_in"))
    departure = minutes_between(F.col("scheduled_end"), F.col("clock_out"))
    return punches.join(plan, "shift_id").groupBy("punch_status").agg(
        F.count(F.lit(1)).alias("punch_rows"),
        F.count_if(~arrival.between(*settings.ARRIVAL_OFFSET_RANGE)).alias("arrival_outside"),
        F.count_if(~departure.between(*settings.DEPARTURE_OFFSET_RANGE)).alias("departure_outside"),
    )


def uncovered_shifts(punches: DataFrame, shifts: DataFrame) -> DataFrame:
    return quality.uncovered(shifts, "shift_id", punches)
