"""Raw tables to typed, checked and enriched tables.

``*_columns`` functions are lazy projections, ``*_report`` functions count rule
violations, and the functions named ``transform_*`` put both together and raise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clockwright import settings
from clockwright.functions.numbers import gross_pay, overtime_hours, overtime_pay, regular_hours, regular_pay
from clockwright.functions.parsing import (
    DATE_PATTERN, TIMESTAMP_PATTERN, not_positive, parse_date, parse_flag, parse_number, parse_timestamp,
)
from clockwright.functions.times import hours_between, minutes_between, week_start, work_date
from clockwright.operators import quality
from clockwright.operators.dedup import flag_later_copies
from clockwright.schemas import PUNCH_EVENT_KEYS
from clockwright.scratch import materialize

REASON = "quarantine_reason"


@dataclass(frozen=True)
class PunchSplit:
    clean: DataFrame
    quarantine: DataFrame


# --- departments -------------------------------------------------------------------

def departments_report(raw: DataFrame) -> DataFrame:
    return quality.table_report(raw, "departments", key="department_id")


def transform_departments(raw: DataFrame) -> DataFrame:
    quality.require_columns(raw, "departments")
    quality.enforce(departments_report(raw))
    return raw


# --- employees ---------------------------------------------------------------------

def employee_columns(raw: DataFrame, *, date_pattern: str = DATE_PATTERN) -> DataFrame:
    return raw.withColumns({
        "hire_date": parse_date(F.col("hire_date"), date_pattern),
        "hourly_rate": parse_number(F.col("hourly_rate")),
    })


def employees_report(typed: DataFrame, departments: DataFrame) -> DataFrame:
    return quality.union_reports(
        quality.table_report(typed, "employees", {
            "hire_date must be a valid timestamp": F.col("hire_date").isNull(),
            "hourly_rate must be a number above zero": not_positive(F.col("hourly_rate")),
        }, key="employee_id"),
        quality.reference_report(typed, "employees", "department_id", departments, "departments"),
    )


def transform_employees(raw: DataFrame, departments: DataFrame, *, date_pattern: str = DATE_PATTERN) -> DataFrame:
    quality.require_columns(raw, "employees")
    # rules and joins read the typed table several times
    typed = materialize(employee_columns(raw, date_pattern=date_pattern), "employees")
    quality.enforce(employees_report(typed, departments), {
        "department_id must exist in departments":
            quality.unknown_references(typed, "department_id", departments),
    })
    return typed


# --- shifts ------------------------------------------------------------------------

def shift_columns(raw: DataFrame, *, pattern: str = TIMESTAMP_PATTERN) -> DataFrame:
    return raw.withColumns({
        "scheduled_start": parse_timestamp(F.col("scheduled_start"), pattern),
        "scheduled_end": parse_timestamp(F.col("scheduled_end"), pattern),
    }).withColumn("scheduled_hours", hours_between(F.col("scheduled_start"), F.col("scheduled_end")))


def shifts_report(typed: DataFrame, employees: DataFrame) -> DataFrame:
    return quality.union_reports(
        quality.table_report(typed, "shifts", {
            "scheduled_start must be a valid timestamp": F.col("scheduled_start").isNull(),
            "scheduled_end must be a valid timestamp": F.col("scheduled_end").isNull(),
            "scheduled_end must be after scheduled_start": F.col("scheduled_end") <= F.col("scheduled_start"),
        }, key="shift_id"),
        quality.reference_report(typed, "shifts", "employee_id", employees, "employees"),
    )


def transform_shifts(raw: DataFrame, employees: DataFrame, *, pattern: str = TIMESTAMP_PATTERN) -> DataFrame:
    quality.require_columns(raw, "shifts")
    typed = materialize(shift_columns(raw, pattern=pattern), "shifts")
    quality.enforce(shifts_report(typed, employees), {
        "employee_id must exist in employees": quality.unknown_references(typed, "employee_id", employees),
    })
    return typed


# --- punches -----------------------------------------------------------------------

def _early_reason() -> Column:
    """The first broken rule of a punch, duplicates aside."""
    came, left = F.col("clock_in"), F.col("clock_out")
    by_reason = dict(zip(settings.QUARANTINE_REASONS, (
        came.isNull(),
        left.isNull(),
        F.col("__shift").isNull(),
        F.col("__employee").isNull(),
        left <= came,
    )))
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in by_reason.items()])


def parsed_punches(raw: DataFrame, *, pattern: str = TIMESTAMP_PATTERN) -> DataFrame:
    return raw.withColumns({
        "clock_in": parse_timestamp(F.col("clock_in"), pattern),
        "clock_out": parse_timestamp(F.col("clock_out"), pattern),
    })


def with_shift_and_rate(punches: DataFrame, shifts: DataFrame, employees: DataFrame) -> DataFrame:
    """Punches with the plan of their shift, their rate, and markers of both matches."""
    plan = shifts.select("shift_id", "scheduled_start", "scheduled_end", "scheduled_hours",
                         F.lit(True).alias("__shift"))
    rates = employees.select("employee_id", "hourly_rate", F.lit(True).alias("__employee"))
    return punches.join(plan, "shift_id", "left").join(rates, "employee_id", "left")


def punch_measures(matched: DataFrame) -> DataFrame:
    """Hours, offsets, pay and calendar columns of complete punches."""
    came, left, worked = F.col("clock_in"), F.col("clock_out"), F.col("worked_hours")
    rate = F.col("hourly_rate")
    return (
        matched
        .withColumn("worked_hours", hours_between(came, left))
        .withColumns({
            "arrival_minutes": minutes_between(F.col("scheduled_start"), came),
            "departure_minutes": minutes_between(F.col("scheduled_end"), left),
            "regular_hours": regular_hours(worked),
            "daily_overtime_hours": overtime_hours(worked),
            "regular_pay": regular_pay(worked, rate),
            "overtime_pay": overtime_pay(worked, rate),
            "work_date": work_date(came),
            "week_start": week_start(came),
        })
        .withColumn("gross_pay_estimate", gross_pay(F.col("regular_pay"), F.col("overtime_pay")))
    )


def classified_punches(raw: DataFrame, shifts: DataFrame, employees: DataFrame, *,
                       order: tuple[str, ...] = ("punch_id",), pattern: str = TIMESTAMP_PATTERN) -> DataFrame:
    """Every raw punch with parsed times, shift plan, rate and its quarantine reason.

    Rows of one event carry equal earlier reasons, so duplicates are looked for
    only among rows without one.  ``order`` says which copy came first.
    """
    quality.require_columns(raw, "punches")
    matched = with_shift_and_rate(parsed_punches(raw, pattern=pattern), shifts, employees)
    reasoned = matched.withColumn(REASON, _early_reason()).drop("__shift", "__employee")
    flagged = flag_later_copies(reasoned, PUNCH_EVENT_KEYS, order, "__copy", F.col(REASON).isNull())
    duplicate = settings.QUARANTINE_REASONS[-1]
    return flagged.withColumn(
        REASON, F.coalesce(REASON, F.when(F.col("__copy"), F.lit(duplicate)))).drop("__copy")


def split_punches(classified: DataFrame, raw_columns: list[str]) -> PunchSplit:
    return PunchSplit(
        clean=punch_measures(classified.where(F.col(REASON).isNull()).drop(REASON)),
        quarantine=classified.where(F.col(REASON).isNotNull()).select(*raw_columns, REASON),
    )


def transform_punches(raw: DataFrame, shifts: DataFrame, employees: DataFrame, *,
                      order: tuple[str, ...] = ("punch_id",), pattern: str = TIMESTAMP_PATTERN) -> PunchSplit:
    """Clean punches and quarantine, from one stored classification."""
    return split_punches(
        materialize(classified_punches(raw, shifts, employees, order=order, pattern=pattern), "classified"), raw.columns)


#: where a classified punch goes
OUTCOME, CLEAN, QUARANTINE = "outcome", "punches", "quarantine"


def with_outcome(classified: DataFrame) -> DataFrame:
    """Every classified punch with the table it belongs to."""
    outcome = F.when(F.col(REASON).isNull(), F.lit(CLEAN)).otherwise(F.lit(QUARANTINE))
    return classified.withColumn(OUTCOME, outcome)


def routed_punches(classified: DataFrame) -> DataFrame:
    """Every classified punch with the columns of clean ones, its reason, and the table it belongs to.

    Measures of quarantined punches are what their columns yield and are not stored.
    """
    return punch_measures(with_outcome(classified))


def punch_columns(routed: DataFrame, raw_columns: list[str]) -> dict[str, tuple[str, ...]]:
    """The columns of both tables of routed punches."""
    return {CLEAN: tuple(c for c in routed.columns if c not in (REASON, OUTCOME)), QUARANTINE: (*raw_columns, REASON)}


# --- labels ------------------------------------------------------------------------

def labels_report(raw: DataFrame) -> DataFrame:
    return quality.table_report(raw, "labels", {
        "is_anomaly must contain true or false": parse_flag(F.col("is_anomaly")).isNull(),
    })


def label_columns(raw: DataFrame, clean_punches: DataFrame) -> DataFrame:
    """Typed labels; evaluable where the labelled punch is clean."""
    clean_ids = clean_punches.select("punch_id").distinct().withColumn("__clean", F.lit(True))
    return (
        raw.withColumn("is_anomaly", parse_flag(F.col("is_anomaly")))
        .join(clean_ids, "punch_id", "left")
        .withColumn("is_evaluable", F.col("__clean").isNotNull())
        .select(*raw.columns, "is_evaluable")
    )


def require_labels(raw: DataFrame) -> None:
    quality.require_columns(raw, "labels")
    quality.enforce(labels_report(raw))


def transform_labels(raw: DataFrame, clean_punches: DataFrame) -> DataFrame:
    require_labels(raw)
    return label_columns(raw, clean_punches)


# --- all ---------------------------------------------------------------------------

def transform_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six processed tables; every table is checked against the one before it."""
    departments = transform_departments(raw["departments"])
    employees = transform_employees(raw["employees"], departments)
    shifts = transform_shifts(raw["shifts"], employees)
    punches = transform_punches(raw["punches"], shifts, employees)
    return {
        "departments": departments,
        "employees": employees,
        "shifts": shifts,
        "punches": punches.clean,
        "quarantine": punches.quarantine,
        "labels": transform_labels(raw["labels"], punches.clean),
    }
