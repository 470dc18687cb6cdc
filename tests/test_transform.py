from datetime import date, datetime

import pytest

from clockwright.errors import TransformationError
from clockwright.plans import raw_checks, transform

DEPARTMENTS = "department_id string, department_name string, operating_schedule string"
EMPLOYEES = ("employee_id string, first_name string, last_name string, department_id string, job_title string, "
             "hire_date string, hourly_rate string, employment_status string")
SHIFTS = ("shift_id string, employee_id string, department_id string, scheduled_start string, scheduled_end string, "
          "shift_type string")
PUNCHES = ("punch_id string, shift_id string, employee_id string, department_id string, clock_in string, "
           "clock_out string, punch_status string")
LABELS = ("anomaly_id string, punch_id string, shift_id string, employee_id string, anomaly_type string, "
          "is_anomaly string")


def employee(key="E1", department="D1", rate="20.00", hired="2020-01-01", status="active"):
    return (key, "A", "B", department, "Clerk", hired, rate, status)


def shift(key="S1", person="E1", start="2026-01-05T08:00:00", end="2026-01-05T16:00:00", department="D1"):
    return (key, person, department, start, end, "24/7")


def punch(key, came="2026-01-05T08:00:00", left="2026-01-05T17:30:00", shift_id="S1", person="E1", department="D1"):
    return (key, shift_id, person, department, came, left, "complete")


@pytest.fixture
def tables(spark):
    def build(employees=(employee(),), shifts=(shift(),), punches=(punch("P1"),), labels=(),
              departments=(("D1", "Operations", "24/7"),)):
        return {
            "departments": spark.createDataFrame(list(departments), DEPARTMENTS),
            "employees": spark.createDataFrame(list(employees), EMPLOYEES),
            "shifts": spark.createDataFrame(list(shifts), SHIFTS),
            "punches": spark.createDataFrame(list(punches), PUNCHES),
            "labels": spark.createDataFrame(list(labels), LABELS),
        }
    return build


def test_enriched_punch(tables):
    row = transform.transform_all(tables())["punches"].first()
    assert (row.worked_hours, row.regular_hours, row.daily_overtime_hours) == (9.5, 8.0, 1.5)
    assert (row.arrival_minutes, row.departure_minutes, row.scheduled_hours) == (0.0, 90.0, 8.0)
    assert (row.regular_pay, row.overtime_pay, row.gross_pay_estimate) == (160.0, 45.0, 205.0)
    assert (row.work_date, row.week_start) == (date(2026, 1, 5), date(2026, 1, 5))


def test_reasons_in_order_of_precedence(tables):
    punches = [
        punch("P1", came="bad", left=None, shift_id="S9"),
        punch("P2", left=None, shift_id="S9"),
        punch("P3", left="2026-02-30T10:00:00"),
        punch("P4", shift_id="S9", person="E9"),
        punch("P5", shift_id=None),
        punch("P6", person="E9", left="2026-01-05T08:00:00"),
        punch("P7", person=None),
        punch("P8", left="2026-01-05T08:00:00"),
        punch("P9b"), punch("P9a"), punch("P9c"),
    ]
    got = {r.punch_id: r.quarantine_reason for r in transform.transform_all(tables(punches=punches))["quarantine"].collect()}
    assert got == {
        "P1": "invalid_clock_in", "P2": "missing_or_invalid_clock_out", "P3": "missing_or_invalid_clock_out",
        "P4": "unknown_shift", "P5": "unknown_shift", "P6": "unknown_employee", "P7": "unknown_employee",
        "P8": "nonpositive_duration", "P9b": "duplicate_business_event", "P9c": "duplicate_business_event",
    }


def test_same_event_without_department_and_with_repeated_id(tables):
    punches = [punch("P1", department=None)] * 3
    out = transform.transform_all(tables(punches=punches))
    assert out["punches"].count() == 1 and out["quarantine"].count() == 2


def test_every_punch_is_kept_once_for_any_partitioning(spark, sf_dir):
    from clockwright.registry.workforce import Workforce
    w = Workforce(spark, sf_dir)
    results = []
    for parts in (1, 3, 8):
        shuffled = w.raw.punches.repartition(parts, "clock_in")
        split = transform.transform_punches(shuffled, w.shifts, w.employees)
        results.append((sorted(map(str, split.clean.collect())), sorted(map(str, split.quarantine.collect()))))
        assert sum(map(len, results[-1])) == w.raw.punches.count()
    assert results[0] == results[1] == results[2]


def test_extra_columns_pass_through(spark, tables):
    raw = tables()
    raw["punches"] = raw["punches"].selectExpr("*", "'terminal 4' as device")
    assert transform.transform_all(raw)["punches"].first().device == "terminal 4"


@pytest.mark.parametrize(("change", "message"), [
    ({"departments": [("D1", "a", "24/7"), ("D1", "b", "24/7")]}, "department_id must be non-null and unique"),
    ({"employees": [employee(hired="soon")]}, r"hire_date must be a valid timestamp \(1\)"),
    ({"employees": [employee(rate="5d")]}, "hourly_rate must be a number above zero"),
    ({"employees": [employee(rate="0")]}, "hourly_rate must be a number above zero"),
    ({"employees": [employee(), employee()]}, "employee_id must be non-null and unique"),
    ({"employees": [employee(department="D9")]}, r"department_id must exist in departments.*\['D9'\]"),
    ({"shifts": [shift(start="x")]}, "scheduled_start must be a valid timestamp"),
    ({"shifts": [shift(end="2026-01-05T08:00:00")]}, "scheduled_end must be after scheduled_start"),
    ({"shifts": [shift(key=None)]}, "shift_id must be non-null and unique"),
    ({"shifts": [shift(person="E99999")]}, r"employee_id must exist in employees.*\['E99999'\]"),
    ({"labels": [("A1", "P1", "S1", "E1", "x", "yes")]}, "is_anomaly must contain true or false"),
])
def test_broken_tables_are_refused(tables, change, message):
    with pytest.raises(TransformationError, match=message):
        transform.transform_all(tables(**change))


def test_labels_know_whether_their_punch_is_clean(tables):
    labels = [("A1", "P1", "S1", "E1", "x", "TRUE"), ("A2", "P2", "S1", "E1", "x", "false")]
    out = transform.transform_all(tables(labels=labels))["labels"].collect()
    assert {(r.anomaly_id, r.is_anomaly, r.is_evaluable) for r in out} == {("A1", True, True), ("A2", False, False)}


def test_raw_checks(tables):
    raw = tables(
        employees=[employee(status="retired")],
        shifts=[shift(end="2026-01-05T15:00:00", department="D2")],
        punches=[punch("P1", person="E2", left="later"), punch("P1", left=None, shift_id="S7")],
    )
    def broken(report):
        return {r.rule for r in report.where("violations > 0").collect()}
    assert broken(raw_checks.departments_report(raw["departments"])) == set()
    assert broken(raw_checks.employees_report(raw["employees"], raw["departments"], 2)) == {
        "employment_status must be known", "row count must be as expected"}
    assert broken(raw_checks.shifts_report(raw["shifts"], raw["employees"])) == {
        "every shift must have the standard duration", "department_id must agree with employees"}
    assert broken(raw_checks.punches_report(raw["punches"], raw["shifts"])) == {
        "a given clock_out must be a valid timestamp", "punch_id must be non-null and unique",
        "shift_id must exist in shifts", "employee_id must agree with shifts", "department_id must agree with shifts"}


def test_sunday_night_belongs_to_the_week_before(tables):
    punches = [punch("P1", came="2026-01-04T23:30:00", left="2026-01-05T07:30:00")]
    row = transform.transform_all(tables(punches=punches))["punches"].first()
    assert (row.work_date, row.week_start, row.clock_in) == (
        date(2026, 1, 4), date(2025, 12, 29), datetime(2026, 1, 4, 23, 30))
