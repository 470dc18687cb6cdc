"""Column lists and nested types of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: required columns ---------------------------------------------
REQUIRED_COLUMNS = {
    "departments": ("department_id", "department_name", "operating_schedule"),
    "employees": (
        "employee_id", "first_name", "last_name", "department_id",
        "job_title", "hire_date", "hourly_rate", "employment_status",
    ),
    "shifts": (
        "shift_id", "employee_id", "department_id",
        "scheduled_start", "scheduled_end", "shift_type",
    ),
    "punches": (
        "punch_id", "shift_id", "employee_id", "department_id",
        "clock_in", "clock_out", "punch_status",
    ),
    "labels": (
        "anomaly_id", "punch_id", "shift_id", "employee_id",
        "anomaly_type", "is_anomaly",
    ),
}

# --- fixed values: columns of a full label row -----------------------------------
LABEL_COLUMNS = (
    "anomaly_id", "punch_id", "shift_id", "employee_id", "anomaly_type",
    "original_clock_in", "original_clock_out", "injected_clock_in",
    "injected_clock_out", "anomaly_reason", "is_anomaly",
)

# --- fixed values: what makes two punches the same business event -------------------
PUNCH_EVENT_KEYS = ("shift_id", "employee_id", "department_id", "clock_in", "clock_out")

# --- fixed values: columns that scores carry over, and the fields of a decision ------
SCORE_KEY_COLUMNS = ("punch_id", "shift_id", "employee_id", "department_id", "clock_in")

DECISION_TYPE = T.StructType([
    T.StructField("classification", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("summary", T.StringType()),
    T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("fact", T.StringType()),
        T.StructField("source", T.StringType()),
    ]))),
    T.StructField("missing_information", T.ArrayType(T.StringType())),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("tools_used", T.ArrayType(T.StringType())),
    T.StructField("model", T.StringType()),
    T.StructField("prompt_version", T.StringType()),
])
