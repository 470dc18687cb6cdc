"""Fixed values and default parameters.

The values in this module have to be equal in every deployment for results to
agree, so they are plain data and nothing here is computed.
"""

from __future__ import annotations

# --- fixed values: domains ---------------------------------------------------
EMPLOYMENT_STATUSES = ("active", "on_leave", "terminated")
PUNCH_STATUSES = ("complete", "missing_clock_out", "duplicate")
SCHEDULES = ("24/7", "Weekdays")
REVIEW_STATUSES = ("pending", "confirmed_issue", "legitimate", "resolved")
TRIAGE_CLASSES = ("dismiss", "escalate", "needs_more_data")

# --- fixed values: quarantine reasons, in order of precedence ------------------
QUARANTINE_REASONS = (
    "invalid_clock_in",
    "missing_or_invalid_clock_out",
    "unknown_shift",
    "unknown_employee",
    "nonpositive_duration",
    "duplicate_business_event",
)

# --- fixed values: hours and pay -----------------------------------------------
STANDARD_SHIFT_HOURS = 8
DAILY_REGULAR_HOURS = 8.0
OVERTIME_MULTIPLIER = 1.5
FIRST_PUNCH_REST_HOURS = 24.0

# --- fixed values: offsets in minutes -------------------------------------------
ARRIVAL_OFFSET_RANGE = (-30, 60)
DEPARTURE_OFFSET_RANGE = (-60, 180)

# --- fixed values: anomaly perturbation -----------------------------------------
ANOMALY_RATE = 0.03
ANOMALY_WEIGHTS = {
    "extreme_overtime": 0.40,
    "extremely_early_clock_in": 0.35,
    "insufficient_rest": 0.25,
}
ANOMALY_REASONS = {
    "extreme_overtime": "Clock-out was extended several hours beyond ordinary behavior.",
    "extremely_early_clock_in": "Clock-in was moved several hours before expected behavior.",
    "insufficient_rest": "Clock-out was extended to create an unusually short future rest period.",
}
EARLY_CLOCK_IN_HOURS = (2, 6)
EXTENDED_CLOCK_OUT_HOURS = (4, 10)

# --- fixed values: model ---------------------------------------------------------
CONTAMINATION = 0.03
TREES = 300
SAMPLE_SIZE = 256
SEED = 42

# --- fixed values: features, in the order that breaks ties ---------------------------
FEATURE_COLUMNS = (
    "worked_hours",
    "daily_overtime_hours",
    "arrival_minutes",
    "departure_minutes",
    "scheduled_hours",
    "rest_hours_before_shift",
    "employee_mean_worked_hours",
    "employee_std_worked_hours",
    "worked_hours_zscore",
)

# --- fixed values: review and triage limits ----------------------------------------
MAX_NOTE_LENGTH = 2000
PAGE_LIMIT_DEFAULT = 50
PAGE_LIMIT_MAX = 200
HISTORY_DAYS_DEFAULT = 90
HISTORY_DAYS_RANGE = (7, 365)
RECENT_RECORDS = 12
SUMMARY_LENGTH = (1, 1200)
ACTION_LENGTH = (1, 500)
FACT_LENGTH = (1, 500)
SOURCE_LENGTH = (1, 100)
PROMPT_VERSION = "v1"
CONTEXT_HEADING = "Triage this flagged timekeeping record:"
CONTEXT_FIELDS = (
    "punch_id",
    "employee_id",
    "department_id",
    "clock_in",
    "worked_hours",
    "daily_overtime_hours",
    "arrival_minutes",
    "departure_minutes",
    "anomaly_score",
    "reason_hint",
)

# --- fixed values: identifiers, prefix and minimum number of digits ---------------------
ID_FORMATS = {
    "employee": ("EMP", 5),
    "shift": ("SFT", 7),
    "punch": ("PCH", 7),
    "anomaly": ("ANM", 6),
}

# --- tuning: rows of one key that a single task may sort ------------------------------
MAX_ROWS_PER_KEY = 5_000_000
