"""The workforce tables derived from the order tables of the test data.

nation -> departments, customer -> employees, orders -> shifts and punches,
events -> review updates.  Every row of those tables becomes a row here; the
remainders below decide which rows carry a defect, so that each rule of the
library has something to find.  All definitions are integer arithmetic.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# the columns that are used, so that no file is opened just to infer a schema
_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id bigint, text string, source string",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double, props string",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(moment: str) -> str:
    return f"replace(cast({moment} as string), ' ', 'T')"


def _plus(moment: str, minutes: str) -> str:
    return f"({moment} + make_dt_interval(0, 0, cast({minutes} as int)))"


def _id(prefix: str, width: int, number: str) -> str:
    digits = f"cast({number} as string)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


_DEPARTMENT = _id("D", 3, "{0} + 1")
_CAME = _plus("s", "k * 7919 % 91 - 30")
_USUAL_OUT = "k * 104729 % 241 - 60"
_EXTRA = "300 + k % 300"
_OVERTIME = "k % 33 = 5"
_MISSING = "k % 50 = 3"


class RawWorkforce:
    """The five raw tables, all columns strings; each is planned when it is asked for."""

    NAMES = ("departments", "employees", "shifts", "punches", "labels")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}

    @cached_property
    def departments(self) -> DataFrame:
        return driver_table(self._spark, self._sf_dir, "nation").selectExpr(
            f"{_DEPARTMENT.format('n_nationkey')} as department_id",
            "n_name as department_name",
            "if(n_nationkey % 3 = 0, '24/7', 'Weekdays') as operating_schedule",
        )

    @cached_property
    def employees(self) -> DataFrame:
        return driver_table(self._spark, self._sf_dir, "customer").selectExpr(
            f"{_id('EMP', 5, 'c_custkey + 1')} as employee_id",
            "c_name as first_name",
            "c_name as last_name",
            f"{_DEPARTMENT.format('c_nationkey')} as department_id",
            "c_mktsegment as job_title",
            "cast(date_add(date'2015-01-01', cast(c_custkey % 3650 as int)) as string) as hire_date",
            "cast(22 + (c_custkey * 37 % 3800) / 100 as string) as hourly_rate",
            "case when c_custkey % 100 < 92 then 'active' when c_custkey % 100 < 97 then 'on_leave' "
            "else 'terminated' end as employment_status",
        )

    @cached_property
    def _scheduled(self) -> DataFrame:
        """Orders with their employee's department, and planned start ``s`` and end ``e``."""
        staff = driver_table(self._spark, self._sf_dir, "customer").selectExpr(
            "c_custkey as o_custkey", "c_nationkey")
        start = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 3 * 8 as int))"
        return driver_table(self._spark, self._sf_dir, "orders").join(staff, "o_custkey").selectExpr(
            "o_orderkey as k",
            f"{_id('SFT', 7, 'o_orderkey + 1')} as shift_id",
            f"{_id('EMP', 5, 'o_custkey + 1')} as employee_id",
            f"{_DEPARTMENT.format('c_nationkey')} as department_id",
            f"{start} as s",
            f"{start} + make_dt_interval(0, 8) as e",
            "if(c_nationkey % 3 = 0, '24/7', 'Weekdays') as shift_type",
        )

    @cached_property
    def shifts(self) -> DataFrame:
        return self._scheduled.selectExpr(
            "shift_id", "employee_id", "department_id",
            f"{_iso('s')} as scheduled_start", f"{_iso('e')} as scheduled_end", "shift_type",
        )

    @cached_property
    def punches(self) -> DataFrame:
        return self._punches(_plus("e", f"{_USUAL_OUT} + if({_OVERTIME}, {_EXTRA}, 0)"))

    @cached_property
    def punches_before(self) -> DataFrame:
        """The snapshot before the long overtime that labels name: the same punches, with their usual clock-outs."""
        return self._punches(_plus("e", _USUAL_OUT))

    def _punches(self, left: str) -> DataFrame:
        return self._scheduled.selectExpr(
            "*", "explode(if(k % 100 = 7, array(0, 1), array(0))) as copy",
        ).selectExpr(
            f"{_id('PCH', 7, 'k * 2 + copy + 1')} as punch_id",
            "if(k % 991 = 2, 'SFT9999999', shift_id) as shift_id",
            "if(k % 983 = 3, 'EMP99999', employee_id) as employee_id",
            "department_id",
            f"if(k % 997 = 1, 'not-a-time', {_iso(_CAME)}) as clock_in",
            f"case when {_MISSING} then null when k % 977 = 4 then {_iso(_plus('s', '-60'))} "
            f"else {_iso(left)} end as clock_out",
            f"case when {_MISSING} then 'missing_clock_out' when copy = 1 then 'duplicate' "
            "else 'complete' end as punch_status",
        )

    @cached_property
    def labels(self) -> DataFrame:
        """One label per order whose clock-out carries the long overtime."""
        return self._scheduled.where(f"{_OVERTIME} and not {_MISSING}").selectExpr(
            f"{_id('ANM', 6, 'k + 1')} as anomaly_id",
            f"{_id('PCH', 7, 'k * 2 + 1')} as punch_id",
            "shift_id", "employee_id",
            "if(k % 4 = 3, 'insufficient_rest', 'extreme_overtime') as anomaly_type",
            f"{_iso(_CAME)} as original_clock_in",
            f"{_iso(_plus('e', _USUAL_OUT))} as original_clock_out",
            f"{_iso(_CAME)} as injected_clock_in",
            f"{_iso(_plus('e', f'{_USUAL_OUT} + {_EXTRA}'))} as injected_clock_out",
            "'Clock-out was extended several hours beyond ordinary behavior.' as anomaly_reason",
            "if(k % 2 = 0, 'True', 'false') as is_anomaly",
        )


def review_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review updates: up to four per punch, some with a bad status or a long note."""
    return driver_table(spark, sf_dir, "events").selectExpr(
        f"{_id('PCH', 7, '(event_id - event_id % 4) * 2 + 1')} as punch_id",
        "case event_type when 'view' then 'pending' when 'click' then 'legitimate' when 'signup' then 'resolved' "
        "when 'error' then 'confirmed_issue' else 'archived' end as review_status",
        "if(event_id % 7 <> 0, repeat(props, cast(1 + event_id % 250 as int)), null) as reviewer_notes",
        "ts as updated_at",
        "event_id as seq",
    )


def triage_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage decisions as JSON text; some break a rule."""
    return driver_table(spark, sf_dir, "events").selectExpr(
        "event_id as decision_id",
        """to_json(named_struct(
            'classification', case event_type when 'view' then 'dismiss' when 'click' then 'escalate'
                when 'signup' then 'needs_more_data' when 'error' then 'dismiss' else 'unsure' end,
            'confidence', value / 50,
            'summary', repeat(props, cast(event_id % 140 as int)),
            'evidence', array(named_struct('fact', repeat(props, cast(event_id % 60 as int)), 'source', event_type)),
            'missing_information', array(props),
            'recommended_action', repeat(event_type, cast(1 + event_id % 90 as int))
        )) as body""",
    )
