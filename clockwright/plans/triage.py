"""Look-ups for triage, for all keys at once; single look-ups filter the same tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from clockwright import settings
from clockwright.errors import LookupFailed
from clockwright.functions.numbers import round3
from clockwright.functions.text import json_record, triage_text
from clockwright.functions.times import days_before
from clockwright.operators.ordered import join_per_key
from clockwright.operators.quality import require_single_rows
from clockwright.schemas import DECISION_TYPE
from clockwright.scratch import materialize


def check_days(days: int) -> int:
    low, high = settings.HISTORY_DAYS_RANGE
    if not low <= days <= high:
        raise ValueError(f"days must be within {low}..{high}")
    return days


def within_own_window(punches: DataFrame, key: str, days: int, *,
                      max_rows_per_key: int = settings.MAX_ROWS_PER_KEY) -> DataFrame:
    """Punches of the last ``days`` days before the key's own latest punch, both ends included.

    The latest punch per key is a grouped aggregate, written and joined back; no
    window over a key is needed.
    """
    anchors = materialize(
        punches.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.max("clock_in").alias("__latest"), F.count(F.lit(1)).alias("key_rows")),
        "anchors")
    return (
        join_per_key(punches, anchors, key, max_rows_per_key=max_rows_per_key)
        .where(F.col("clock_in") >= days_before(F.col("__latest"), days))
        .drop("__latest")
    )


def _mean_hours(hours: Column, weight: Column | None = None) -> Column:
    """Mean of hours that does not depend on the order of the rows.

    Hours are summed as whole microseconds; sums of doubles would differ in the
    last bit from run to run, which shows where a mean is half a rounding step.
    """
    micros = F.rint(hours * 3.6e9).cast("decimal(20,0)")
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    total = F.sum(micros if weight is None else micros * weight)
    return total.cast("double") / (rows * 3.6e9)


def employee_history(punches: DataFrame, days: int = settings.HISTORY_DAYS_DEFAULT, *,
                     max_rows_per_key: int = settings.MAX_ROWS_PER_KEY) -> DataFrame:
    """Hours and overtime per employee over their own last ``days`` days."""
    check_days(days)
    overtime = F.col("daily_overtime_hours")
    needed = punches.select("employee_id", "clock_in", "worked_hours", "daily_overtime_hours")
    recent = within_own_window(needed, "employee_id", days, max_rows_per_key=max_rows_per_key)
    return recent.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        round3(_mean_hours(F.col("worked_hours"))).alias("mean_worked_hours"),
        round3(F.max("worked_hours")).alias("max_worked_hours"),
        round3(_mean_hours(overtime)).alias("mean_overtime_hours"),
        F.count_if(overtime > 0).alias("overtime_shift_count"),
    )


def department_baseline(punches: DataFrame, days: int = settings.HISTORY_DAYS_DEFAULT, *,
                        max_rows_per_key: int = settings.MAX_ROWS_PER_KEY) -> DataFrame:
    """Hours and overtime per department, means and exact 95th percentiles.

    Equal (worked, overtime) pairs are counted first, so that the percentile of
    a department holds distinct values and not rows.  Punch times are whole
    seconds, which bounds the distinct durations by the longest shift.
    """
    needed = punches.select("department_id", "clock_in", "worked_hours", "daily_overtime_hours")
    counted = (
        within_own_window(needed, "department_id", days, max_rows_per_key=max_rows_per_key)
        .groupBy("department_id", "worked_hours", "daily_overtime_hours")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n")

    def mean(column: str) -> Column:
        return round3(_mean_hours(F.col(column), n))

    def p95(column: str) -> Column:
        return round3(F.percentile(column, 0.95, n))

    return counted.groupBy("department_id").agg(
        F.sum("n").alias("record_count"),
        mean("worked_hours").alias("mean_worked_hours"),
        p95("worked_hours").alias("p95_worked_hours"),
        mean("daily_overtime_hours").alias("mean_overtime_hours"),
        p95("daily_overtime_hours").alias("p95_overtime_hours"),
    )


def for_requested(stats: DataFrame, key: str, requests: DataFrame) -> DataFrame:
    """Statistics for requested keys; unknown ones get a record count of zero."""
    return (
        requests.select(key).distinct().join(stats, key, "left")
        .withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("bigint")))
    )


def recent_punches(punches: DataFrame, days: int = settings.HISTORY_DAYS_DEFAULT,
                   records: int = settings.RECENT_RECORDS) -> DataFrame:
    """The last records of every employee inside their window, ``recency`` 1 for the latest.

    The rank filter is applied before the shuffle too, so a hot employee sends
    a handful of rows per task.
    """
    newest = Window.partitionBy("employee_id").orderBy(F.col("clock_in").desc(), F.col("punch_id").desc())
    ranked = punches.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= records)
    # the latest punch is recency 1, so the window's anchor is among the kept rows
    anchor = F.max("clock_in").over(Window.partitionBy("employee_id"))
    return ranked.withColumn("__latest", anchor).where(
        F.col("clock_in") >= days_before(F.col("__latest"), days)).drop("__latest")


def recent_records(punches: DataFrame, days: int = settings.HISTORY_DAYS_DEFAULT,
                   records: int = settings.RECENT_RECORDS) -> DataFrame:
    """One row per employee with the recent punches as an array, oldest first."""
    others = [c for c in punches.columns if c != "employee_id"]
    return recent_punches(punches, days, records).groupBy("employee_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("recency")).alias("position"), *others)))
        .alias("recent_records"))


def scored_punches(punches: DataFrame, scores: DataFrame) -> DataFrame:
    return punches.join(
        scores.select("punch_id", "anomaly_score", "predicted_anomaly", "reason_hint"), "punch_id")


def flagged_records(punches: DataFrame, scores: DataFrame) -> DataFrame:
    """Every flagged punch with its score columns; unflagged scores never reach the join.

    A flagged punch_id that occurs twice on either side is an error.
    """
    flagged = scores.where("predicted_anomaly")
    wanted = punches.join(flagged.select("punch_id").distinct(), "punch_id", "left_semi")
    require_single_rows({"punches": wanted, "scores": flagged}, "punch_id")
    return scored_punches(punches, flagged)


def _record(df: DataFrame) -> dict | None:
    """The first row as a JSON-safe record."""
    row = df.select(json_record(df).alias("record")).first()
    return json.loads(row.record) if row else None


def flagged_record(punches: DataFrame, scores: DataFrame, punch_id: str) -> dict:
    record = _record(scored_punches(punches.where(F.col("punch_id") == punch_id), scores))
    if record is None:
        raise LookupFailed(f"unknown punch_id: {punch_id}")
    if not record["predicted_anomaly"]:
        raise LookupFailed(f"record is not flagged: {punch_id}")
    return record


def employee_history_of(punches: DataFrame, employee_id: str, days: int = settings.HISTORY_DAYS_DEFAULT) -> dict:
    """History of one employee with the recent punches, oldest first."""
    own = punches.where(F.col("employee_id") == employee_id)
    stats = _record(employee_history(own, days))
    if stats is None:
        return {"employee_id": employee_id, "record_count": 0}
    recent = recent_punches(own, days).orderBy(F.col("recency").desc()).drop("recency")
    rows = recent.select(json_record(recent).alias("record")).collect()
    return stats | {"days": days, "recent_records": [json.loads(r.record) for r in rows]}


def department_baseline_of(punches: DataFrame, department_id: str, days: int = settings.HISTORY_DAYS_DEFAULT) -> dict:
    stats = _record(department_baseline(punches.where(F.col("department_id") == department_id), days))
    if stats is None:
        return {"department_id": department_id, "record_count": 0}
    return stats | {"days": days}


def shift_context(punches: DataFrame, punch_id: str) -> dict:
    record = _record(punches.where(F.col("punch_id") == punch_id))
    if record is None:
        raise LookupFailed(f"unknown punch_id: {punch_id}")
    return record


def shift_contexts(punches: DataFrame, requests: DataFrame) -> DataFrame:
    """Scheduled and actual details for a table of requested punch_ids."""
    return requests.select("punch_id").distinct().join(punches, "punch_id")


def triage_context(punches: DataFrame, scores: DataFrame,
                   days: int = settings.HISTORY_DAYS_DEFAULT) -> DataFrame:
    """Record, employee history, department baseline and prompt text of every flagged punch."""
    flagged = flagged_records(punches, scores)
    # only the employees of flagged punches need a history
    concerned = materialize(flagged.select("employee_id").distinct(), "flagged-employees")
    history = employee_history(punches.join(concerned, "employee_id", "left_semi"), days)
    # written, so that the planner sees how small it is
    baseline = materialize(department_baseline(punches, days), "baseline")
    return (
        flagged.withColumn("context_text", triage_text(flagged))
        .join(_prefixed(history, "employee_id", "employee_"), "employee_id", "left")
        .join(_prefixed(baseline, "department_id", "department_"), "department_id", "left")
    )


def _prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key])


def _json_type(value: Column) -> Column:
    """Type of a JSON value: NULL if it is missing, VOID for a null."""
    return F.schema_of_variant(value)


def _field(json_value: Column, name: str) -> Column:
    return F.try_variant_get(json_value, f"$.{name}", "variant")


def _texts_only(value: Column) -> Column:
    """Whether a field is missing or a list of strings without nulls."""
    items = value.cast("array<variant>")
    return F.when(value.isNull(), F.lit(True)).when(
        F.startswith(_json_type(value), F.lit("ARRAY")),
        F.forall(items, lambda x: F.coalesce(_json_type(x) == "STRING", F.lit(False)))).otherwise(F.lit(False))


def parse_decisions(texts: DataFrame, column: str) -> DataFrame:
    """JSON decisions as columns, with the first broken rule in ``problem``.

    Rules look at the JSON type of a field before its value: texts have to be
    strings and lists lists, a number may also be written as a string.  Lists
    and the prompt version may be missing, but not null; the model may be both.
    """
    def length_within(value: Column, bounds: tuple[int, int]) -> Column:
        return F.coalesce(F.length(value).between(*bounds), F.lit(False))

    def is_text(value: Column) -> Column:
        return F.coalesce(_json_type(value) == "STRING", F.lit(False))

    parsed = texts.withColumn("decision", F.from_json(column, DECISION_TYPE)).withColumn(
        "__json", F.try_parse_json(F.col(column)))
    d = F.col("decision")

    def given(name: str) -> Column:
        return _field(F.col("__json"), name)

    evidence = F.coalesce(d.evidence, F.array().cast(DECISION_TYPE["evidence"].dataType))
    items = given("evidence").cast("array<variant>")
    evidence_ok = F.when(given("evidence").isNull(), F.lit(True)).when(
        F.startswith(_json_type(given("evidence")), F.lit("ARRAY")),
        F.forall(items, lambda e: is_text(_field(e, "fact")) & is_text(_field(e, "source")))
        & F.forall(evidence, lambda e: length_within(e.fact, settings.FACT_LENGTH)
                   & length_within(e.source, settings.SOURCE_LENGTH))).otherwise(F.lit(False))
    confidence = F.try_variant_get(F.col("__json"), "$.confidence", "string").try_cast("double")
    number = F.coalesce(_json_type(given("confidence")).rlike("^(STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))
    rules = {
        "classification": is_text(given("classification")) & F.coalesce(
            d.classification.isin(*settings.TRIAGE_CLASSES), F.lit(False)),
        "confidence": number & F.coalesce(confidence.between(0.0, 1.0), F.lit(False)),
        "summary": is_text(given("summary")) & length_within(d.summary, settings.SUMMARY_LENGTH),
        "evidence": evidence_ok,
        "missing_information": _texts_only(given("missing_information")),
        "recommended_action": is_text(given("recommended_action")) & length_within(
            d.recommended_action, settings.ACTION_LENGTH),
        "tools_used": _texts_only(given("tools_used")),
        "model": F.coalesce(_json_type(given("model")).isin("STRING", "VOID"), F.lit(True)),
        "prompt_version": F.coalesce(_json_type(given("prompt_version")) == "STRING", F.lit(True)),
    }
    empty = F.array().cast("array<string>")
    return parsed.withColumn(
        "problem",
        F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]),
    ).withColumn("decision", F.struct(
        d.classification.alias("classification"), confidence.alias("confidence"),
        d.summary.alias("summary"), evidence.alias("evidence"),
        F.coalesce(d.missing_information, empty).alias("missing_information"),
        d.recommended_action.alias("recommended_action"),
        F.coalesce(d.tools_used, empty).alias("tools_used"),
        d.model.alias("model"),
        F.coalesce(d.prompt_version, F.lit(settings.PROMPT_VERSION)).alias("prompt_version"),
    )).drop("__json")
