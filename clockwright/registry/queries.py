"""One callable per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clockwright import settings
from clockwright.functions import numbers, parsing, text, times
from clockwright.operators import numbering, quality, sampling
from clockwright.operators.dedup import flag_later_copies
from clockwright.operators.forest import forest_score
from clockwright.plans import (
    evaluation, features as feature_plans, label_checks, perturb, raw_checks, review, roster, scoring, transform, triage,
)
from clockwright.plans.etl import run_etl
from clockwright.plans.review_store import ReviewTable
from clockwright.registry.workforce import Workforce
from clockwright.schemas import PUNCH_EVENT_KEYS
from clockwright.scratch import materialize, scratch_path
from clockwright.sources import driver_tables, tables
from clockwright.sources.raw import RawPaths, read_csv
from clockwright.sources.tables import read_table, write_metrics, write_raw_csv, write_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TOKEN_TEXTS = parsing.NA_TOKENS + (" NA ", "na", "value")
RATE_TEXTS = ("12.5", "5d", "0x10", "inf", "nan", "-3", "0", "1e2", " 12.5 ", ".5", "7.")
FLAG_TEXTS = ("true", "FALSE", "True", "yes", "", " true")


def query(build: Callable[[Workforce], DataFrame]) -> Callable[[Workforce], DataFrame]:
    """Register a builder under its own name."""
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(Workforce(spark, sf_dir))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Rounded columns, with negative zero as zero: engines disagree on its sign after rounding."""
    def rounded(c: str) -> Column:
        value = F.round(c, digits)
        return F.when(value == 0.0, F.lit(0.0)).otherwise(value)
    return df.withColumns({c: rounded(c) for c in columns})


def _one_of(texts: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (key % len(texts) + 1).cast("int"))


# --- scans and sinks -----------------------------------------------------------------

@query
def scan_na_normalise(w: Workforce) -> DataFrame:
    return parsing.null_na_tokens(w.source("orders").select(
        "o_orderkey", _one_of(TOKEN_TEXTS, F.col("o_orderkey")).alias("token_text"), "o_orderpriority"))


@query
def csv_dialect(w: Workforce) -> DataFrame:
    """Texts with line breaks, quotes and commas, written as CSV and read again block by block."""
    path = scratch_path(w.spark, "raw") + "/texts.csv"
    texts = w.source("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source", "text")
    write_raw_csv({"texts": texts}, {"texts": path})
    return read_csv(w.spark, path, multiline=True)


@query
def raw_csv_scan(w: Workforce) -> DataFrame:
    path = scratch_path(w.spark, "raw") + "/punches.csv"
    write_raw_csv({"punches": w.raw.punches}, {"punches": path})
    return read_csv(w.spark, path)


@query
def roundtrip_load(w: Workforce) -> DataFrame:
    path = scratch_path(w.spark, "processed") + "/shifts.parquet"
    write_table(w.shifts, path, sort_by=("employee_id", "scheduled_start"))
    return read_table(w.spark, path)


@query
def table_counts(w: Workforce) -> DataFrame:
    return tables.table_counts(w.raw.as_dict())


@query
def etl_table_counts(w: Workforce) -> DataFrame:
    """Raw CSV files to the six stored tables; the counts are those observed while writing."""
    written = _etl(w)
    return w.spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(rows).cast("bigint").alias("row_count"))
        for name, (_, rows) in written.items()])))


def _etl(w: Workforce) -> dict[str, tuple[str, int]]:
    root = scratch_path(w.spark, "etl")
    paths = {name: f"{root}/raw/{name}.csv" for name in w.raw.as_dict()}
    write_raw_csv(w.raw.as_dict(), paths)
    return run_etl(w.spark, RawPaths(**paths), f"{root}/processed")


@query
def stored_punches(w: Workforce) -> DataFrame:
    """What the whole run, from CSV on, has stored as clean punches."""
    return read_table(w.spark, _etl(w)["punches"][0])


@query
def stored_quarantine(w: Workforce) -> DataFrame:
    return read_table(w.spark, _etl(w)["quarantine"][0])


@query
def stored_labels(w: Workforce) -> DataFrame:
    return read_table(w.spark, _etl(w)["labels"][0])


# --- parsing and scalar functions -------------------------------------------------------

@query
def parse_ts_bad_count(w: Workforce) -> DataFrame:
    checks = [(w.raw.punches, "clock_in"), (w.raw.punches, "clock_out"),
              (w.raw.shifts, "scheduled_start"), (w.raw.shifts, "scheduled_end")]
    return quality.union_reports(*[
        table.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(parsing.parse_timestamp(F.col(c)).isNull()).alias("bad_rows"))
        .select(F.lit(c).alias("column_name"), "total_rows", "bad_rows")
        for table, c in checks
    ])


@query
def parse_ts_lenient(w: Workforce) -> DataFrame:
    key, moment = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    iso = times.iso_text(moment)
    forms = (iso, moment.cast("string"), F.concat(iso, F.lit(".5")), F.concat(iso, F.lit("Z")),
             moment.cast("date").cast("string"), F.lit("2026-02-30T08:00:00"), F.lit("2026-01-01T24:00:00"),
             F.concat(F.lit(" "), iso), F.lit("2026"))
    typed = F.element_at(F.array(*forms), (key % len(forms) + 1).cast("int"))
    return w.source("orders").select("o_orderkey", typed.alias("time_text")).withColumn(
        "parsed", parsing.parse_timestamp(F.col("time_text")))


@query
def parse_rate_positive(w: Workforce) -> DataFrame:
    texts = w.source("customer").select("c_custkey", _one_of(RATE_TEXTS, F.col("c_custkey")).alias("rate_text"))
    typed = texts.withColumn("rate", parsing.parse_number(F.col("rate_text")))
    return typed.withColumn("is_bad", parsing.not_positive(F.col("rate")))


@query
def parse_bool_token(w: Workforce) -> DataFrame:
    texts = w.source("orders").select("o_orderkey", _one_of(FLAG_TEXTS, F.col("o_orderkey")).alias("flag_text"))
    return texts.withColumn("flag", parsing.parse_flag(F.col("flag_text")))


@query
def shift_durations(w: Workforce) -> DataFrame:
    start, end = F.col("scheduled_start"), F.col("scheduled_end")
    return w.shifts.select("shift_id", "scheduled_hours",
                           times.minutes_between(start, end).alias("scheduled_minutes"))


@query
def calendar_columns(w: Workforce) -> DataFrame:
    return w.clean.select("punch_id", "work_date", "week_start")


@query
def overtime_split(w: Workforce) -> DataFrame:
    return w.clean.select("punch_id", "worked_hours", "regular_hours", "daily_overtime_hours")


@query
def pay_estimate(w: Workforce) -> DataFrame:
    return w.clean.select("punch_id", "hourly_rate", "regular_pay", "overtime_pay", "gross_pay_estimate")


@query
def clip_offsets(w: Workforce) -> DataFrame:
    return w.clean.select(
        "punch_id",
        numbers.clip(F.col("arrival_minutes"), *settings.ARRIVAL_OFFSET_RANGE).alias("arrival_clipped"),
        numbers.clip(F.col("departure_minutes"), *settings.DEPARTURE_OFFSET_RANGE).alias("departure_clipped"),
    )


@query
def format_ids(w: Workforce) -> DataFrame:
    order, person = F.col("o_orderkey") + 1, F.col("o_custkey") + 1
    return w.source("orders").select(
        "o_orderkey",
        numbers.numbered_id("employee", person).alias("employee_id"),
        numbers.numbered_id("shift", order).alias("shift_id"),
        numbers.numbered_id("punch", order).alias("punch_id"),
        numbers.numbered_id("anomaly", order).alias("anomaly_id"),
    )


@query
def record_json(w: Workforce) -> DataFrame:
    """Clean punches as JSON records, shown by reading them back."""
    records = w.clean.select(text.json_record(w.clean).alias("record"))
    return records.select(F.from_json(
        "record", "punch_id string, clock_in string, work_date string, worked_hours double, gross_pay_estimate double"
    ).alias("r")).select("r.*")


@query
def triage_context_text(w: Workforce) -> DataFrame:
    flagged = _rounded(triage.flagged_records(w.punches, w.scores), 3,
                       "worked_hours", "daily_overtime_hours", "arrival_minutes", "departure_minutes")
    return flagged.select("punch_id", text.triage_text(flagged).alias("context_text"))


# --- data quality ---------------------------------------------------------------------------

@query
def dq_summary(w: Workforce) -> DataFrame:
    """Every rule a raw table must meet, with the number of violations."""
    raw = w.raw
    return quality.union_reports(
        raw_checks.departments_report(raw.departments),
        raw_checks.employees_report(raw.employees, raw.departments, w.source("customer").count()),
        raw_checks.shifts_report(raw.shifts, raw.employees),
        raw_checks.punches_report(raw.punches, raw.shifts),
        transform.labels_report(raw.labels),
    )


@query
def dq_transform_rules(w: Workforce) -> DataFrame:
    """The rules that stop the transform."""
    return quality.union_reports(
        transform.departments_report(w.raw.departments),
        transform.employees_report(w.employees, w.raw.departments),
        transform.shifts_report(w.shifts, w.employees),
        transform.labels_report(w.raw.labels),
    )


@query
def dq_duplicate_keys(w: Workforce) -> DataFrame:
    return quality.duplicate_keys(w.raw.punches, "shift_id")


@query
def fk_violations(w: Workforce) -> DataFrame:
    raw = w.raw
    links = [
        ("employees.department_id", raw.employees, "department_id", raw.departments),
        ("shifts.employee_id", raw.shifts, "employee_id", raw.employees),
        ("punches.shift_id", raw.punches, "shift_id", raw.shifts),
        ("punches.employee_id", raw.punches, "employee_id", raw.employees),
        ("labels.punch_id", raw.labels, "punch_id", raw.punches),
    ]
    return quality.union_reports(*[
        quality.unknown_references(child, key, parent)
        .select(F.lit(name).alias("reference"), F.col(key).alias("unknown_key"), "key_rows")
        for name, child, key, parent in links
    ])


@query
def dq_shift_duration(w: Workforce) -> DataFrame:
    standard = F.col("scheduled_hours") == F.lit(float(settings.STANDARD_SHIFT_HOURS))
    return w.shifts.groupBy("scheduled_hours", standard.alias("is_standard")).agg(
        F.count(F.lit(1)).alias("shift_rows"))


@query
def dq_domain(w: Workforce) -> DataFrame:
    checks = [
        ("employment_status", w.raw.employees, settings.EMPLOYMENT_STATUSES),
        ("punch_status", w.raw.punches, settings.PUNCH_STATUSES),
        ("review_status", w.updates, settings.REVIEW_STATUSES),
    ]
    return quality.union_reports(*[
        quality.outside_domain(table, column, allowed)
        .select(F.lit(column).alias("column_name"), F.col(column).alias("unknown_value"), "value_rows")
        for column, table, allowed in checks
    ])


@query
def dq_consistency(w: Workforce) -> DataFrame:
    return quality.disagreements(w.raw.punches, "shift_id", ("employee_id", "department_id"), w.raw.shifts)


@query
def shift_coverage(w: Workforce) -> DataFrame:
    return raw_checks.uncovered_shifts(w.raw.punches, w.raw.shifts)


@query
def offset_bounds(w: Workforce) -> DataFrame:
    return raw_checks.offset_report(transform.parsed_punches(w.raw.punches), w.shifts)


# --- transforms --------------------------------------------------------------------------------

@query
def clean_departments(w: Workforce) -> DataFrame:
    return transform.transform_departments(w.raw.departments)


@query
def clean_employees(w: Workforce) -> DataFrame:
    return transform.transform_employees(w.raw.employees, w.raw.departments)


@query
def clean_shifts(w: Workforce) -> DataFrame:
    return transform.transform_shifts(w.raw.shifts, w.employees)


@query
def enrich_punches(w: Workforce) -> DataFrame:
    matched = transform.with_shift_and_rate(transform.parsed_punches(w.raw.punches), w.shifts, w.employees)
    return matched.select("punch_id", "clock_in", "clock_out", "scheduled_start", "scheduled_end",
                          "scheduled_hours", "hourly_rate")


@query
def punch_dedup(w: Workforce) -> DataFrame:
    parsed = transform.parsed_punches(w.raw.punches)
    return flag_later_copies(parsed, PUNCH_EVENT_KEYS, ("punch_id",), "is_later_copy").select(
        "punch_id", "is_later_copy")


@query
def quarantine_reasons(w: Workforce) -> DataFrame:
    return w.split.quarantine


@query
def quarantine_counts(w: Workforce) -> DataFrame:
    return w.split.quarantine.groupBy(transform.REASON).agg(F.count(F.lit(1)).alias("punch_rows"))


@query
def clean_punches(w: Workforce) -> DataFrame:
    return w.clean


@query
def label_evaluable(w: Workforce) -> DataFrame:
    return transform.transform_labels(w.raw.labels, w.punches)


@query
def transformed_tables(w: Workforce) -> DataFrame:
    """All six transforms with their checks, counted."""
    return tables.table_counts(transform.transform_all(w.raw.as_dict()))


# --- features ---------------------------------------------------------------------------------

@query
def rest_hours(w: Workforce) -> DataFrame:
    return w.features.select("punch_id", "rest_hours_before_shift")


@query
def employee_stats(w: Workforce) -> DataFrame:
    return _rounded(w.features.select("punch_id", "employee_id", "employee_mean_worked_hours",
                                      "employee_std_worked_hours"),
                    6, "employee_mean_worked_hours", "employee_std_worked_hours")


@query
def worked_zscore(w: Workforce) -> DataFrame:
    return _rounded(w.features.select("punch_id", "worked_hours_zscore"), 6, "worked_hours_zscore")


@query
def feature_matrix(w: Workforce) -> DataFrame:
    return _rounded(w.features, 6, *settings.FEATURE_COLUMNS)


@query
def reason_hint(w: Workforce) -> DataFrame:
    return feature_plans.with_reason_hint(w.features).select("punch_id", "reason_hint")


@query
def feature_scaling(w: Workforce) -> DataFrame:
    return _rounded(feature_plans.feature_scaling(w.features), 6, "mean", "scale")


@query
def scaled_features(w: Workforce) -> DataFrame:
    stored = w.stored_features
    scaled = feature_plans.scale_features(stored, feature_plans.feature_scaling(stored))
    return _rounded(scaled.select("punch_id", *settings.FEATURE_COLUMNS), 5, *settings.FEATURE_COLUMNS)


@query
def contamination_flag(w: Workforce) -> DataFrame:
    scored, _ = w.flagged
    return scored.where("predicted_anomaly").select("punch_id", "employee_id", "anomaly_score")


# --- forest ----------------------------------------------------------------------------------------

@query
def iforest_fit(w: Workforce) -> DataFrame:
    return w.nodes


@query
def iforest_score(w: Workforce) -> DataFrame:
    return _rounded(w.stored_features.select("punch_id", forest_score(w.nodes).alias("isolation")), 9, "isolation")


@query
def anomaly_scores(w: Workforce) -> DataFrame:
    return _rounded(w.model.results, 9, "anomaly_score")


@query
def forest_metrics(w: Workforce) -> DataFrame:
    return evaluation.evaluate(materialize(w.model.results, "scores"), w.labels, w.punches)


@query
def stored_model_scores(w: Workforce) -> DataFrame:
    """Scores of a model that was stored and loaded again."""
    root = scratch_path(w.spark, "model")
    scoring.save_artifacts(w.model, root, f"{root}/scores.parquet")
    nodes, columns, threshold = scoring.load_model(w.spark, root)
    return _rounded(scoring.score_with(w.features, nodes, columns, threshold), 9, "anomaly_score")


# --- evaluation --------------------------------------------------------------------------------------

@query
def eval_confusion(w: Workforce) -> DataFrame:
    return evaluation.confusion(evaluation.truth_and_prediction(w.scores, w.labels, w.punches))


@query
def eval_metrics(w: Workforce) -> DataFrame:
    return evaluation.evaluate(w.scores, w.labels, w.punches)


@query
def metrics_document(w: Workforce) -> DataFrame:
    """The metrics as stored JSON, read back."""
    path = scratch_path(w.spark, "metrics")
    result = evaluation.evaluate(w.scores, w.labels, w.punches)
    write_metrics(result, path)
    return w.spark.read.schema(result.schema).json(path)


@query
def anomaly_type_counts(w: Workforce) -> DataFrame:
    return w.raw.labels.where(F.col("anomaly_type").isNotNull()).groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("label_rows")).orderBy(F.col("label_rows").desc(), "anomaly_type")


@query
def punch_status_counts(w: Workforce) -> DataFrame:
    return w.raw.punches.where(F.col("punch_status").isNotNull()).groupBy("punch_status").agg(
        F.count(F.lit(1)).alias("punch_rows")).orderBy(F.col("punch_rows").desc(), "punch_status")


# --- review ---------------------------------------------------------------------------------------------

@query
def review_seed(w: Workforce) -> DataFrame:
    """Seeding over a table that already holds the flagged punches, with an older score."""
    before = review.seed(w.scores.where("predicted_anomaly")).withColumns(
        {"anomaly_score": F.lit(0.0), "review_status": F.lit("resolved")})
    return review.seed(w.scores, before).drop("reviewer_notes")


@query
def review_event_valid(w: Workforce) -> DataFrame:
    return review.checked_updates(w.updates).select("seq", "punch_id", "review_status", "problem")


@query
def review_apply(w: Workforce) -> DataFrame:
    return w.review_view.select("punch_id", "review_status", "reviewer_notes")


@query
def review_store(w: Workforce) -> DataFrame:
    """The stored table after a batch, a compaction and another batch, read back."""
    known = w.updates.join(w.scores.select("punch_id"), "punch_id", "left_semi")
    table = ReviewTable(w.spark, scratch_path(w.spark, "review"), buckets=8)
    table.seed(w.scores)
    table.append(known.where("seq % 2 = 0"))
    table.compact()
    table.append(known.where("seq % 2 = 1"))
    return table.view().select("punch_id", "employee_id", "predicted_anomaly", "review_status", "reviewer_notes")


@query
def review_unknown_updates(w: Workforce) -> DataFrame:
    return review.unknown_updates(review.seed(w.scores), w.updates).select("seq", "punch_id")


@query
def review_filter(w: Workforce) -> DataFrame:
    rows = review.filtered(w.review_view, flagged_only=False, review_status="resolved", department_id="D004")
    return rows.select("punch_id", "department_id", "review_status", "anomaly_score")


@query
def review_total(w: Workforce) -> DataFrame:
    return review.total(review.filtered(w.review_view, review_status="pending"))


@query
def review_page(w: Workforce) -> DataFrame:
    rows = review.page(review.filtered(w.review_view), limit=50, offset=50)
    return rows.select("punch_id", "anomaly_score", "review_status")


@query
def review_page_deep(w: Workforce) -> DataFrame:
    """The page in the middle of all records, found by counts per score range."""
    view = materialize(w.review_view, "review")
    ranges = review.ScoreRanges.of(view)
    rows = review.page_within(view, ranges, limit=50, offset=sum(ranges.rows) // 2)
    return rows.select("punch_id", "anomaly_score", "review_status")


@query
def review_get(w: Workforce) -> DataFrame:
    return review.get_many(w.review_view, w.updates).select("punch_id", "found", "review_status", "anomaly_score")


@query
def review_summary(w: Workforce) -> DataFrame:
    return review.summary(w.review_view)


# --- triage ------------------------------------------------------------------------------------------------

@query
def flagged_record(w: Workforce) -> DataFrame:
    return triage.flagged_records(w.punches, w.scores)


@query
def employee_history(w: Workforce) -> DataFrame:
    """History of every employee named in the raw punches, known or not."""
    return triage.for_requested(triage.employee_history(w.punches), "employee_id", w.raw.punches)


@query
def department_baseline(w: Workforce) -> DataFrame:
    return triage.department_baseline(w.punches)


@query
def recent_punches(w: Workforce) -> DataFrame:
    return triage.recent_punches(w.punches).select("employee_id", "punch_id", "clock_in", "worked_hours", "recency")


@query
def recent_record_lists(w: Workforce) -> DataFrame:
    """The recent punches as one array per employee, shown as counts and the oldest and newest id."""
    lists = triage.recent_records(w.punches)
    rows = F.col("recent_records")
    return lists.select("employee_id", F.size(rows).cast("bigint").alias("records"),
                        rows[0].punch_id.alias("oldest_punch"),
                        F.element_at(rows, -1).punch_id.alias("newest_punch"))


@query
def shift_context(w: Workforce) -> DataFrame:
    return triage.shift_contexts(w.clean, w.updates).select(
        "punch_id", "shift_id", "scheduled_start", "scheduled_end", "clock_in", "clock_out",
        "arrival_minutes", "departure_minutes")


@query
def triage_context(w: Workforce) -> DataFrame:
    return triage.triage_context(w.punches, w.scores).select(
        "punch_id", "employee_id", "department_id", "anomaly_score", "reason_hint",
        "employee_record_count", "employee_mean_worked_hours", "employee_max_worked_hours",
        "employee_overtime_shift_count", "department_record_count", "department_p95_worked_hours",
        "department_p95_overtime_hours")


@query
def decision_valid(w: Workforce) -> DataFrame:
    texts = driver_tables.triage_decisions(w.spark, w.sf_dir)
    parsed = triage.parse_decisions(texts, "body")
    return parsed.select("decision_id", F.col("decision.classification").alias("classification"),
                         F.col("decision.prompt_version").alias("prompt_version"), "problem")


# --- roster and perturbation ----------------------------------------------------------------------------------

@query
def calendar_spine(w: Workforce) -> DataFrame:
    return roster.calendar_spine(w.spark, *w.day_range)


@query
def roster_slots(w: Workforce) -> DataFrame:
    """Expected shifts per department and day over the whole span of the shifts."""
    slots = roster.roster_slots(roster.roster_days(w.employees, w.raw.departments, *w.day_range))
    return slots.groupBy("department_id", "day").agg(F.count(F.lit(1)).alias("slots"))


@query
def roster_gaps(w: Workforce) -> DataFrame:
    """Days without a shift per employee over the whole span of the shifts."""
    days = roster.roster_days(w.employees, w.raw.departments, *w.day_range)
    return roster.roster_gaps(days, w.shifts).groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("days_without_shift"))


@query
def shift_interval(w: Workforce) -> DataFrame:
    days = w.source("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return roster.slot_intervals(days, F.col("o_orderkey") % 3 * 8)


@query
def seeded_sample(w: Workforce) -> DataFrame:
    return sampling.seeded_sample(w.raw.punches, "punch_id", eligible=F.col("punch_status") == "complete").select(
        "punch_id", "shift_id")


@query
def seeded_sample_ties(w: Workforce) -> DataFrame:
    """A sample by a key that many rows share, so that the cut goes through one key."""
    return sampling.seeded_sample(w.raw.punches, "department_id", rate=0.3, seed=3).select(
        "punch_id", "department_id", "clock_out")


@query
def number_rows(w: Workforce) -> DataFrame:
    return numbering.number_rows(w.shifts.select("shift_id", "employee_id", "scheduled_start"),
                                 ("employee_id", "scheduled_start", "shift_id"), "shift_number")


@query
def perturb_punches(w: Workforce) -> DataFrame:
    return perturb.perturb_punches(w.raw.punches)[0]


@query
def perturb_labels(w: Workforce) -> DataFrame:
    return perturb.perturb_punches(w.raw.punches)[1]


@query
def label_change_diff(w: Workforce) -> DataFrame:
    """Rules on the labels, held against the punches before and after the changes they name."""
    return label_checks.label_report(w.raw.labels, w.raw.punches_before, w.raw.punches)


@query
def snapshot_changes(w: Workforce) -> DataFrame:
    """Punches that differ between the snapshots, and whether a label names them."""
    labelled = w.raw.labels.select("punch_id").distinct().withColumn("labelled", F.lit(True))
    return (label_checks.changed_punches(w.raw.punches_before, w.raw.punches).join(labelled, "punch_id", "left")
            .withColumn("labelled", F.col("labelled").isNotNull()))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables, checks, quarantine, features and the punches above the contamination threshold."""
    return _QUERIES["contamination_flag"](spark, sf_dir)
