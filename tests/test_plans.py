"""Features, evaluation, review, triage, roster and perturbation on small tables."""

import re
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clockwright import settings
from clockwright.errors import LookupFailed, TransformationError
from clockwright.plans import evaluation, features, label_checks, perturb, review, roster, scoring, triage

PUNCH = ("punch_id string, shift_id string, employee_id string, department_id string, clock_in timestamp_ntz, "
         "clock_out timestamp_ntz, worked_hours double, daily_overtime_hours double, arrival_minutes double, "
         "departure_minutes double, scheduled_hours double")
START = datetime(2026, 1, 1, 8)


def punch(key, person="E1", day=0, hours=8.0, department="D1"):
    came = START + timedelta(days=day)
    return (key, f"S{key}", person, department, came, came + timedelta(hours=hours), hours, max(hours - 8.0, 0.0),
            0.0, (hours - 8.0) * 60, 8.0)


@pytest.fixture
def punches(spark):
    return lambda *rows: spark.createDataFrame(list(rows), PUNCH)


def by_id(df):
    return {r.punch_id: r for r in df.collect()}


# --- features ------------------------------------------------------------------------------

def test_rest_hours_and_statistics(punches):
    got = by_id(features.build_features(punches(
        punch("P1", hours=8.0), punch("P2", day=1, hours=10.0), punch("P3", person="E2"))))
    assert [got[p].rest_hours_before_shift for p in ("P1", "P2", "P3")] == [24.0, 16.0, 24.0]
    assert got["P1"].employee_mean_worked_hours == 9.0
    assert got["P1"].employee_std_worked_hours == pytest.approx(2 ** 0.5)
    assert got["P2"].worked_hours_zscore == pytest.approx(1 / 2 ** 0.5)
    assert (got["P3"].employee_std_worked_hours, got["P3"].worked_hours_zscore) == (0.0, 0.0)


def test_overlap_gives_negative_rest(punches):
    got = by_id(features.build_features(punches(punch("P1", hours=30.0), punch("P2", day=1))))
    assert got["P2"].rest_hours_before_shift == -6.0


def test_constant_hours_have_zero_score(punches):
    got = features.build_features(punches(*[punch(f"P{i}", day=i, hours=7.7) for i in range(5)])).collect()
    assert {r.worked_hours_zscore for r in got} == {0.0}


def test_hot_employee_split_matches_window(spark, sf_dir):
    from clockwright.registry.workforce import Workforce
    w = Workforce(spark, sf_dir)
    hot = w.punches.withColumn("employee_id", F.when(F.hash("punch_id") % 3 == 0, "EMP00001").otherwise(F.col("employee_id")))
    def rounded(limit):
        table = features.build_features(hot, max_rows_per_key=limit)
        return sorted(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in table.collect())
    assert rounded(50) == rounded(10**9)


def test_scaling(punches):
    table = features.build_features(punches(punch("P1", hours=8.0), punch("P2", day=1, hours=10.0)))
    scaling = features.feature_scaling(table)
    fitted = {r.feature: (r["mean"], r["scale"]) for r in scaling.collect()}
    assert fitted["worked_hours"] == (9.0, 1.0) and fitted["scheduled_hours"] == (8.0, 1.0)
    assert sorted(r.worked_hours for r in features.scale_features(table, scaling).collect()) == [-1.0, 1.0]


# --- evaluation -------------------------------------------------------------------------------

def test_metrics(spark):
    ids = spark.createDataFrame([(f"P{i}",) for i in range(6)], "punch_id string")
    scores = spark.createDataFrame([("P0", True), ("P1", True), ("P2", False), ("P3", False), ("X", True)],
                                   "punch_id string, predicted_anomaly boolean")
    labels = spark.createDataFrame([("P0", True), ("P2", True), ("P3", False), ("Q", True)],
                                   "punch_id string, is_anomaly boolean")
    row = evaluation.evaluate(scores, labels, ids).first()
    assert tuple(row) == (0.5, 0.5, 0.5, 1, 1, 1, 1)
    with pytest.raises(TransformationError):
        evaluation.evaluate(scores.union(scores), labels, ids)
    with pytest.raises(TransformationError, match="punches"):
        evaluation.evaluate(scores, labels, ids.union(ids.limit(1)))
    with pytest.raises(TransformationError, match="scores"):
        evaluation.evaluate(scores.union(spark.createDataFrame([(None, True)], scores.schema)), labels, ids)


def test_metrics_of_nothing(spark):
    scores = spark.createDataFrame([("P0", False)], "punch_id string, predicted_anomaly boolean")
    labels = spark.createDataFrame([], "punch_id string, is_anomaly boolean")
    assert tuple(evaluation.evaluate(scores, labels, scores).first())[:3] == (0.0, 0.0, 0.0)


def test_flag_is_strictly_above_the_quantile(spark):
    table = spark.createDataFrame([(float(min(i, 97)),) for i in range(101)], "s double")
    flagged, threshold = scoring.flag_top(table, "s", 0.03)
    assert threshold == 97.0 and flagged.where("predicted_anomaly").count() == 0


# --- review --------------------------------------------------------------------------------------

SCORES = ("punch_id string, shift_id string, employee_id string, department_id string, clock_in timestamp_ntz, "
          "anomaly_score double, predicted_anomaly boolean, reason_hint string")


@pytest.fixture
def scores(spark):
    rows = [(f"P{i}", "S", "E", f"D{i % 2}", START, float(i // 2), i >= 4, "worked_hours") for i in range(8)]
    return spark.createDataFrame(rows, SCORES)


def test_pages_by_position(spark):
    """Every page, over ties of any length, is what ordering all records gives; deep ones order few rows."""
    rng = random.Random(2)
    rows = [(f"P{i:04d}", "S", "E", "D", START, float(rng.choice([1, 2, 2, 2, rng.randrange(1000)])), True, "h")
            for i in range(1500)]
    view = review.seed(spark.createDataFrame(rows, SCORES))
    expected = [r[0] for r in sorted(rows, key=lambda r: (-r[5], r[0]))]
    ranges = review.ScoreRanges.of(view, 16)
    assert sum(ranges.rows) == 1500
    for offset in (0, 7, 93, 500, 749, 1300, 1490, 1500, 9000):
        found = review.page_within(view, ranges, limit=20, offset=offset)
        assert [r.punch_id for r in found.collect()] == expected[offset:offset + 20]
    deep = review.page_within(view, review.ScoreRanges.of(view, 256), limit=20, offset=200)
    text = deep._jdf.queryExecution().optimizedPlan().toString()
    assert max(int(n) for n in re.findall(r"Limit (\d+)", text)) < 60
    last = view.where(F.col("punch_id") == expected[799]).first()
    after = review.page_after(view, last.anomaly_score, last.punch_id, limit=20)
    assert [r.punch_id for r in after.collect()] == expected[800:820]
    none = view.where("false")
    assert review.page_within(none, review.ScoreRanges.of(none)).count() == 0


def updates(spark, *rows):
    return spark.createDataFrame(
        [(p, s, n, START + timedelta(hours=h), q) for q, (p, s, n, h) in enumerate(rows)],
        "punch_id string, review_status string, reviewer_notes string, updated_at timestamp_ntz, seq long")


def test_seed_keeps_what_is_there(scores):
    old = review.seed(scores.where("punch_id in ('P0', 'P1')")).withColumn("anomaly_score", F.lit(-1.0))
    rows = by_id(review.seed(scores, old))
    assert len(rows) == 8 and rows["P0"].anomaly_score == -1.0 and rows["P7"].review_status == "pending"


def test_last_update_wins_and_clears_notes(spark, scores):
    changes = updates(spark, ("P1", "resolved", None, 2), ("P1", "legitimate", "fine", 1),
                      ("P2", "confirmed_issue", "a", 1), ("P2", "resolved", "b", 1),
                      ("P3", "archived", None, 5), ("P4", "resolved", "x" * 2001, 5), ("P5", "resolved", "x" * 2000, 5),
                      ("ZZ", "resolved", None, 1))
    base = review.seed(scores)
    rows = by_id(review.apply_updates(base, changes))
    assert len(rows) == 8
    assert [(rows[p].review_status, rows[p].reviewer_notes) for p in ("P1", "P2", "P3", "P4")] == [
        ("resolved", None), ("resolved", "b"), ("pending", None), ("pending", None)]
    assert rows["P5"].review_status == "resolved"
    assert [r.punch_id for r in review.unknown_updates(base, changes).collect()] == ["ZZ"]


def test_filters_pages_and_look_ups(spark, scores):
    view = review.apply_updates(review.seed(scores), updates(spark, ("P5", "resolved", None, 1)))
    assert review.total(review.filtered(view)).first().total == 4
    assert review.total(review.filtered(view, flagged_only=False, review_status="", department_id="")).first().total == 8
    assert review.total(review.filtered(view, review_status="pending", department_id="D1")).first().total == 1
    assert [r.punch_id for r in review.page(review.filtered(view), limit=2, offset=1).collect()] == ["P7", "P4"]
    assert tuple(review.summary(view).first()) == (8, 4, 7, 0)
    assert review.get(view, "P5")["review_status"] == "resolved"
    listed = review.listing(view, limit=1, offset=3)
    assert ([r["punch_id"] for r in listed["items"]], listed["total"], listed["limit"], listed["offset"]) == (["P5"], 4, 1, 3)
    with pytest.raises(LookupFailed):
        review.get(view, "P99")
    for bad in ({"limit": 0}, {"limit": 201}, {"offset": -1}):
        with pytest.raises(ValueError):
            review.page(view, **bad)


# --- triage -----------------------------------------------------------------------------------------

def test_history_of_two_punches(punches):
    row = triage.employee_history(punches(punch("P1", hours=9.0), punch("P2", day=1))).first()
    assert (row.record_count, row.overtime_shift_count, row.mean_worked_hours, row.max_worked_hours) == (2, 1, 8.5, 9.0)


def test_history_window_ends_at_the_own_latest_punch(punches):
    table = punches(punch("P1"), punch("P2", day=90), punch("P3", day=91), punch("P4", person="E2"))
    counts = {r.employee_id: r.record_count for r in triage.employee_history(table).collect()}
    assert counts == {"E1": 2, "E2": 1}


def test_hot_keys_do_not_change_histories(spark, sf_dir):
    from clockwright.registry.workforce import Workforce
    table = Workforce(spark, sf_dir).punches.withColumn(
        "employee_id", F.when(F.hash("punch_id") % 3 == 0, "EMP00001").otherwise(F.col("employee_id")))
    for plan in (triage.employee_history, triage.department_baseline):
        some, all_, none = (sorted(map(tuple, plan(table, max_rows_per_key=n).collect())) for n in (40, 0, 10**9))
        assert some == all_ == none


def test_unknown_employee_has_no_records(spark, punches):
    asked = spark.createDataFrame([("E1",), ("E9",)], "employee_id string")
    rows = triage.for_requested(triage.employee_history(punches(punch("P1"))), "employee_id", asked).collect()
    assert {r.employee_id: (r.record_count, r.mean_worked_hours) for r in rows} == {"E1": (1, 8.0), "E9": (0, None)}


def test_department_percentiles_interpolate(punches):
    import numpy as np
    hours = [7.0, 8.0, 8.0, 8.0, 9.5, 12.25]
    row = triage.department_baseline(punches(*[punch(f"P{i}", day=i, hours=h) for i, h in enumerate(hours)])).first()
    assert row.record_count == 6 and row.mean_worked_hours == round(np.mean(hours), 3)
    assert row.p95_worked_hours == round(np.quantile(hours, 0.95), 3)
    assert row.p95_overtime_hours == round(np.quantile([max(h - 8, 0) for h in hours], 0.95), 3)


def test_recent_records_are_twelve_oldest_first(punches):
    table = punches(*[punch(f"P{i:02d}", day=i) for i in range(20)], punch("Q1", person="E2"))
    rows = {r.employee_id: [x.punch_id for x in r.recent_records] for r in triage.recent_records(table).collect()}
    assert rows == {"E1": [f"P{i:02d}" for i in range(8, 20)], "E2": ["Q1"]}
    short = triage.recent_punches(table, days=7).where("employee_id = 'E1'")
    assert short.count() == 8


def test_single_look_ups(punches, scores):
    table = punches(punch("P1"), punch("P5", day=1))
    assert triage.flagged_record(table, scores, "P5")["anomaly_score"] == 2.0
    with pytest.raises(LookupFailed, match="unknown"):
        triage.flagged_record(table, scores, "P99")
    with pytest.raises(LookupFailed, match="not flagged"):
        triage.flagged_record(table, scores, "P1")
    context = triage.shift_context(table, "P1")
    assert (context["shift_id"], context["clock_in"]) == ("SP1", "2026-01-01T08:00:00")
    with pytest.raises(LookupFailed):
        triage.shift_context(table, "P99")


def test_one_employee_and_one_department(punches):
    table = punches(*[punch(f"P{i:02d}", day=i, hours=9.0) for i in range(15)], punch("Q1", person="E2"))
    history = triage.employee_history_of(table, "E1", 90)
    assert (history["record_count"], history["overtime_shift_count"], history["days"]) == (15, 15, 90)
    assert [r["punch_id"] for r in history["recent_records"]] == [f"P{i:02d}" for i in range(3, 15)]
    assert triage.employee_history_of(table, "E9") == {"employee_id": "E9", "record_count": 0}
    baseline = triage.department_baseline_of(table, "D1", 30)
    assert (baseline["record_count"], baseline["p95_worked_hours"], baseline["days"]) == (16, 9.0, 30)
    assert triage.department_baseline_of(table, "D9") == {"department_id": "D9", "record_count": 0}


@pytest.mark.parametrize(("days", "ok"), [(6, False), (7, True), (365, True), (366, False)])
def test_days(days, ok):
    if ok:
        assert triage.check_days(days) == days
    else:
        with pytest.raises(ValueError):
            triage.check_days(days)


def test_decisions(spark):
    import json
    good = {"classification": "escalate", "confidence": 0.9, "summary": "Unusual shift.",
            "evidence": [{"fact": "16 hours worked", "source": "current_record"}], "recommended_action": "Human review"}
    cases = {
        None: good,
        "classification": good | {"classification": "fire"},
        "confidence": good | {"confidence": 1.01},
        "summary": good | {"summary": ""},
        "evidence": good | {"evidence": [{"fact": "", "source": "x"}]},
        "recommended_action": good | {"recommended_action": "x" * 501},
    }
    texts = spark.createDataFrame([(str(k), json.dumps(v)) for k, v in cases.items()], "k string, body string")
    rows = {r.k: r for r in triage.parse_decisions(texts, "body").collect()}
    assert {k: r.problem for k, r in rows.items()} == {str(k): k for k in cases}
    decision = rows["None"].decision
    assert (decision.prompt_version, decision.tools_used, decision.missing_information) == ("v1", [], [])
    bounds = spark.createDataFrame([(json.dumps(good | {"confidence": c}),) for c in (0.0, 1.0)], "body string")
    assert triage.parse_decisions(bounds, "body").where("problem is not null").count() == 0
    bare = spark.createDataFrame([(json.dumps({k: v for k, v in good.items() if k != "evidence"}),), ("not json",)], "body string")
    assert {r.problem for r in triage.parse_decisions(bare, "body").collect()} == {None, "classification"}


def test_decisions_by_json_type(spark):
    import json
    good = {"classification": "escalate", "confidence": 0.9, "summary": "Unusual shift.", "recommended_action": "Review"}
    cases = [
        (None, {"confidence": "0.9"}), (None, {"confidence": 1}), (None, {"model": None}), (None, {"model": "m"}),
        (None, {"tools_used": ["a"]}), (None, {"evidence": []}), (None, {"extra": 1}),
        ("confidence", {"confidence": "high"}), ("confidence", {"confidence": None}), ("confidence", {"confidence": [1]}),
        ("summary", {"summary": 5}), ("evidence", {"evidence": None}), ("evidence", {"evidence": [{"fact": 1, "source": "s"}]}),
        ("evidence", {"evidence": ["x"]}), ("missing_information", {"missing_information": [1]}),
        ("missing_information", {"missing_information": "x"}), ("tools_used", {"tools_used": None}),
        ("tools_used", {"tools_used": [None]}), ("model", {"model": 3}), ("prompt_version", {"prompt_version": None}),
    ]
    texts = spark.createDataFrame([(i, json.dumps(good | change)) for i, (_, change) in enumerate(cases)], "k int, body string")
    rows = {r.k: r for r in triage.parse_decisions(texts, "body").collect()}
    assert {i: r.problem for i, r in rows.items()} == {i: problem for i, (problem, _) in enumerate(cases)}
    assert rows[0].decision.confidence == 0.9


def test_keys_that_repeat(spark):
    punches = spark.createDataFrame([("p1", "e1"), ("p1", "e1"), ("p2", "e2")], "punch_id string, employee_id string")
    scores = spark.createDataFrame([("p1", 0.9, True, "r"), ("p2", 0.1, False, "r"), ("p2", 0.1, False, "r")],
                                   "punch_id string, anomaly_score double, predicted_anomaly boolean, reason_hint string")
    with pytest.raises(LookupFailed, match="p1"):
        triage.flagged_records(punches, scores)
    assert triage.flagged_records(punches.distinct(), scores).count() == 1
    with pytest.raises(LookupFailed, match="p2"):
        review.seed(scores)


def test_days_are_checked(spark):
    with pytest.raises(ValueError):
        triage.employee_history(spark.range(1), -5)


# --- roster ------------------------------------------------------------------------------------------

def test_unknown_department_is_an_error(spark):
    from pyspark.errors import PySparkException
    employees = spark.createDataFrame(
        [("e1", "d1", "active"), ("e2", "d9", "active"), ("e3", None, "terminated")],
        "employee_id string, department_id string, employment_status string")
    departments = spark.createDataFrame([("d1", "24/7")], "department_id string, operating_schedule string")
    days = (date(2026, 1, 1), date(2026, 1, 2))
    with pytest.raises(PySparkException, match="e2"):
        roster.roster_slots(roster.roster_days(employees, departments, *days)).collect()
    assert roster.roster_slots(roster.roster_days(employees.where("employee_id <> 'e2'"), departments, *days)).count() == 2


def test_spine(spark):
    days = [r.day for r in roster.calendar_spine(spark, date(2026, 1, 1), date(2026, 1, 3)).collect()]
    assert days == [date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)]
    with pytest.raises(ValueError):
        roster.calendar_spine(spark, date(2026, 1, 3), date(2026, 1, 1))


def test_slots_and_gaps(spark):
    employees = spark.createDataFrame([("E1", "D1", "active"), ("E2", "D2", "active"), ("E3", "D1", "on_leave")],
                                      "employee_id string, department_id string, employment_status string")
    departments = spark.createDataFrame([("D1", "24/7"), ("D2", "Weekdays")],
                                        "department_id string, operating_schedule string")
    days = roster.roster_days(employees, departments, date(2026, 1, 2), date(2026, 1, 5))
    slots = roster.roster_slots(days)
    found = {(r.employee_id, r.day.day) for r in slots.collect()}
    assert found == {("E1", 2), ("E1", 3), ("E1", 4), ("E1", 5), ("E2", 2), ("E2", 5)}
    shifts = spark.createDataFrame([("E1", datetime(2026, 1, 3, 16)), ("E2", datetime(2026, 1, 2, 8))],
                                   "employee_id string, scheduled_start timestamp_ntz")
    gaps = {(r.employee_id, r.day.day) for r in roster.roster_gaps(days, shifts).collect()}
    assert gaps == found - {("E1", 3), ("E2", 2)}
    planned = roster.slot_intervals(slots.where("employee_id = 'E1' and day = '2026-01-03'"), 16).first()
    assert planned.scheduled_end == datetime(2026, 1, 4)
    with pytest.raises(Exception, match="unknown operating schedule"):
        roster.roster_days(employees, departments.withColumn("operating_schedule", F.lit("Nights")),
                           date(2026, 1, 2), date(2026, 1, 2)).collect()


def test_gaps_over_many_words(spark):
    """Ranges that begin and end inside words, before and after 1970, against sets of days."""
    employees = spark.createDataFrame([("E1", "D1", "active"), ("E2", "D2", "active")],
                                      "employee_id string, department_id string, employment_status string")
    departments = spark.createDataFrame([("D1", "24/7"), ("D2", "Weekdays")],
                                        "department_id string, operating_schedule string")
    for first, last in ((date(1969, 10, 3), date(1970, 3, 9)), (date(2025, 12, 31), date(2026, 8, 1))):
        every = [first + timedelta(n) for n in range((last - first).days + 1)]
        worked = {("E1", d) for d in every[::3]} | {("E2", d) for d in every[::2]}
        outside = {("E1", first - timedelta(1)), ("E2", last + timedelta(70)), ("E3", first)}
        shifts = spark.createDataFrame([(e, datetime(d.year, d.month, d.day, h)) for e, d in worked | outside for h in (0, 23)],
                                       "employee_id string, scheduled_start timestamp_ntz")
        days = roster.roster_days(employees, departments, first, last)
        expected = {("E1", d) for d in every} | {("E2", d) for d in every if d.weekday() < 5}
        assert sorted((r.employee_id, r.day) for r in roster.roster_slots(days).collect()) == sorted(expected)
        assert sorted((r.employee_id, r.day) for r in roster.roster_gaps(days, shifts).collect()) == sorted(expected - worked)


# --- perturbation ----------------------------------------------------------------------------------------

def test_perturbation(spark, sf_dir):
    from clockwright.registry.workforce import Workforce
    raw = Workforce(spark, sf_dir).raw.punches
    after, labels = perturb.perturb_punches(raw)
    label_checks.check_labels(labels, raw, after)
    rows = labels.collect()
    complete = raw.where("punch_status = 'complete' and clock_in like '____-%'").count()
    assert len(rows) == max(1, round(complete * settings.ANOMALY_RATE))
    assert sorted(r.anomaly_id for r in rows) == [f"ANM{i + 1:06d}" for i in range(len(rows))]
    for r in rows:
        came, left = (datetime.fromisoformat(r[f"injected_{c}"]) - datetime.fromisoformat(r[f"original_{c}"])
                      for c in ("clock_in", "clock_out"))
        if r.anomaly_type == "extremely_early_clock_in":
            assert left == timedelta(0) and timedelta(hours=-6) <= came <= timedelta(hours=-2)
        else:
            assert came == timedelta(0) and timedelta(hours=4) <= left <= timedelta(hours=10)
    assert after.count() == raw.count()
    again = perturb.perturb_punches(raw.repartition(5))[1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_labels_that_change_nothing_are_refused(spark, sf_dir):
    from clockwright.registry.workforce import Workforce
    raw = Workforce(spark, sf_dir).raw.punches
    _, labels = perturb.perturb_punches(raw)
    with pytest.raises(TransformationError, match="every label must change a timestamp"):
        label_checks.check_labels(labels, raw, raw)
