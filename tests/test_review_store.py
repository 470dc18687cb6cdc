"""The stored review table: seeding, batches, compaction, refusals and plans."""

import pytest
from pyspark.sql import functions as F

from clockwright.errors import LoadError, LookupFailed
from clockwright.plans import review, review_store
from clockwright.plans.review_store import Appended, ReviewTable
from test_plans import SCORES, START, updates


@pytest.fixture
def scores(spark):
    rows = [(f"P{i}", "S", "E", f"D{i % 2}", START, float(i // 2), i >= 4, "worked_hours") for i in range(8)]
    return spark.createDataFrame(rows, SCORES)


@pytest.fixture
def table(spark, scores, tmp_path):
    found = ReviewTable(spark, str(tmp_path / "review"), buckets=3)
    assert found.seed(scores.where("punch_id <> 'P7'")) == 7
    return found


def statuses(found):
    return {r.punch_id: (r.review_status, r.reviewer_notes) for r in found.view().collect()}


def test_batches_in_any_order_give_what_all_updates_give(spark, scores, table):
    first = updates(spark, ("P1", "resolved", "b", 5), ("P1", "legitimate", "a", 4), ("P2", "pending", None, 1),
                    ("P3", "nonsense", "x", 9))
    second = updates(spark, ("P1", "confirmed_issue", "older", 2), ("P2", "resolved", None, 3), ("P4", "resolved", "n", 1))
    assert table.append(first) == Appended(2, 1)
    assert table.append(second) == Appended(3, 0)
    expected = {r.punch_id: (r.review_status, r.reviewer_notes) for r in review.apply_updates(
        review.seed(scores.where("punch_id <> 'P7'")), first.union(second)).collect()}
    assert statuses(table) == expected and expected["P1"] == ("resolved", "b")
    assert table.compact() == 7 and statuses(table) == expected
    # an update that comes late is not the last one, also after a compaction
    assert table.append(updates(spark, ("P1", "pending", "late", 3))) == Appended(1, 0)
    assert statuses(table) == expected
    # seeding adds what is new and leaves the others alone
    assert table.seed(scores) == 8
    assert statuses(table) == expected | {"P7": ("pending", None)}


def test_a_batch_with_an_unknown_punch_is_refused_whole(spark, table):
    before = statuses(table)
    with pytest.raises(LookupFailed, match="ZZ"):
        table.append(updates(spark, ("P1", "resolved", None, 1), ("ZZ", "resolved", None, 2)))
    with pytest.raises(LoadError, match="same time"):
        table.append(updates(spark, ("P1", "resolved", None, 1), ("P1", "legitimate", None, 1)).withColumn("seq", F.lit(1)))
    assert statuses(table) == before
    with pytest.raises(LookupFailed):
        ReviewTable(spark, table._path + "-absent").view()


def test_many_batches_are_compacted_and_files_go(spark, table, monkeypatch, tmp_path):
    monkeypatch.setattr(review_store, "MAX_SEGMENTS", 3)
    for n in range(8):
        table.append(updates(spark, (f"P{n % 4}", "resolved", f"note {n}", n)))
    assert len(table._version().parts) < 3
    assert statuses(table)["P3"] == ("resolved", "note 7") and statuses(table)["P6"] == ("pending", None)
    assert len([p for p in (tmp_path / "review").iterdir() if p.name.startswith("data-")]) <= 8


def test_reading_merges_buckets_without_exchange_or_sort(spark, table):
    table.append(updates(spark, ("P1", "resolved", None, 1)))
    table.append(updates(spark, ("P2", "resolved", None, 2)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = table.view()
        text = view._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Sort" not in text.replace("SortMerge", "")
        assert text.count("ShuffledHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # a status alone is read without the notes
    assert "reviewer_notes" not in view.select("punch_id", "anomaly_score")._jdf.queryExecution().executedPlan().toString()
