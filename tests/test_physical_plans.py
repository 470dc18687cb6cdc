"""What the planner makes of the hot spots."""

import re

import pytest
from pyspark.sql import functions as F

from clockwright.operators.dedup import flag_later_copies
from clockwright.plans import evaluation, features, transform, triage
from clockwright.registry.workforce import Workforce
from clockwright.schemas import PUNCH_EVENT_KEYS
from clockwright.scratch import materialize


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(text):
    """Exchanges in the tree that the formatted plan starts with."""
    return len(re.findall(r"Exchange \(\d+\)", text.split("\n\n")[0]))


@pytest.fixture(scope="module")
def workforce(spark, sf_dir):
    return Workforce(spark, sf_dir)


def test_features_need_one_exchange(workforce):
    text = plan(features.build_features(workforce.punches))
    assert exchanges(text) == 1 and "Python" not in text and "Single" not in text
    # neither pay nor calendar columns are read
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "gross_pay" not in schema and "work_date" not in schema


def test_transform_stays_in_the_jvm(workforce):
    text = plan(workforce.classified)
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_copies_are_found_without_a_window(spark, workforce):
    flagged = flag_later_copies(transform.parsed_punches(workforce.raw.punches), PUNCH_EVENT_KEYS, ("punch_id",), "later")
    text = plan(flagged)
    assert "Window" not in text and "NestedLoop" not in text
    assert "BroadcastHashJoin" in text or "SortMergeJoin" in text or "ShuffledHashJoin" in text


def test_large_copy_tables_are_not_broadcast(spark, workforce):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_later_copies(transform.parsed_punches(workforce.raw.punches), PUNCH_EVENT_KEYS,
                                    ("punch_id",), "later")
        assert "BroadcastHashJoin" not in plan(flagged)
        assert flagged.where("later").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_tables_come_from_one_classification(workforce):
    """The written classification is scanned once for both sinks and never joined again."""
    classified = materialize(workforce.classified, "classified")
    text = plan(transform.routed_punches(classified))
    assert "Join" not in text and text.split("\n\n")[0].count("Scan parquet") == 1
    split = transform.transform_punches(workforce.raw.punches, workforce.shifts, workforce.employees)
    for part in (split.clean, split.quarantine):
        assert "Join" not in plan(part)


def test_evaluation_exchanges_keys_once(workforce):
    text = plan(evaluation.checked_confusion(materialize(workforce.scores, "scores"), materialize(workforce.labels, "labels"), workforce.punches))
    tree = text.split("\n\n")[0]
    # by punch_id, and the one row of counts
    assert exchanges(text) == 2 and "Join" not in tree and "Sort" not in tree


def test_recent_punches_are_limited_before_the_shuffle(workforce):
    text = plan(triage.recent_punches(workforce.punches))
    assert exchanges(text) == 1
    before = text.split("\n\n")[0].split("Exchange (")[1]
    assert "WindowGroupLimit" in before


def test_look_ups_are_pushed_to_the_files(workforce):
    text = plan(workforce.punches.where(F.col("punch_id") == "PCH0000001"))
    assert "EqualTo(punch_id,PCH0000001)" in text


def test_history_aggregates_before_it_shuffles(workforce):
    text = plan(triage.employee_history(workforce.punches))
    assert text.count("partial_") > 0 and "Window" not in text
