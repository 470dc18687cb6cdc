"""Operators against brute force, on inputs small enough to check by hand."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clockwright.errors import TransformationError
from clockwright.operators import ordered, quality, quantile, snapshots
from clockwright.operators.dedup import flag_later_copies
from clockwright.operators.numbering import number_rows
from clockwright.operators.ordered import with_previous_and_stats
from clockwright.operators.quantile import exact_quantile, order_statistics, smallest_cut
from clockwright.operators.sampling import choose, sample_size, seeded_sample, uniform, weighted_choice


# --- order statistics ----------------------------------------------------------------

def _value_sets():
    r = random.Random(7)
    return {
        "distinct": [r.gauss(0, 1) for _ in range(5000)],
        "ties": [float(r.randrange(4)) for _ in range(5000)],
        "one_value": [1.5] * 3000,
        "two_heavy": [0.0] * 2500 + [1.0] * 2500,
        "hot_value": [r.random() for _ in range(2000)] + [0.5] * 1000,
    }


@pytest.mark.parametrize("name", list(_value_sets()))
def test_order_statistics_by_search(spark, monkeypatch, name):
    monkeypatch.setattr(quantile, "_SORTABLE", 20)
    monkeypatch.setattr(quantile, "_ACCURACY", 50)
    values = _value_sets()[name]
    table = spark.createDataFrame([(v,) for v in values], "v double").cache()
    ranked = sorted(values)
    for rank in (0, 1, len(values) // 3, len(values) // 2, len(values) - 2):
        assert order_statistics(table, "v", rank, rank + 1) == (ranked[rank], ranked[rank + 1])
    for share in (0.0, 0.03, 0.5, 0.97, 1.0):
        assert exact_quantile(table, "v", share) == pytest.approx(np.quantile(values, share), abs=1e-12)


def test_quantile_of_nothing(spark):
    table = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert exact_quantile(table, "v", 0.5) is None
    with pytest.raises(ValueError):
        order_statistics(table, "v", 0, 0)


def test_cut_takes_exactly_k_rows_despite_ties(spark, monkeypatch):
    monkeypatch.setattr(quantile, "_SORTABLE", 10)
    rows = [(i % 3, f"k{i:03d}") for i in range(300)]
    table = spark.createDataFrame(rows, "v long, k string")
    for k in (1, 50, 100, 101, 299, 300):
        cut = smallest_cut(table, "v", k, "k")
        got = {tuple(r) for r in table.where(cut.holds(F.col("v"), F.col("k"))).collect()}
        assert got == set(sorted(rows)[:k])


# --- first occurrences ------------------------------------------------------------------

def _copies():
    rows = [("a", None, i, f"p{i}") for i in (3, 1, 2)]
    rows += [("b", "x", 1, "p9"), ("c", None, 5, "p5"), ("c", None, 5, "p5"), ("c", None, 5, "p5")]
    return rows


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_first_copy_is_kept(spark, parts):
    table = spark.createDataFrame(_copies(), "k string, l string, n int, p string").repartition(parts)
    flagged = flag_later_copies(table, ("k", "l"), ("n",), "later")
    counts = Counter((r.k, r.p, r.later) for r in flagged.collect())
    assert counts == Counter({("a", "p1", False): 1, ("a", "p2", True): 1, ("a", "p3", True): 1,
                              ("b", "p9", False): 1, ("c", "p5", False): 1, ("c", "p5", True): 2})


def test_only_eligible_rows_are_compared(spark):
    table = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True)], "k string, n int, ok boolean")
    flagged = flag_later_copies(table, ("k",), ("n",), "later", F.col("ok"))
    assert {r.n: r.later for r in flagged.collect()} == {1: False, 2: False, 3: True}


def test_many_copies_of_one_row(spark):
    table = spark.range(30_000).select(F.lit("same").alias("k"), F.lit(1).alias("n"))
    assert flag_later_copies(table, ("k",), ("n",), "later").where("not later").count() == 1


# --- previous row and statistics ------------------------------------------------------------

@pytest.mark.parametrize("limit", [10**9, 40, 1])
@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("hot", ["hot", None])
def test_hot_groups_give_the_same_result(spark, limit, parts, hot):
    r = random.Random(3)
    rows = [(hot if i % 3 else f"e{i % 7}", r.randrange(50), f"p{i:04d}", r.random()) for i in range(600)]
    rows.append(("single", 1, "p9999", 0.25))
    table = spark.createDataFrame(rows, "e string, t int, p string, v double").repartition(parts)
    got = with_previous_and_stats(
        table, "e", ("t", "p"), ("p", "before"),
        {"mean": F.avg("v"), "std": F.stddev_samp("v")}, max_rows_per_key=limit,
    ).collect()
    assert len(got) == len(rows)
    groups = {}
    for row in sorted(rows, key=lambda x: (x[0] or "", x[1], x[2])):
        groups.setdefault(row[0], []).append(row)
    expected = {}
    for members in groups.values():
        values = [m[3] for m in members]
        std = np.std(values, ddof=1) if len(values) > 1 else None
        for before, row in zip([None, *members], members):
            expected[row[2]] = (before and before[2], np.mean(values), std)
    for row in got:
        before, mean, std = expected[row.p]
        assert row.before == before
        assert row["mean"] == pytest.approx(mean)
        assert row["std"] is None if std is None else row["std"] == pytest.approx(std)


def test_hot_keys(spark):
    table = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "k string")
    assert [r.k for r in ordered.hot_keys(table, "k", 3).collect()] == ["a"]


# --- snapshots ----------------------------------------------------------------------------------

@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_snapshots_differ_where_rows_do(spark, buckets):
    rng = random.Random(buckets)
    before = {f"k{i}": (rng.choice(["a", None]), i % 3) for i in range(300)}
    after = {k: v for k, v in before.items() if rng.random() > 0.01}
    for key in rng.sample(sorted(after), 9):
        after[key] = ("changed", None)
    after |= {f"new{i}": (None, None) for i in range(4)}
    expected = {k: "removed" for k in before if k not in after} | {k: "added" for k in after if k not in before}
    expected |= {k: "changed" for k in before if k in after and before[k] != after[k]}

    def table(rows):
        return spark.createDataFrame([(k, *v) for k, v in rows.items()], "k string, a string, b int")

    found = snapshots.changed_rows(table(before), table(after), "k", ("a", "b"), buckets).collect()
    assert {r.k: r.change for r in found} == expected and len(found) == len(expected)
    assert snapshots.changed_rows(table(before), table(before).repartition(5), "k", ("a", "b"), buckets).count() == 0
    if buckets > 1000:      # buckets without a difference are not read closely
        assert snapshots.changed_buckets(table(before), table(after), "k", ("a", "b"), buckets).count() <= len(expected)


# --- numbering ----------------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 3, 8])
def test_numbers_follow_the_order(spark, parts):
    values = [f"k{i:04d}" for i in range(500)]
    table = spark.createDataFrame([(v,) for v in random.Random(1).sample(values, 500)], "k string").repartition(parts)
    numbered = {r.k: r.n for r in number_rows(table, ("k",), "n").collect()}
    assert numbered == {v: i + 1 for i, v in enumerate(values)}


def test_numbers_with_equal_and_null_keys(spark):
    table = spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), ("b", 3)], "k string, v int")
    rows = number_rows(table, ("k",), "n", start=0).collect()
    assert sorted(r.n for r in rows) == [0, 1, 2, 3]
    assert {r.n for r in rows if r.k == "a"} == {0, 1} and [r.n for r in rows if r.k is None] == [3]


# --- sampling ---------------------------------------------------------------------------------------

@pytest.mark.parametrize(("rows", "expected"), [(0, 0), (1, 1), (10, 1), (50, 2), (150, 4), (1000, 30)])
def test_sample_size(rows, expected):
    assert sample_size(rows, 0.03) == expected


def test_sample_size_of_a_negative_count():
    with pytest.raises(ValueError):
        sample_size(-1)


@pytest.mark.parametrize("seed", [42, 3])
def test_sample_splits_a_shared_key(spark, seed):
    rows = [(f"k{i}" if i >= 400 else "shared", i) for i in range(1000)]
    sample = seeded_sample(spark.createDataFrame(rows, "k string, v int").repartition(5), "k", rate=0.3, seed=seed)
    assert sample.count() == sample.distinct().count() == 300


@pytest.mark.parametrize("rate, size", [(1.0, 500), (0.5, 250), (0.001, 1)])
def test_sample_of_null_keys(spark, rate, size):
    rows = spark.range(500).select(F.lit(None).cast("string").alias("k"), "id")
    assert seeded_sample(rows, "k", rate=rate).distinct().count() == size


def test_sample_of_rows_that_repeat_in_full(spark):
    rows = spark.range(900).select(F.when(F.col("id") < 600, "same").otherwise(F.col("id").cast("string")).alias("k"))
    for rate in (0.1, 0.5, 0.9):
        assert seeded_sample(rows.repartition(7), "k", rate=rate, seed=1).count() == round(900 * rate)
    assert seeded_sample(rows.limit(0), "k").count() == 0
    alike = spark.range(100).select(F.lit("same").alias("k"))
    with pytest.raises(ValueError, match="repeat in full"):
        choose(alike, "k", 0.3, 1)


def test_sample_is_what_ordering_finds(spark):
    rows = [(f"k{i % 7}", i) for i in range(300)]
    table = spark.createDataFrame(rows, "k string, v int")

    def place(k, v):
        text = hashlib.md5(f"{k}:9:sample".encode()).hexdigest()[:13]
        return text + hashlib.md5(f"{k}\x1f{v}".encode()).hexdigest()[:13]

    expected = sorted(rows, key=lambda r: place(*r))[:75]
    assert sorted(map(tuple, seeded_sample(table, "k", rate=0.25, seed=9).collect())) == sorted(expected)


def test_sample_does_not_depend_on_partitioning(spark):
    table = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    samples = [
        {r.k for r in seeded_sample(table.repartition(n), "k", rate=0.1, seed=5).collect()} for n in (1, 3, 8)]
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 200
    assert samples[0] != {r.k for r in seeded_sample(table, "k", rate=0.1, seed=6).collect()}


def test_uniform_draws_and_weights(spark):
    table = spark.range(20_000).select(uniform(F.col("id"), 1, "t").alias("u"))
    stats = table.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] < 0.001 and 0.999 < stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
    picked = table.select(weighted_choice(F.col("u"), {"a": 0.4, "b": 0.35, "c": 0.25}).alias("x"))
    shares = {r.x: r["count"] / 20_000 for r in picked.groupBy("x").count().collect()}
    assert shares == pytest.approx({"a": 0.4, "b": 0.35, "c": 0.25}, abs=0.02)


# --- rules ----------------------------------------------------------------------------------------------

def _report(df):
    return {r.rule: r.violations for r in df.collect()}


def test_required_columns(spark):
    with pytest.raises(TransformationError, match=r"\['department_name', 'operating_schedule'\]"):
        quality.require_columns(spark.createDataFrame([("D1",)], "department_id string"), "departments")


def test_table_report(spark):
    table = spark.createDataFrame([("a", 1), ("a", -1), (None, 2), ("b", None)], "k string, v int")
    report = quality.table_report(table, "t", {"v positive": F.col("v") <= 0}, key="k", expected_rows=5,
                                  allow_empty=False)
    assert _report(report) == {"v positive": 1, "k must be non-null and unique": 2, "table must not be empty": 0,
                               "row count must be as expected": 1}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v int")
    report = quality.table_report(empty, "t", {"v positive": F.col("v") <= 0}, key="k", allow_empty=False)
    assert _report(report) == {"v positive": 0, "k must be non-null and unique": 0, "table must not be empty": 1}


def test_references(spark):
    parent = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, d string")
    child = spark.createDataFrame([("a", "x"), ("a", "z"), ("a", "z"), ("q", "x"), (None, "x")], "k string, d string")
    report = quality.reference_report(child, "c", "k", parent, "parents", ("d",))
    assert _report(report) == {"k must exist in parents": 2, "d must agree with parents": 2}
    assert {r.k: r.key_rows for r in quality.unknown_references(child, "k", parent).collect()} == {"q": 1, None: 1}


def test_enforce_names_rule_count_and_samples(spark):
    child = spark.createDataFrame([("q",), ("r",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    report = quality.reference_report(child, "c", "k", parent, "parents")
    with pytest.raises(TransformationError, match=r"c: k must exist in parents \(2\).*\['q', 'r'\]") as error:
        quality.enforce(report, {"k must exist in parents": quality.unknown_references(child, "k", parent)})
    path = re.search(r"2 different keys, all in (\S+),", str(error.value)).group(1)
    assert {r.k for r in spark.read.parquet(path).collect()} == {"q", "r"}
    quality.enforce(quality.reference_report(parent, "c", "k", parent, "parents"))


def test_unique_key_requirement(spark):
    with pytest.raises(TransformationError):
        quality.require_unique(spark.createDataFrame([("a",), ("a",)], "k string"), "t", "k")
