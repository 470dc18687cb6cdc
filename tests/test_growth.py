"""Steps whose cost per row was too high on large tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clockwright.operators import forest
from clockwright.plans import transform
from clockwright.registry.workforce import Workforce
from clockwright.sources import tables
from clockwright.sources.tables import Output, read_table


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def drawn(key, seed, purpose):
    return int(hashlib.md5(f"{key}:{seed}:{purpose}".encode()).hexdigest()[:13], 16)


@pytest.mark.parametrize("trees", [1, 7, 2_000])
def test_trees_draw_rows_by_arithmetic_on_whole_batches(spark, trees):
    rows = [(None if i == 0 else f"k{i}", float(i)) for i in range(150)]
    config = forest.ForestConfig(trees=trees, sample_size=5)
    found = forest.tree_samples(spark.createDataFrame(rows, "k string, x double"), "k", ("x",), config, len(rows))
    # no function of Spark's is called per row and tree
    assert "lambda" not in plan(found)
    numbers = [(drawn(k or "", config.seed, "forest"), drawn(k or "", config.seed, "forest-step"), k or "", x) for k, x in rows]
    expected = {(t, x) for t in range(min(trees, 40))
                for *_, x in sorted(((a + t * b) % 2 ** 52, k, x) for a, b, k, x in numbers)[:5]}
    got = [(r.tree, r["values"][0]) for r in found.where("tree < 40").collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_shifts_and_employees_are_parsed_once(spark, sf_dir):
    raw = Workforce(spark, sf_dir).raw
    employees = transform.transform_employees(raw.employees, raw.departments)
    shifts = transform.transform_shifts(raw.shifts, employees)
    for typed in (employees, shifts):
        assert "RLIKE" not in plan(typed) and "try_cast" not in plan(typed)
    assert shifts.dtypes == transform.shift_columns(raw.shifts).dtypes
    assert shifts.exceptAll(transform.shift_columns(raw.shifts)).count() == 0
    assert employees.exceptAll(transform.employee_columns(raw.employees)).count() == 0


def test_derived_columns_are_made_after_rows_are_ranged(spark, tmp_path, monkeypatch):
    seen = []
    plain = tables._sorted
    monkeypatch.setattr(tables, "_sorted", lambda rows, order: seen.append(rows.columns) or plain(rows, order))
    rows = spark.range(60).select((60 - F.col("id")).alias("id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("kind"))
    outputs = {"a": Output(f"{tmp_path}/a.parquet", ("id", "double"), ("id",)), "b": Output(f"{tmp_path}/b.parquet", ("id",))}
    written = tables.write_routed(rows, "kind", outputs, str(tmp_path), derive=lambda r: r.withColumn("double", F.col("id") * 2))
    assert written == {"a": 15, "b": 45} and seen == [["id", "kind"]]
    assert sorted(tuple(r) for r in read_table(spark, outputs["a"].path).collect()) == [(i, 2 * i) for i in range(4, 61, 4)]
    assert read_table(spark, outputs["b"].path).columns == ["id"]
