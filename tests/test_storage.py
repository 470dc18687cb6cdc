import json
import os

import pytest
from pyspark.sql import functions as F

from clockwright.errors import ExtractionError, LoadError
from clockwright.plans.etl import run_etl
from clockwright.registry.workforce import Workforce
from clockwright.scratch import materialize, scratch_root
from clockwright.sources import tables, versions
from clockwright.sources.raw import RawPaths


def test_write_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert tables.write_table(spark.range(10).toDF("v"), path) == 10
    assert tables.write_table(spark.range(3).toDF("v"), path, sort_by=("v",)) == 3
    assert sorted(r.v for r in tables.read_table(spark, path).collect()) == [0, 1, 2]
    assert os.listdir(tmp_path) == ["t.parquet"]


def test_empty_tables(spark, tmp_path):
    for n, empty in enumerate((spark.createDataFrame([], "v long"), spark.range(5).toDF("v").where("v > 9"),
                               spark.range(5).toDF("v").where("false"))):
        path = str(tmp_path / f"t{n}.parquet")
        assert tables.write_table(empty, path, sort_by=("v",)) == 0
        assert tables.read_table(spark, path).count() == 0


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    tables.write_table(spark.range(4).toDF("v"), path)
    broken = spark.range(4).select(F.raise_error(F.lit("boom")).cast("long").alias("v"))
    with pytest.raises(LoadError):
        tables.write_table(broken, path)
    assert tables.read_table(spark, path).count() == 4
    assert len([n for n in os.listdir(path) if n.startswith("data-")]) == 1


def test_a_table_may_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    tables.write_table(spark.range(4).toDF("v"), path)
    tables.write_table(tables.read_table(spark, path).where("v > 1"), path)
    assert tables.read_table(spark, path).count() == 2


def test_a_reader_sees_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    tables.write_table(spark.range(4).toDF("v"), path)
    pinned = tables.read_table(spark, path)
    draft = versions.Draft(spark, path)
    spark.range(100, 109).toDF("v").write.parquet(draft.data)
    # the new files are there, but are no version yet
    assert tables.read_table(spark, path).count() == 4
    draft.commit(9)
    assert sorted(r.v for r in tables.read_table(spark, path).collect()) == list(range(100, 109))
    assert sorted(r.v for r in pinned.collect()) == [0, 1, 2, 3]
    assert versions.newest(spark, path).rows == 9


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    tables.write_table(spark.range(1).toDF("v"), path)
    first, second = versions.Draft(spark, path), versions.Draft(spark, path)
    for draft, rows in ((first, 2), (second, 3)):
        spark.range(rows).toDF("v").write.parquet(draft.data)
    second.commit(3)
    with pytest.raises(LoadError, match="someone else"):
        first.commit(2)
    assert tables.read_table(spark, path).count() == 3


def test_half_a_manifest_is_no_version_and_old_ones_go(spark, tmp_path):
    path = tmp_path / "t.parquet"
    for n in range(6):
        tables.write_table(spark.range(n + 1).toDF("v"), str(path))
    assert len([n for n in os.listdir(path) if n.startswith("data-")]) == versions.KEEP
    (path / "_manifests" / f"{7:020d}.json").write_text('{"version": 7, "da')
    assert tables.read_table(spark, str(path)).count() == 6
    tables.write_table(spark.range(20).toDF("v"), str(path))
    assert tables.read_table(spark, str(path)).count() == 20


def test_one_pass_writes_several_tables(spark, tmp_path):
    rows = spark.range(100).select(F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("kind"), "id",
                                   (F.col("id") * 2).alias("twice"))
    outputs = {"a": tables.Output(str(tmp_path / "a.parquet"), ("id", "twice"), ("id",)),
               "b": tables.Output(str(tmp_path / "b.parquet"), ("id",)),
               "none": tables.Output(str(tmp_path / "none.parquet"), ("twice",))}
    for _ in range(2):
        assert tables.write_routed(rows, "kind", outputs, str(tmp_path)) == {"a": 25, "b": 75, "none": 0}
    a, b, none = (tables.read_table(spark, o.path) for o in outputs.values())
    assert sorted(map(tuple, a.collect())) == [(i, 2 * i) for i in range(0, 100, 4)]
    assert b.columns == ["id"] and b.count() == 75
    assert none.columns == ["twice"] and none.count() == 0
    with pytest.raises(LoadError, match="names no output"):
        tables.write_routed(rows.withColumn("kind", F.lit("x")), "kind", outputs, str(tmp_path))
    assert tables.read_table(spark, outputs["a"].path).count() == 25


def test_look_ups_skip_files_that_are_ranged_by_another_column(spark, tmp_path):
    """Every file spans all keys; their Bloom filters still rule an absent key out."""
    path = str(tmp_path / "t.parquet")
    table = spark.range(20_000).select(F.format_string("K%06d", F.pmod(F.col("id") * 7919, F.lit(20_000)) * 2).alias("k"), "id")
    tables.write_table(table.repartition(8, "id"), path, look_up=("k",))

    def scanned(key):
        query = tables.read_table(spark, path).where(F.col("k") == key)
        found = query.collect()
        plan, rows = query._jdf.queryExecution().executedPlan(), None
        while plan.children().size():
            plan = plan.children().apply(0)
        metrics = plan.metrics().get("numOutputRows")
        return len(found), metrics.get().value() if metrics.isDefined() else rows

    assert scanned("K000777") == (0, 0)
    found, rows = scanned("K000778")
    assert found == 1 and 0 < rows < 20_000


def test_formats(spark, tmp_path):
    with pytest.raises(LoadError, match="unsupported"):
        tables.write_table(spark.range(1), str(tmp_path / "t.xlsx"))
    with pytest.raises(ExtractionError):
        tables.read_table(spark, str(tmp_path / "absent.parquet"))
    path = str(tmp_path / "t.csv")
    tables.write_table(spark.createDataFrame([('x"y', None)], "a string, b string").coalesce(1), path)
    text = "".join(p.read_text() for p in (tmp_path / "t.csv").rglob("part-*"))
    assert text == 'a,b\n"x""y",\n'


def test_metrics_document(spark, tmp_path):
    document = tables.write_metrics(spark.sql("select 0.5D as precision, 3L as true_positives"), str(tmp_path / "m"))
    assert document == {"precision": 0.5, "true_positives": 3}
    assert json.loads("".join(p.read_text() for p in (tmp_path / "m").glob("part-*"))) == document


def test_scratch_is_where_the_session_says(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    table = materialize(spark.range(5), "t")
    assert table.inputFiles()[0].removeprefix("file://").removeprefix("file:").startswith(
        scratch_root(spark).removeprefix("file://").removeprefix("file:"))


def test_etl_twice_gives_the_same_tables(spark, sf_dir, tmp_path):
    raw = Workforce(spark, sf_dir).raw.as_dict()
    paths = {name: str(tmp_path / "raw" / f"{name}.csv") for name in raw}
    tables.write_raw_csv(raw, paths)
    contents = []
    for _ in range(2):
        written = run_etl(spark, RawPaths(**paths), str(tmp_path / "out"))
        assert set(written) == {"departments", "employees", "shifts", "punches", "quarantine", "labels"}
        contents.append({n: sorted(map(str, tables.read_table(spark, p).collect())) for n, (p, _) in written.items()})
        assert {n: len(rows) for n, rows in contents[-1].items()} == {n: r for n, (_, r) in written.items()}
    assert contents[0] == contents[1]
    assert written["punches"][1] + written["quarantine"][1] == raw["punches"].count()
