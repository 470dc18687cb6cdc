import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clockwright.operators import forest
from clockwright.operators.forest import ForestConfig, fit_forest, forest_score, mean_path
from clockwright.plans import scoring
from clockwright.registry.workforce import Workforce
from clockwright.sources.tables import read_table

COLUMNS = ("x", "y")
CONFIG = ForestConfig(trees=40, sample_size=64)


def cloud(spark, rows=2000, outliers=5):
    table = spark.range(rows).select(
        F.format_string("k%05d", "id").alias("k"),
        F.when(F.col("id") < outliers, 50.0 + F.col("id")).otherwise(F.randn(1)).alias("x"),
        F.when(F.col("id") < outliers, -40.0).otherwise(F.randn(2)).alias("y"),
    )
    return spark.createDataFrame(table.collect(), table.schema)


def walk(nodes, row):
    """Mean path length of one row by following the node rows one at a time."""
    lengths = []
    for tree in {n.tree for n in nodes}:
        table = {n.node: n for n in nodes if n.tree == tree}
        at = table[0]
        while at.feature >= 0:
            at = table[at.left_node if row[COLUMNS[at.feature]] <= at.threshold else at.right_node]
        lengths.append(at.path_length)
    return sum(lengths) / len(lengths)


def test_mean_path():
    assert (mean_path(0), mean_path(1), mean_path(2)) == (0.0, 0.0, 1.0)
    assert mean_path(256) == pytest.approx(10.244, abs=1e-3)


def test_trees_are_sound(spark):
    nodes = fit_forest(cloud(spark), "k", COLUMNS, CONFIG).collect()
    assert {n.tree for n in nodes} == set(range(40))
    limit = math.ceil(math.log2(64))
    for tree in range(40):
        table = {n.node: n for n in nodes if n.tree == tree}
        leaves = [n for n in table.values() if n.feature < 0]
        assert table[0].rows == 64 and sum(n.rows for n in leaves) == 64
        assert max(n.depth for n in leaves) <= limit
        for n in table.values():
            if n.feature >= 0:
                left, right = table[n.left_node], table[n.right_node]
                assert left.rows + right.rows == n.rows and min(left.rows, right.rows) > 0


def test_same_seed_same_trees_for_any_partitioning(spark):
    table = cloud(spark)
    grown = [sorted(map(tuple, fit_forest(table.repartition(n), "k", COLUMNS, CONFIG).collect())) for n in (1, 7)]
    assert grown[0] == grown[1]
    other = fit_forest(table, "k", COLUMNS, ForestConfig(trees=40, sample_size=64, seed=7))
    assert sorted(map(tuple, other.collect())) != grown[0]


def test_scores_match_a_walk_and_rank_outliers_first(spark):
    table = cloud(spark)
    nodes = fit_forest(table, "k", COLUMNS, CONFIG)
    scored = table.withColumn("s", forest_score(nodes, COLUMNS)).collect()
    plain = nodes.collect()
    for row in scored[:25]:
        assert row.s == pytest.approx(2 ** (-walk(plain, row) / mean_path(64)), rel=1e-12)
    assert all(0 < r.s < 1 for r in scored)
    top = sorted(scored, key=lambda r: -r.s)[:20]
    assert {f"k{i:05d}" for i in range(5)} <= {r.k for r in top}


def test_every_row_may_be_drawn(spark):
    """A table far larger than the samples: draws come from all of it."""
    rows = spark.range(80_000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("x"),
                                      F.lit(0.0).alias("y"))
    nodes = fit_forest(rows, "k", COLUMNS, ForestConfig(trees=60, sample_size=64))
    assert {r.rows for r in nodes.where("node = 0").collect()} == {64}
    splits = [r.threshold for r in nodes.where("feature = 0").collect()]
    assert min(splits) < 8_000 and max(splits) > 72_000
    assert 35_000 < sum(splits) / len(splits) < 45_000


def test_identical_rows_and_tiny_tables(spark):
    same = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    nodes = fit_forest(same, "k", COLUMNS, CONFIG)
    assert nodes.count() == 40
    assert len({r.s for r in same.select(forest_score(nodes, COLUMNS).alias("s")).collect()}) == 1
    one = same.limit(1)
    assert one.select(forest_score(fit_forest(one, "k", COLUMNS, CONFIG), COLUMNS).alias("s")).first().s == 0.5
    assert fit_forest(same.limit(0), "k", COLUMNS, CONFIG).count() == 0


def test_stored_model_scores_the_same(spark, sf_dir, tmp_path):
    w = Workforce(spark, sf_dir)
    model = scoring.train_model(w.punches, ForestConfig(trees=30))
    rows = scoring.save_artifacts(model, str(tmp_path / "model"), str(tmp_path / "scores.parquet"))
    nodes, columns, threshold = scoring.load_model(spark, str(tmp_path / "model"))
    again = scoring.score_with(w.features, nodes, columns, threshold)
    stored = read_table(spark, str(tmp_path / "scores.parquet"))
    assert rows == stored.count() == again.count()
    def plain(df):
        return sorted((r.punch_id, round(r.anomaly_score, 9), r.predicted_anomaly, r.reason_hint) for r in df.collect())
    assert plain(again) == plain(stored)
    flagged = stored.where("predicted_anomaly").count()
    assert flagged <= math.ceil(0.03 * rows) and flagged >= 0.02 * rows


def test_threshold_is_the_contamination_quantile(spark, sf_dir):
    w = Workforce(spark, sf_dir)
    model = scoring.train_model(w.punches, ForestConfig(trees=30))
    scores = np.array([r.anomaly_score for r in model.results.select("anomaly_score").collect()])
    assert np.quantile(scores, 0.97) == pytest.approx(0.0, abs=1e-12)
