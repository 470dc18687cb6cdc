"""Scores, flags and the stored model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from clockwright import settings
from clockwright.operators.forest import ForestConfig, fit_forest, forest_score
from clockwright.operators.quantile import exact_quantile
from clockwright.plans.features import HINT, build_features, with_reason_hint
from clockwright.schemas import SCORE_KEY_COLUMNS
from clockwright.scratch import materialize
from clockwright.sources.tables import read_table, write_table

SCORE = "anomaly_score"
FLAG = "predicted_anomaly"


@dataclass(frozen=True)
class ScoredModel:
    nodes: DataFrame
    results: DataFrame
    threshold: float
    features: tuple[str, ...] = settings.FEATURE_COLUMNS


def flag_top(scored: DataFrame, score: str, contamination: float = settings.CONTAMINATION) -> tuple[DataFrame, float | None]:
    """Flag the rows strictly above the (1 - contamination) quantile of ``score``.

    ``scored`` is a written table; it is scanned for the quantile and then again.
    """
    threshold = exact_quantile(scored, score, 1.0 - contamination)
    above = F.lit(False) if threshold is None else F.col(score) > F.lit(threshold)
    return scored.withColumn(FLAG, above), threshold


def results_table(flagged: DataFrame) -> DataFrame:
    return flagged.select(*SCORE_KEY_COLUMNS, SCORE, FLAG, HINT)


def train_model(punches: DataFrame, config: ForestConfig = ForestConfig()) -> ScoredModel:
    """Fit a forest on the punches and score every one of them.

    The score is the isolation score minus the contamination threshold, so that
    flagged rows are exactly those above zero.
    """
    features = materialize(with_reason_hint(build_features(punches)), "features")
    nodes = fit_forest(features, "punch_id", config=config)
    raw = materialize(
        features.select(*SCORE_KEY_COLUMNS, forest_score(nodes).alias("isolation"), HINT), "isolation")
    flagged, threshold = flag_top(raw, "isolation", config.contamination)
    results = results_table(flagged.withColumn(SCORE, F.col("isolation") - F.lit(threshold)))
    return ScoredModel(nodes, results, threshold)


def save_artifacts(model: ScoredModel, model_dir: str, scores_path: str) -> int:
    """Store nodes, feature list and threshold as tables, then the scores; returns the score rows."""
    spark = model.nodes.sparkSession
    facts = spark.range(1).select(F.lit(list(model.features)).alias("features"),
                                  F.lit(model.threshold).cast("double").alias("threshold"))
    write_table(model.nodes, f"{model_dir}/nodes.parquet")
    write_table(facts, f"{model_dir}/model.parquet")
    return write_table(model.results, scores_path, sort_by=("punch_id",))


def load_model(spark: SparkSession, model_dir: str) -> tuple[DataFrame, tuple[str, ...], float]:
    facts = read_table(spark, f"{model_dir}/model.parquet").first()
    return read_table(spark, f"{model_dir}/nodes.parquet"), tuple(facts.features), facts.threshold


def score_with(features: DataFrame, nodes: DataFrame, columns: tuple[str, ...], threshold: float) -> DataFrame:
    """Score a feature table with a stored model, without fitting or any shuffle."""
    scored = with_reason_hint(features).withColumn(SCORE, forest_score(nodes, columns) - F.lit(threshold))
    return results_table(scored.withColumn(FLAG, F.col(SCORE) > 0.0))
