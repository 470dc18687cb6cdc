"""Isolation Forest (Liu, Ting, Zhou: Isolation Forest, ICDM 2008) on Spark.

Fit: all trees grow together, level by level.  The sampled rows are dealt by
tree once; per level every node gets the bounds of its rows, its split is drawn,
and each row steps to a child.  Draws come from MD5 of seed, tree and node, so
the same forest grows in any engine.  Score: the trees are a bounded table of
nodes that is broadcast, and every row is scored where it lies, so the data is
never shuffled.  Draws and walking are the steps that run on Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clockwright import settings
from clockwright.operators.sampling import draw, uniform
from clockwright.scratch import materialize

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, "
    "rows int, depth int, path_length double"
)
_OVERSAMPLE = 2
_SPARE = 64
_EULER = 0.5772156649015329
#: feature values are taken to this many decimals, path lengths to multiples of 1 / _PARTS, which add up alike in any order
DECIMALS = 6
_PARTS = float(2 ** 30)
#: draws are whole numbers below this
_DRAWS = 2 ** 52
_MOST_TREES = 2_000
#: draws that are made at a time
_DRAWS_TOGETHER = 300_000


@dataclass(frozen=True)
class ForestConfig:
    trees: int = settings.TREES
    sample_size: int = settings.SAMPLE_SIZE
    contamination: float = settings.CONTAMINATION
    seed: int = settings.SEED


def mean_path(rows: int) -> float:
    """Average depth of an unsuccessful search in a binary tree over ``rows`` items."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + _EULER) - 2.0 * (rows - 1.0) / rows


def _leaf_length(depth: Column, rows: Column) -> Column:
    """Depth, and the mean path that the rows of a leaf would still take."""
    n = rows.cast("double")
    rest = 2.0 * (F.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n
    return depth + F.when(rows <= 1, 0.0).when(rows == 2, 1.0).otherwise(F.rint(rest * _PARTS) / _PARTS)


def _drawing_trees(trees: int, ceiling: int):
    """The trees that draw a row with the numbers a, b below the ceiling."""
    numbers = np.arange(trees, dtype=np.int64)
    step = max(1, _DRAWS_TOGETHER // trees)

    @F.pandas_udf("array<int>")
    def drawing(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            a, b = a.to_numpy(np.int64), b.to_numpy(np.int64)
            found: list[list[int] | None] = [None] * len(a)
            for at in range(0, len(a), step):
                # below 2 ** 63, as both numbers are below 2 ** 52 and there are few trees
                drawn = (a[at:at + step, None] + numbers * b[at:at + step, None]) & (_DRAWS - 1)
                rows, trees_of_row = np.nonzero(drawn < ceiling)
                borders = np.flatnonzero(rows[1:] != rows[:-1]) + 1
                if len(rows):
                    for row, own in zip(rows[np.append(0, borders)].tolist(), np.split(trees_of_row, borders)):
                        found[at + row] = own.tolist()
            yield pd.Series(found, dtype=object)

    return drawing


def tree_samples(features: DataFrame, key: str, columns: tuple[str, ...], config: ForestConfig, rows: int) -> DataFrame:
    """(tree, values): the rows of each tree, those with its smallest draws.

    One digest per row yields two numbers a, b; tree t draws (a + t * b) modulo
    2 ** 52, so draws of different trees are pairwise independent.  Every row has
    a draw for every tree, whatever the size of the table, and only draws that
    are small enough leave it.  Equal draws go by key, then by values.
    """
    if not 0 < config.trees <= _MOST_TREES:
        raise ValueError(f"a forest has 1 to {_MOST_TREES} trees, not {config.trees}")
    size = min(config.sample_size, rows)
    # enough candidates that a tree short of its sample is out of the question
    ceiling = min(_DRAWS, math.ceil((_OVERSAMPLE * size + _SPARE) / max(rows, 1) * _DRAWS))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    # only rows that a tree draws have their values rounded
    values = F.array(*[F.round(F.col(f"v{i}").cast("double"), DECIMALS) for i in range(len(columns))])
    drawn = features.select(name.alias("key"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)],
                            draw(name, config.seed, "forest").alias("a"), draw(name, config.seed, "forest-step").alias("b"))
    a, b = F.col("a"), F.col("b")
    candidates = (drawn.withColumn("trees", _drawing_trees(config.trees, ceiling)(a, b)).where(F.col("trees").isNotNull())
                  .withColumn("tree", F.explode("trees")).select("key", values.alias("values"), "a", "b", "tree"))
    own = Window.partitionBy("tree").orderBy(
        F.pmod(a + F.col("tree").cast("bigint") * b, F.lit(_DRAWS)), "key", "values")
    return (candidates.withColumn("place", F.row_number().over(own)).where(F.col("place") <= size)
            .select("tree", "values"))


def _level(rows: DataFrame, width: int, depth: int, limit: int, seed: int) -> DataFrame:
    """One level: bounds per node, a drawn split, and each row's step; the node is added to the row's ``path``."""
    node = Window.partitionBy("tree", "node")
    values = F.col("values")
    bounded = rows.withColumns(
        {"rows": F.count(F.lit(1)).over(node),
         "low": F.array(*[F.min(values[i]).over(node) for i in range(width)]),
         "high": F.array(*[F.max(values[i]).over(node) for i in range(width)])})
    varying = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.get(F.col("low"), i) < F.get(F.col("high"), i))
    name = F.concat_ws(":", "tree", "node")
    leaf = (F.lit(depth >= limit) | (F.col("rows") <= 1) | (F.size("varying") == 0))
    chosen = bounded.withColumn("varying", varying).withColumn("feature", F.when(leaf, -1).otherwise(
        F.get(F.col("varying"), F.floor(uniform(name, seed, "feature") * F.size("varying")).cast("int"))))
    low, high = F.get(F.col("low"), F.col("feature")), F.get(F.col("high"), F.col("feature"))
    between = low + uniform(name, seed, "threshold") * (high - low)
    split = chosen.withColumn("threshold", F.when(F.col("feature") < 0, 0.0).otherwise(F.when(between < high, between).otherwise(low)))
    here = F.struct("node", "feature", "threshold", "rows", F.lit(depth).alias("depth"))
    right = F.get(values, F.col("feature")) > F.col("threshold")
    return split.select(
        "tree", "values",
        F.when(F.col("ended"), F.col("path")).otherwise(F.array_append("path", here)).alias("path"),
        F.when(F.col("ended") | (F.col("feature") < 0), F.col("node"))
        .otherwise(2 * F.col("node") + 1 + right.cast("int")).alias("node"),
        (F.col("ended") | (F.col("feature") < 0)).alias("ended"))


def fit_forest(features: DataFrame, key: str, columns: tuple[str, ...] = settings.FEATURE_COLUMNS,
               config: ForestConfig = ForestConfig()) -> DataFrame:
    """The node table of a forest grown on ``features`` (a written table).

    Children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1 and leads
    to itself.  A node that is no leaf splits on a feature that varies in it, at a
    uniform point between the bounds; smaller or equal values go left.  The
    forest is the same for any partitioning.  A tree's rows are a group of
    ``sample_size`` at most, dealt once: levels need no further exchange.
    """
    total = features.count()
    if total == 0:
        return features.sparkSession.createDataFrame([], NODE_SCHEMA)
    limit = math.ceil(math.log2(max(min(config.sample_size, total), 2)))
    rows = tree_samples(features, key, columns, config, total).select(
        "tree", "values", F.lit(0).alias("node"), F.lit(False).alias("ended"),
        F.lit(None).cast("array<struct<node: int, feature: int, threshold: double, rows: bigint, depth: int>>").alias("path"))
    rows = rows.withColumn("path", F.coalesce("path", F.array().cast(rows.schema["path"].dataType)))
    for depth in range(limit + 1):
        rows = _level(rows, len(columns), depth, limit, config.seed)
    node, leaf = F.col("node"), F.col("feature") < 0
    nodes = (rows.select("tree", F.explode("path").alias("n")).select("tree", "n.*").distinct()
             .select("tree", "node", "feature", "threshold",
                     F.when(leaf, node).otherwise(2 * node + 1).alias("left_node"),
                     F.when(leaf, node).otherwise(2 * node + 2).alias("right_node"),
                     F.col("rows").cast("int").alias("rows"), "depth",
                     F.when(leaf, _leaf_length(F.col("depth"), F.col("rows"))).otherwise(0.0).alias("path_length")))
    return materialize(nodes, "forest-nodes")


@dataclass(frozen=True)
class _Walk:
    """Trees laid out level by level, child 2i+1 or 2i+2 of slot i, all of one depth.

    Leaves above the last level are followed by slots that always lead left, so
    every walk takes ``depth`` steps and needs no links.
    """

    depth: int
    feature: np.ndarray     # tree x inner slot
    threshold: np.ndarray   # tree x inner slot
    length: np.ndarray      # tree x slot of the last level
    normal: float

    @classmethod
    def from_nodes(cls, table: pd.DataFrame) -> _Walk:
        trees, depth = table["tree"].nunique(), int(table["depth"].max())
        inner = 2 ** depth - 1
        feature = np.zeros((trees, inner), dtype=np.int64)
        threshold = np.full((trees, inner), np.inf)
        length = np.zeros((trees, inner + 1))
        for at, (_, nodes) in enumerate(table.groupby("tree", sort=True)):
            for node in nodes.itertuples():
                if node.feature >= 0:
                    feature[at, node.node], threshold[at, node.node] = node.feature, node.threshold
                else:
                    # the slot reached by going left from here to the last level
                    last = ((node.node + 1) << (depth - node.depth)) - 1
                    length[at, last - inner] = node.path_length
        sample = int(table.loc[table["node"] == 0, "rows"].max())
        return cls(depth, feature, threshold, length, mean_path(sample))

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        if not self.normal:
            return np.full(len(matrix), 0.5)
        rows, width = matrix.shape
        flat, base = np.ascontiguousarray(matrix).ravel(), np.arange(rows) * width
        total = np.zeros(rows)
        at, place = np.empty(rows, dtype=np.int64), np.empty(rows, dtype=np.int64)
        value, split = np.empty(rows), np.empty(rows)
        for feature, threshold, length in zip(self.feature, self.threshold, self.length):
            at.fill(0)
            for _ in range(self.depth):
                np.take(feature, at, out=place, mode="clip")
                place += base
                np.take(flat, place, out=value, mode="clip")
                np.take(threshold, at, out=split, mode="clip")
                at += at
                at += 1
                at += value > split
            at -= len(threshold)
            total += length.take(at, mode="clip")
        return np.exp2(-total / (len(self.feature) * self.normal))


def forest_score(nodes: DataFrame, columns: tuple[str, ...] = settings.FEATURE_COLUMNS) -> Column:
    """Isolation score in (0, 1) of the row's feature columns; higher is more anomalous.

    ``nodes`` has at most trees x (2 x sample size - 1) rows, which is what gets
    collected and broadcast, as at most trees x 4 x sample size slots.  Only the
    feature columns travel to Python.
    """
    table = nodes.toPandas()
    if table.empty:
        raise ValueError("the forest has no nodes")
    shared = nodes.sparkSession.sparkContext.broadcast(_Walk.from_nodes(table))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        walk = shared.value
        for batch in batches:
            yield pd.Series(walk.scores(np.column_stack([s.to_numpy(dtype=np.float64) for s in batch])))

    return score(*[F.round(F.col(c).cast("double"), DECIMALS) for c in columns])
