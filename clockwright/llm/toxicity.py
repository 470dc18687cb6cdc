"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes.

A text has the set of its character 3-, 4- and 5-grams, hashed into a fixed
number of buckets.  Each bucket is scaled by the logarithm of the ratio of its
smoothed shares among toxic and other texts, and logistic regression is fitted
on the scaled buckets that tell the classes apart best.  Both classes weigh the
same, so a score of 0.5 means that the evidence for either is equal.

The classifier is fitted on at most ``MAX_ROWS_PER_CLASS`` labelled rows of each
class, those with the smallest MD5 of their id; everything else reads all rows.
The chosen ids are broadcast, which that bound limits, so only their texts are
shuffled, to leave one row per id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: labelled rows of a class that the fit reads at most
MAX_ROWS_PER_CLASS = 4_000
SIZES = (3, 4, 5)
BUCKETS = 1 << 20
#: buckets with the most evidence that the regression weighs
FEATURES = 2_000
#: labelled rows that must have a bucket before it counts
MIN_ROWS = 3

_MULTIPLIER = np.uint32(0x9E3779B1)
_STEP = np.uint32(0x01000193)


def buckets_of(text: str) -> np.ndarray:
    """Bucket of every n-gram of the text in lower case, with repeats."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found = []
    rolled = codes
    for size in range(2, max(SIZES) + 1):
        if len(codes) < size:
            break
        rolled = rolled[:-1] * _STEP + codes[size - 1:]
        if size in SIZES:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * _MULTIPLIER + np.uint32(size)
            found.append(((mixed ^ (mixed >> np.uint32(13))) * _MULTIPLIER) >> np.uint32(32 - 20))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows per bucket and class of one partition; the last bucket counts the rows themselves."""
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic, np.unique(buckets_of(text))] += 1
            counts[toxic, BUCKETS] += 1
    seen = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(counts[1, seen]), pa.array(counts[0, seen])], ["bucket", "toxic", "other"])


def training_rows(documents: DataFrame, labels: DataFrame, allowed: Column, limit: int) -> DataFrame:
    """(text, toxic) of the bounded sample, one row per id.

    Labels without a class are left out, repeated ones agree on the larger; of
    documents that share an id, the text with the largest digest is read.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = (F.md5(F.col("doc_id").cast("string")), F.col("doc_id"))
    sample = reduce_union([known.where(F.col("toxic") == c).orderBy(*order).limit(limit) for c in (0, 1)])
    return (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id").agg(F.max_by("text", F.sha2("text", 256)).alias("text"), F.max("toxic").alias("toxic"))
            .select("text", "toxic"))


def reduce_union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray     # one per bucket, 0 for those without evidence
    intercept: float

    def score(self, text: str) -> float:
        found = buckets_of(text)
        found = np.unique(found[self.weights[found] != 0])
        z = self.intercept + float(self.weights[found].sum(dtype=np.float64))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _log_odds(toxic: float, total: float) -> float:
    return math.log((toxic + 1) / (total - toxic + 1))


def fit(documents: DataFrame, labels: DataFrame, allowed: Column | None = None, *,
        limit: int = MAX_ROWS_PER_CLASS) -> ToxicityModel:
    """Fit on labelled rows for which ``allowed``, a condition on the labels' columns, holds.

    Without rows of both classes there is no evidence: the model has no weights,
    and every text scores the smoothed share of toxic labels.
    """
    spark = documents.sparkSession
    allowed = F.lit(True) if allowed is None else allowed
    rows = training_rows(documents, labels, allowed, limit)
    counts = (rows.mapInArrow(_count, "bucket long, toxic long, other long")
              .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    chosen = _most_telling(counts)
    if chosen is None:
        share = labels.where(F.col("toxic").isin(0, 1) & allowed).agg(
            F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
        return ToxicityModel(np.zeros(BUCKETS, np.float32), _log_odds(share["toxic"] or 0, share["n"]))
    buckets, ratio = chosen
    scale = np.zeros(BUCKETS, np.float32)
    scale[buckets] = ratio
    shared = spark.sparkContext.broadcast(scale)

    def present(batches):
        table = shared.value
        for batch in batches:
            packed = []
            for text in batch.column(0).to_pylist():
                found = buckets_of(text)
                packed.append(np.unique(found[table[found] != 0]).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], ["found", "toxic"])

    # at most 2 x limit rows of at most FEATURES numbers
    table = rows.mapInArrow(present, "found binary, toxic int").toArrow()
    weights, intercept = _regress(
        [np.frombuffer(x, "<u4") for x in table.column("found").to_pylist()],
        table.column("toxic").to_numpy().astype(np.float64), scale)
    return ToxicityModel(weights, intercept)


def _most_telling(counts: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The buckets that tell the classes apart best, and their log-count ratios."""
    totals = counts.where(F.col("bucket") == BUCKETS).first()
    if totals is None or not totals["toxic"] or not totals["other"]:
        return None
    p = (F.col("toxic") + 1) / F.lit(totals["toxic"] + 2.0)
    q = (F.col("other") + 1) / F.lit(totals["other"] + 2.0)
    best = (counts.where((F.col("bucket") < BUCKETS) & (F.col("toxic") + F.col("other") >= MIN_ROWS))
            .select("bucket", F.log(p / q).alias("ratio"), (F.abs(p - q) * F.abs(F.log(p / q))).alias("evidence"))
            .orderBy(F.desc("evidence"), "bucket").limit(FEATURES).select("bucket", "ratio").toPandas())
    return best["bucket"].to_numpy(), best["ratio"].to_numpy(np.float32)


def _regress(found: list[np.ndarray], toxic: np.ndarray, scale: np.ndarray, *, rounds: int = 400,
             rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled buckets; both classes weigh the same."""
    order = np.lexsort((np.array([f.sum() for f in found], np.uint64), [len(f) for f in found]))
    found, toxic = [found[i] for i in order], toxic[order]
    column, place = np.unique(np.concatenate(found), return_inverse=True)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    value = scale[column][place].astype(np.float64)
    balance = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))
    w, b = np.full(len(column), 0.05), 0.0
    first, second = np.zeros(len(column) + 1), np.zeros(len(column) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[place], len(found)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic) * balance
        gradient = np.append(np.bincount(place, value * error[row], len(column)) + ridge * w, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        step = rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    weights = np.zeros(BUCKETS, np.float32)
    weights[column] = w * scale[column]
    return weights, float(b)


def score_column(documents: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Probability that a text is toxic, 0 to 1; a null text counts as empty.

    It depends on the text alone: equal texts score alike, and order, length of
    the table and other columns do not matter.  An empty text has the score of
    the intercept.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        known = ToxicityModel(*shared.value)
        return pd.Series([known.score(t or "") for t in texts], dtype="float64")

    return score(F.col(text))


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 0 when divided by 5."""
    return F.crc32(key.cast("string")) % 5 == 0
