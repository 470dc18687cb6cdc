"""From raw documents to a tokenized training mix, as stages that are stored one after another.

Every stage works on all rows its predecessor kept.  The first four return the
columns of documents; the last returns what a training job reads.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clockwright.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from clockwright.scratch import materialize

#: score from which a document counts as toxic
TOXIC = 0.5
#: the target mix: languages as given, others as they are, sources and topics tempered
TARGETS = mixing.Targets({"lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}}, temper=0.7, keep_unnamed=True)
#: part of the tokens that the mix keeps
SHARE = 0.5
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learned from labels outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    return docs.where(toxicity.score_column(docs, model) < TOXIC)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets, the one with the smallest id."""
    return ngram_join.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that a share of the tokens is expected to stay, mixed as the targets ask."""
    return mixing.sample(docs, TARGETS, share=SHARE)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and the SHA-256 of the bytes that the ids decode to."""
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    ids = bpe.encode(docs, vocabulary, digest=True)
    return ids.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "decoded_sha256")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("near_dedup", drop_near),
          ("mixing", mix), ("encoding", tokenize)]

#: a trained classifier and the encoder are beyond SQL; the tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
