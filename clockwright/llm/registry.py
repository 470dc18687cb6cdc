"""The queries over text, one per operator, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clockwright.llm import (
    bpe, exact_dedup, fingerprints, lexical_search, license_scan, line_dedup, mixing, ngram_join, periodic_runs, secret_scan, sharding,
    substring_dedup, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

#: production parameters of the placement: slots per shard bound its imbalance below one percent
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SLOTS = 4099
#: languages as given, sources and topics tempered; a fixed number of sweeps, which SQL can follow
MIX = mixing.Targets({"lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}}, temper=0.7)
SWEEPS = 8
#: the same mix with a share of the tokens to keep, and a target for every other language
SIZED_MIX = mixing.Targets(MIX.shares, MIX.temper, keep_unnamed=True)
SHARE = 0.5
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels, ~kept_out)
    return (docs.select("doc_id", kept_out.alias("held_out"), toxicity.score_column(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest factor has probability 1, as its SQL has it."""
    return mixing.probabilities(documents(spark, sf_dir), MIX, sweeps=SWEEPS, tolerance=0.0)


@query
def op4_sized_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.probabilities(documents(spark, sf_dir), SIZED_MIX, sweeps=SWEEPS, tolerance=0.0, share=SHARE)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"), "n_markov")


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query
def op6_ngram_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_counts(documents(spark, sf_dir))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    encoded = bpe.encode(documents(spark, sf_dir), vocabulary).withColumn("d", bpe.digests(vocabulary, F.col("ids")))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "d.ids_sha256", "d.decoded_sha256")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir).select("doc_id", "text"), SHARDS, SLOTS).select(
        "doc_id", "slot", "shard")


@query
def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_documents(documents(spark, sf_dir), least=fingerprints.LEAST)
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.col("best")
    return found.withColumn("best", periodic_runs.best_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def oracle_sql() -> dict[str, str]:
    from clockwright.llm import sql
    return sql.statements()
