"""Exact duplicates against a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table of (digest, keep_id), bucketed and sorted by the
SHA-256 of the text.  A batch of documents is reduced to one row per digest,
map-side first, so thousands of copies shuffle as a few counts; the digests
that the index does not hold are found by a sort-merge anti-join that reads the
index without an exchange, and appended.  Every document is then joined with
the row of its digest; both sides of that join are exchanged, so adaptive skew
splitting cuts a digest that holds a third of the rows.

Only digests and identifiers are shuffled, never texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clockwright.scratch import materialize, scratch_path

ID, TEXT = "doc_id", "text"
#: stands for a null id where ids are compared
_LOWEST = -(2 ** 63)


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


@dataclass(frozen=True)
class DigestIndex:
    """The stored index.  ``buckets`` is fixed when the index is first written."""

    spark: SparkSession
    path: str
    buckets: int

    @property
    def table(self) -> str:
        """Name in the session's catalogue; the files under ``path`` are what persists."""
        name = "digest_index_" + "".join(c if c.isalnum() else "_" for c in self.path)[-100:].lower()
        self.spark.sql(
            f"create table if not exists {name} (digest binary, keep_id bigint) using parquet "
            f"clustered by (digest) sorted by (digest) into {self.buckets} buckets location '{self.path}'")
        return name

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index does not hold."""
        return groups.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        (groups.select("digest", "keep_id").repartition(self.buckets, "digest")
         .write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)

    def add(self, documents: DataFrame) -> DataFrame:
        """Deduplicate a batch, append its new texts, and return a decision per row.

        Columns: doc_id, digest, keep_id (the document that stays), group_size
        (rows of this batch with the text), kept.

        Of equal texts in a batch the largest doc_id stays, nulls last; a text
        that an earlier batch brought stays with the document of that batch.
        Exactly one row of a batch is kept per new text, also when whole rows
        repeat.  Null texts count as empty, empty texts are texts like others,
        an empty batch changes nothing.  Only doc_id and text are read, so
        other columns may have any name.

        A run that broke off can be repeated: texts it had appended are found
        under the identifiers it had chosen, and the decisions are the same.
        """
        digests = materialize(
            documents.select(F.col(ID).cast("bigint").alias(ID), text_digest(F.col(TEXT)).alias("digest"))
            .withColumn("row", F.monotonically_increasing_id()), "digests")
        groups = materialize(
            digests.groupBy("digest")
            .agg(F.max(ID).alias("keep_id"), F.max_by("row", F.coalesce(ID, F.lit(_LOWEST))).alias("keep_row"),
                 F.count(F.lit(1)).alias("group_size")), "digest-groups")
        self.append(materialize(self.unknown(groups), "new-digests"))
        stored = self.rows().withColumnRenamed("keep_id", "stored_id").hint("merge")
        decided = materialize(
            groups.join(stored, "digest")
            .select("digest", F.col("stored_id").alias("keep_id"), "group_size",
                    F.when(F.col("stored_id").eqNullSafe(F.col("keep_id")), F.col("keep_row")).alias("keep_row")),
            "digest-decisions")
        return digests.join(decided, "digest").select(
            ID, "digest", "keep_id", "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"))


def session_buckets(spark: SparkSession) -> int:
    """As many buckets as the session shuffles to, so the index is read by as many tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exact_duplicates(documents: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Decisions for ``documents``; a new index in the scratch folder unless one is given."""
    spark = documents.sparkSession
    if index is None:
        index = DigestIndex(spark, scratch_path(spark, "digest-index"), session_buckets(spark))
    return index.add(documents)


def drop_exact_duplicates(documents: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns.

    Rows are chosen by (doc_id, digest); where such a row repeats, which the
    decisions show, one of the repeats stays.
    """
    decisions = exact_duplicates(documents, index)
    stays = materialize(
        decisions.groupBy(ID, "digest")
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("repeats"))
        .where("kept").select(F.col(ID).alias("__id"), F.col("digest").alias("__digest"), "repeats"), "stays")
    same = F.col(ID).cast("bigint").eqNullSafe(F.col("__id")) & (text_digest(F.col(TEXT)) == F.col("__digest"))
    once = documents.join(stays.where("repeats = 1"), same, "left_semi")
    several = stays.where("repeats > 1")
    if several.isEmpty():
        return once
    # null and empty texts are equal, so repeats are told by the digest
    repeated = documents.join(several, same, "left_semi").withColumn("__digest", text_digest(F.col(TEXT)))
    return once.unionByName(repeated.dropDuplicates([ID, "__digest"]).drop("__digest"))
