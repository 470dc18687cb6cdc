"""The review table on storage: a bucketed base, update segments beside it, and compaction.

One version of the table names a base and the segments that were appended since.
All are bucketed by punch_id alike, so reading merges bucket with bucket: nothing
is exchanged or sorted, and notes are touched only where they are read.  Appending
writes one segment, the last valid update per punch of its batch; when there are
``MAX_SEGMENTS`` the merged table becomes the new base.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clockwright.errors import LoadError, LookupFailed
from clockwright.functions.times import micros_since_epoch
from clockwright.plans import review
from clockwright.sources.versions import Draft, Manifest, location, newest

KEY = "punch_id"
BUCKETS = 32
MAX_SEGMENTS = 8
_UPDATE = ("review_status", "reviewer_notes")
#: when the last update of a record was made; a base keeps it, so that an older update that comes later changes nothing
_STAMP = ("updated_at", "seq")
_SEGMENT = (KEY, *_UPDATE, *_STAMP)


@dataclass(frozen=True)
class Appended:
    """What became of a batch: updates stored (one per punch), and updates that break a rule."""

    stored: int
    refused: int


class ReviewTable:
    """Records under review in a folder; every change is a new version."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = BUCKETS):
        self._spark, self._path, self._buckets = spark, path.rstrip("/"), buckets

    # --- files ---------------------------------------------------------------------

    def _write(self, df: DataFrame, folder: str) -> None:
        """Bucketed files, one per bucket: rows are dealt like buckets are numbered."""
        name = f"review_{uuid.uuid4().hex}"
        (df.repartition(self._buckets, KEY).write.format("parquet").bucketBy(self._buckets, KEY)
         .option("path", folder).saveAsTable(name))
        self._spark.sql(f"drop table {name}")       # of an external table only the name goes

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        """The files as a bucketed table; its name is needed only until it is resolved."""
        name = f"review_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self._spark.sql(f"create table {name} ({columns}) using parquet clustered by ({KEY}) into {self._buckets} buckets "
                        f"location '{folder}'")
        table = self._spark.table(name)
        self._spark.sql(f"drop table {name}")
        return table

    def _version(self) -> Manifest | None:
        return newest(self._spark, self._path)

    def _require(self) -> Manifest:
        version = self._version()
        if version is None:
            raise LookupFailed(f"{self._path} holds no review table")
        return version

    def _base(self, version: Manifest) -> DataFrame:
        return self._read(location(self._path, version), T.StructType.fromJson(version.schema))

    # --- reading -------------------------------------------------------------------

    def view(self) -> DataFrame:
        """Every record with its last update, as of the newest version."""
        return self._merged(self._require()).select(*review.REVIEW_COLUMNS)

    def _merged(self, version: Manifest) -> DataFrame:
        base = self._base(version)
        merged, found = base, []
        for n, part in enumerate(version.parts):
            updates = self._read(f"{self._path}/{part}", T.StructType([base.schema[c] for c in _SEGMENT]))
            # a segment has one row per punch; hashing its bucket spares both sides a sort
            merged = merged.join(
                updates.select(KEY, F.struct(*_STAMP, *_UPDATE).alias(f"__update_{n}")).hint("shuffle_hash"), KEY, "left")
            found.append(F.col(f"__update_{n}"))
        if not found:
            return base
        own = F.when(F.col("updated_at").isNotNull(), F.struct(*_STAMP, *_UPDATE))
        last = F.greatest(own, *found)

        def latest(name: str) -> Column:
            return F.when(last.isNotNull(), last[name]).otherwise(F.col(name)).alias(name)

        return merged.select(*[latest(c) if c in (*_UPDATE, *_STAMP) else F.col(c) for c in base.columns])

    # --- changing ------------------------------------------------------------------

    def seed(self, scores: DataFrame) -> int:
        """Add the scored punches that are not in the table yet, as pending; returns the rows of the table."""
        version = self._version()
        draft = Draft(self._spark, self._path)
        if version is None:
            return self._replace(draft, _unstamped(review.seed(scores)))
        existing = self._merged(version)
        fresh = review.seed(scores.join(existing.select(KEY), KEY, "left_anti"))
        return self._replace(draft, existing.unionByName(_unstamped(fresh)))

    def compact(self) -> int:
        """Make the merged table the base of a version without segments."""
        draft = Draft(self._spark, self._path)
        return self._replace(draft, self._merged(self._require()))

    def _replace(self, draft: Draft, rows: DataFrame) -> int:
        try:
            self._write(rows, draft.data)
            count = self._read(draft.data, rows.schema).count()
            draft.commit(count, json.loads(rows.schema.json()))
        except Exception:
            draft.abandon()
            raise
        return count

    def append(self, updates: DataFrame) -> Appended:
        """Store a batch of updates (punch_id, review_status, reviewer_notes, updated_at, seq).

        Updates that break a rule are counted and left out.  An update of a punch
        that is not in the table refuses the whole batch, and so do two updates of
        one punch with the same time and number, of which none is the last.
        """
        version = self._require()
        draft = Draft(self._spark, self._path)
        rows = updates.select(F.col(KEY), *[F.col(c) for c in _UPDATE], F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
                              F.col("seq").cast("bigint").alias("seq"))
        valid = rows.where(review.update_problem().isNull())
        # time and number as one whole number: an aggregate of fixed width, which is hashed and not sorted
        order = (micros_since_epoch(F.col("updated_at")).cast("decimal(18,0)") * F.lit(str(10 ** 19)).cast("decimal(20,0)")
                 + F.col("seq").cast("decimal(19,0)")).cast("decimal(38,0)")
        keyed = valid.withColumn("__order", order)
        last = keyed.groupBy(KEY).agg(F.max("__order").alias("__last"))
        unknown = last.join(self._base(version).select(KEY), KEY, "left_anti")
        facts = unknown.agg(F.count(F.lit(1)).alias("unknown"), F.min(KEY).alias("example")).first()
        if facts["unknown"]:
            raise LookupFailed(f"{facts['unknown']} punches are not under review, such as {facts['example']}")
        chosen = (keyed.join(last.withColumnRenamed(KEY, "__key"), (F.col(KEY) == F.col("__key")) & (F.col("__order") == F.col("__last")))
                  .select(*_SEGMENT))
        try:
            self._write(chosen, draft.data)
            stored = self._read(draft.data, chosen.schema)
            counts = stored.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(KEY).alias("keys")).first()
            if counts["rows"] != counts["keys"]:
                raise LoadError("two updates of one punch have the same time and number")
            draft.commit(version.rows, version.schema, data=version.data, parts=[*version.parts, draft.name],
                         after=version.version)
        except Exception:
            draft.abandon()
            raise
        if len(version.parts) + 1 >= MAX_SEGMENTS:
            self.compact()
        refused = rows.where(review.update_problem().isNotNull()).count()
        return Appended(counts["rows"], refused)


def _unstamped(records: DataFrame) -> DataFrame:
    """Records that no update has reached."""
    return records.withColumns({"updated_at": F.lit(None).cast("timestamp_ntz"), "seq": F.lit(None).cast("bigint")})
