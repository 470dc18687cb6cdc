"""Intermediate tables in the folder that all executors share.

A written table cuts lineage, survives the loss of executors, is computed once
(``DataFrame.checkpoint`` computes its input twice) and, being Parquet, gives
later reads column pruning, pushdown and a real size for join planning.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: texts that Python gets at a time; an executor holds a batch several times over, in the JVM and in each worker
TEXTS_PER_BATCH = 500


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only for local runs."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    # a session that does not tell its master, and one of several local executors, count as clusters
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="clockwright-")
    spark.conf.set(_SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/clockwright/{label}-{uuid.uuid4().hex}"


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXTS_PER_BATCH) -> Iterator[None]:
    """What is run inside hands Python at most so many rows at a time; a smaller setting of the session stays."""
    before = spark.conf.get(_BATCH)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(_BATCH, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to scratch and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_in_buckets(df: DataFrame, label: str, key: str) -> DataFrame:
    """The same, dealt by ``key`` to as many buckets as the session shuffles to: merge joins by it do not exchange the table."""
    spark = df.sparkSession
    name = f"{re.sub('[^a-z0-9]', '_', label.lower())}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").bucketBy(buckets, key).option("path", scratch_path(spark, label)).saveAsTable(name))
    return spark.table(name)
