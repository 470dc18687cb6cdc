"""Processed tables on shared storage: versioned writes and reads, counts."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from clockwright.errors import ExtractionError, LoadError
from clockwright.sources.versions import Draft, Storage, location, newest

_ROWS = "rows"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table, to which the result stays pinned; plain Parquet files are read as they are."""
    try:
        manifest = newest(spark, path)
        if manifest is None:
            return spark.read.parquet(path)
        # no file is opened to learn the columns, and a version without files has some, too
        reader = spark.read if manifest.schema is None else spark.read.schema(T.StructType.fromJson(manifest.schema))
        return reader.parquet(location(path, manifest))
    except AnalysisException as exc:
        raise ExtractionError(f"table {path} does not exist or is not Parquet") from exc


def files_of(spark: SparkSession, path: str) -> str:
    """Where the files of a table's newest version are; the path itself if it holds no versions."""
    manifest = newest(spark, path)
    return path if manifest is None else location(path, manifest)


def _sorted(rows: DataFrame, order: list[Column]) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows


def write_table(df: DataFrame, path: str, *, sort_by: tuple[str, ...] = (), look_up: tuple[str, ...] = ()) -> int:
    """Write a new version of a table, which replaces the one before in one step.

    The suffix picks the format (``.parquet`` or ``.csv``).  Readers see the old
    version until the new one is complete, and never a mixture; of two writers
    at once, the second to finish fails.  ``sort_by`` spreads the rows by range
    of those columns and sorts inside each file, so a hot first column is split
    and readers can skip row groups; ``look_up`` columns get Bloom filters, so
    look-ups by a key that files are not ranged by skip row groups, too.
    Returns the row count, which is observed during the write rather than
    counted by a second job.
    """
    path = path.rstrip("/")
    if not path.endswith((".parquet", ".csv")):
        raise LoadError(f"unsupported output format: {path}")
    draft, counted = Draft(df.sparkSession, path), Observation()
    rows = _sorted(df, [F.col(c).asc_nulls_last() for c in sort_by]).observe(counted, F.count(F.lit(1)).alias(_ROWS))
    try:
        if path.endswith(".csv"):
            # fields keep the blanks at their ends
            (rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False).csv(draft.data))
        else:
            _with_filters(rows.write, look_up).parquet(draft.data)
        # the planner drops the counter together with an input it knows to be empty
        found = counted.get.get(_ROWS, 0)
        draft.commit(found, json.loads(df.schema.json()))
    except LoadError:
        draft.abandon()
        raise
    except Exception as exc:
        draft.abandon()
        raise LoadError(f"could not write {path}: {exc}") from exc
    return found


def _with_filters(writer, look_up: tuple[str, ...]):
    for column in look_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


@dataclass(frozen=True)
class Output:
    """One table of a routed write: its folder, its columns, and the order of its rows."""

    path: str
    columns: tuple[str, ...]
    sort_by: tuple[str, ...] = ()


def write_routed(df: DataFrame, route: str, outputs: dict[str, Output], root: str, look_up: tuple[str, ...] = (), *,
                 derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, int]:
    """Write several tables in one pass: each row goes to the output that column ``route`` names.

    The rows are written once, partitioned by ``route``, under ``root``; each
    output's new version is its partition, with its own columns.  Ranges and
    order follow the columns of the output a row goes to.  All data is complete
    before the first version is registered.  A row that names no output is an
    error.  ``derive`` adds columns to rows as they are written, so that neither
    the search for ranges makes them nor the shuffle carries them; no order can
    name them.  Returns the rows per output.
    """
    drafts = {name: Draft(df.sparkSession, output.path) for name, output in outputs.items()}
    data = f"{root.rstrip('/')}/routed-{uuid.uuid4().hex}"
    order = [F.col(route)]
    for name, output in outputs.items():
        # columns of the other outputs are NULL here and order nothing
        order += [F.when(F.col(route) == name, F.col(c)).asc_nulls_last() for c in output.sort_by]
    counted = Observation()
    known = F.col(route).isin(*outputs)
    checked = df.where(F.when(F.coalesce(known, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"{route} names no output")).cast("boolean")))
    rows = derive(_sorted(checked, order)).observe(
        counted, *[F.count_if(F.col(route) == name).alias(name) for name in outputs])
    try:
        _with_filters(rows.write.partitionBy(route), look_up).parquet(data)
        found = {name: counted.get.get(name, 0) for name in outputs}
        whole = derive(df)
        for name, output in outputs.items():
            schema = json.loads(whole.select(*[f"`{c}`" for c in output.columns]).schema.json())
            # an output without rows has no partition folder, but has to have a folder to read
            part = f"{data}/{route}={name}" if found[name] else drafts[name].data
            if not found[name]:
                df.sparkSession.createDataFrame([], T.StructType.fromJson(schema)).write.parquet(part)
            drafts[name].commit(found[name], schema, data=os.path.relpath(part, output.path.rstrip("/")))
    except LoadError:
        raise
    except Exception as exc:
        Storage(df.sparkSession, data).drop(data)
        raise LoadError(f"could not write {', '.join(outputs)}: {exc}") from exc
    return found


def table_path(output_dir: str, name: str) -> str:
    return f"{output_dir.rstrip('/')}/{name}.parquet"


def load_all(tables: dict[str, DataFrame], output_dir: str, sort_by: dict[str, tuple[str, ...]] | None = None,
             look_up: dict[str, tuple[str, ...]] | None = None) -> dict[str, tuple[str, int]]:
    """Write every table; each is replaced on its own.  Returns path and row count."""
    written = {}
    for name, df in tables.items():
        path = table_path(output_dir, name)
        rows = write_table(df, path, sort_by=(sort_by or {}).get(name, ()), look_up=(look_up or {}).get(name, ()))
        written[name] = (path, rows)
    return written


def write_raw_csv(tables: dict[str, DataFrame], paths: dict[str, str]) -> None:
    for name, df in tables.items():
        write_table(df, paths[name])


def write_metrics(metrics: DataFrame, path: str) -> dict:
    """Store a one-row metrics table as JSON and return it as a document."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return json.loads(metrics.toJSON().first())


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
