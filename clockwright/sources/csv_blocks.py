"""CSV with line breaks inside quotes, read block by block.

Quotes are escaped by doubling, so a line end is inside a field exactly if an odd
number of quotes stands before it in the file.  Each block counts its lines with
an odd number of quotes, whatever state it begins in; sums over the blocks
before it give that state, and the number of records of several lines before it.
With these every line knows whether it is a record, or which record it is a
piece of.  Only pieces are shuffled, and no task reads a whole file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clockwright.errors import ExtractionError

_LINE = "file string, block long, number long, text string, odd boolean, before long, first boolean"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with whether their quotes are odd, the odd lines up to them in their block, and whether a file begins."""
    at, odd_lines, begun = (None, None), 0, True
    for batch in batches:
        table = batch.to_pydict()
        quotes = pc.count_substring(batch.column(3), '"')
        odd = pc.equal(pc.bit_wise_and(quotes, 1), 1).to_pylist()
        before, first = [], []
        for file, block, text, is_odd in zip(table["file"], table["block"], table["text"], odd):
            if at != (file, block):
                at, odd_lines, begun = (file, block), 0, block > 0
            odd_lines += is_odd
            before.append(odd_lines)
            # blank lines in front of the header are no records
            starts = not begun and bool(text.strip("\r"))
            begun = begun or starts
            first.append(starts)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(odd, pa.bool_()), pa.array(before, pa.int64()), pa.array(first, pa.bool_())],
            ["file", "block", "number", "text", "odd", "before", "first"])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"), F.col("value").alias("text")).mapInArrow(_counted, _LINE)


def _block_states(lines: DataFrame) -> DataFrame:
    """(file, block, open, records): the state each block begins in, and the records of several lines begun before it."""
    counts = lines.groupBy("file", "block").agg(F.max("before").alias("odd_lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.floor((F.col("odd_lines") + 1 - F.col("open")) / 2)
    return (counts.withColumn("open", F.coalesce(F.sum("odd_lines").over(earlier), F.lit(0)) % 2)
            .withColumn("records", F.coalesce(F.sum(opened).over(earlier), F.lit(0))))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(text, first): every record of every file under ``path``, and whether it is its file's first; blank ones are left out."""
    lines = _lines(spark, path)
    states = _block_states(lines)
    unclosed = (states.groupBy("file").agg((F.sum("odd_lines") % 2).alias("odd")).where(F.col("odd") == 1)
                .select("file").first())
    if unclosed is not None:
        raise ExtractionError(f"{unclosed.file}: the file ends inside quotes")
    marked = lines.join(states.select("file", "block", "open", "records"), ["file", "block"])
    after = (F.col("open") + F.col("before")) % 2
    started = (F.col("open") + F.col("before") - F.col("odd").cast("int")) % 2
    # the carriage return of a line end is no part of a record; inside quotes it is
    text = F.when(after == 0, F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    marked = marked.select("file", "block", "number", text.alias("text"), "first", after.alias("after"), started.alias("started"),
                           (F.col("records") + F.floor((F.col("before") + 1 - F.col("open")) / 2)).alias("record"))
    whole = (F.col("after") == 0) & (F.col("started") == 0)
    pieces = F.array_sort(F.collect_list(F.struct("block", "number", "text")))
    joined = (marked.where(~whole).groupBy("file", "record")
              .agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"), F.max("first").alias("first")))
    return marked.where(whole).select("text", "first").unionByName(joined.select("text", "first")).where(F.col("text") != "")


def header(found: DataFrame, path: str) -> list[str]:
    """The column names, which all files have to share."""
    heads = [row.text for row in found.where("first").select("text").distinct().limit(2).collect()]
    if not heads:
        raise ExtractionError(f"raw input {path} has no columns")
    names = [next(csv.reader([head], strict=True)) for head in heads]
    if len(names) > 1 and names[0] != names[1]:
        raise ExtractionError(f"{path}: files differ in their header: {heads[0][:200]} and {heads[1][:200]}")
    return names[0]
