"""Raw CSV inputs: every column a string, NA tokens as NULL."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clockwright.errors import ExtractionError
from clockwright.functions.parsing import null_na_tokens
from clockwright.sources import csv_blocks
from clockwright.sources.tables import files_of


# --- fixed values: where the raw files are unless told otherwise ---
@dataclass(frozen=True)
class RawPaths:
    departments: str = "data/raw/departments.csv"
    employees: str = "data/raw/employees.csv"
    shifts: str = "data/raw/shifts.csv"
    punches: str = "data/raw/anomalous_time_punches.csv"
    labels: str = "data/raw/anomaly_labels.csv"


_WHOLE_ROW = "__row_text"
_EXTRA = "__extra_field"
_QUOTES = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """One CSV with a header row, in one file or several of the same columns.

    Quotes are escaped by doubling.  Missing fields at the end of a row are
    NULL; a row with more fields than the header is an error when it is read,
    and so is a file whose header differs.  ``multiline`` allows line breaks
    inside quotes, at the cost of one scan of the text that counts quotes; a
    quote then has to stand around or inside a quoted field.  Without it a line
    that ends inside quotes is refused at once.  Files are split either way.
    """
    try:
        path = files_of(spark, path)
        names, table = (_records_table if multiline else _lines_table)(spark, path)
    except AnalysisException as exc:
        raise ExtractionError(f"cannot read raw input {path}: {exc.getMessage()}") from exc
    return null_na_tokens(_refuse_wide_rows(table, names, path).select(*[f"`{n}`" for n in names]))


def _lines_table(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    names = reader.option("inferSchema", False).csv(path).columns
    if not names:
        raise ExtractionError(f"raw input {path} has no columns")
    # rows of another width keep their text; pruned columns would hide the width
    table = (
        reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in [*names, _WHOLE_ROW]]))
        .option("columnNameOfCorruptRecord", _WHOLE_ROW)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    _refuse_open_quotes(spark, path)
    return names, table


def _records_table(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    found = csv_blocks.records(spark, path)
    names = csv_blocks.header(found, path)
    fields_of = F.from_csv(F.col("text"), ", ".join(f"`{n}` string" for n in names), _QUOTES)
    rows = found.where(~F.col("first")).select(F.col("text").alias(_WHOLE_ROW), fields_of.alias("__fields"))
    return names, rows.select("__fields.*", _WHOLE_ROW)


def _refuse_open_quotes(spark: SparkSession, path: str) -> None:
    """Doubled quotes come in pairs, so a line of an odd number of quotes ends inside a field."""
    line = F.col("value")
    broken = spark.read.text(path).where(
        (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1).first()
    if broken is not None:
        raise ExtractionError(f"{path}: a line ends inside quotes; read it with multiline=True: {broken.value[:200]}")


def _refuse_wide_rows(table: DataFrame, names: list[str], path: str) -> DataFrame:
    text = F.col(_WHOLE_ROW)
    wider = ", ".join(f"`{n}` string" for n in [*names, _EXTRA])
    again = F.from_csv(text, wider, _QUOTES)
    # naming a value of the row also keeps a plain count from reading the kept text alone
    start = F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))
    error = F.raise_error(F.concat(F.lit(f"{path}: the row that starts with '"), start,
                                   F.lit("' has more fields than the header: "), text))
    too_wide = text.isNotNull() & again[_EXTRA].isNotNull()
    return table.where(F.when(too_wide, error.cast("boolean")).otherwise(F.lit(True)))


def extract_all(spark: SparkSession, paths: RawPaths = RawPaths(), *,
                multiline: bool = False) -> dict[str, DataFrame]:
    return {f.name: read_csv(spark, getattr(paths, f.name), multiline=multiline)
            for f in fields(paths)}
