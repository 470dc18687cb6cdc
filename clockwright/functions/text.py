"""Records as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clockwright import settings
from clockwright.functions.times import iso_text


def _plain(df: DataFrame, name: str) -> Column:
    """Value of one field as text, ISO for timestamps."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return iso_text(F.col(name))
    return F.col(name).cast("string")


def json_record(df: DataFrame) -> Column:
    """The whole row as JSON: ISO timestamps, NULL and NaN as null."""
    def value(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.TimestampNTZType, T.DateType)):
            return _plain(df, f.name).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        return F.col(f.name)
    return F.to_json(F.struct(*[value(f) for f in df.schema.fields]), {"ignoreNullFields": "false"})


def triage_text(df: DataFrame) -> Column:
    """Heading plus one ``field: value`` line per context field."""
    def line(name: str) -> Column:
        shown = _plain(df, name) if name in df.columns else F.lit(None).cast("string")
        return F.concat(F.lit(f"{name}: "), F.coalesce(shown, F.lit("None")))
    return F.concat_ws("\n", F.lit(settings.CONTEXT_HEADING), *map(line, settings.CONTEXT_FIELDS))
