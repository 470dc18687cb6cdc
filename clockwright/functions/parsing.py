"""Text to typed values.  Raw tables hold nothing but strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# --- fixed values: texts that mean "no value"; matched exactly ---------------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- fixed values: accepted formats -------------------------------------------------
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
INFINITY_PATTERN = r"^\s*[+-]?(?i:inf|infinity)\s*\z"


def null_na_tokens(df: DataFrame) -> DataFrame:
    """Replace the NA tokens by NULL in every string column, in one projection."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*NA_TOKENS), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def parse_timestamp(text: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Zone-free timestamp, NULL where the text does not follow ``pattern``.

    The pattern comes first: a bare cast also accepts years, zones and padding.
    The value never passes through a zoned type, so the session zone is irrelevant.
    """
    return F.when(text.rlike(pattern), text.try_cast("timestamp_ntz"))


def parse_date(text: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.when(text.rlike(pattern), text.try_cast("date"))


def parse_number(text: Column) -> Column:
    """Double, NULL for anything that is not a plain number or an infinity.

    The pattern keeps out type suffixes such as ``5d``, which a cast accepts.
    """
    infinite = F.when(F.trim(text).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
        .when(text.rlike(INFINITY_PATTERN), infinite)
    )


def not_positive(number: Column) -> Column:
    """True for NULL, NaN, zero and negatives."""
    return number.isNull() | F.isnan(number) | (number <= 0)


def parse_flag(text: Column) -> Column:
    """``true``/``false`` in any case; NULL otherwise."""
    folded = F.lower(text)
    return F.when(folded == "true", F.lit(True)).when(folded == "false", F.lit(False))
