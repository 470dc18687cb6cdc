"""Data-quality rules as countable violations.

A report has one row per rule: ``table_name, rule, violations``.  One scan
serves all rules on a table's rows and key, one more each table it refers to;
both count by key before they shuffle, so a hot key costs one row per map task.
``enforce`` turns a report into an error; nothing but the report and the first
few keys reaches the driver, the others are in a stored table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clockwright.errors import LookupFailed, TransformationError
from clockwright.schemas import REQUIRED_COLUMNS
from clockwright.scratch import scratch_path

#: keys that an error shows; all of them are in the table that it names
_SHOWN = 20


def require_columns(df: DataFrame, table: str, required: tuple[str, ...] | None = None) -> None:
    present = set(df.columns)
    absent = [c for c in (REQUIRED_COLUMNS[table] if required is None else required) if c not in present]
    if absent:
        raise TransformationError(f"{table} lacks the columns {absent}")


def _as_report(counts: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """A one-row aggregate as one row per rule; rules that found nothing to count are met."""
    entries = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.coalesce(value, F.lit(0)).cast("bigint").alias("violations"))
        for rule, value in rules.items()
    ])
    return counts.select(F.lit(table).alias("table_name"), F.inline(entries))


def table_report(df: DataFrame, table: str, rules: dict[str, Column] | None = None, *, key: str | None = None,
                 expected_rows: int | None = None, allow_empty: bool = True) -> DataFrame:
    """Rules on rows, key and row count of one table, in one scan.

    A rule is a condition that bad rows meet; its violations are rows.  Key
    violations are keys that are NULL or repeated.  With a key, rows are counted
    per key before the exchange the key check needs anyway.
    """
    bad = list((rules or {}).items())
    found = [F.count_if(condition).alias(f"bad_{n}") for n, (_, condition) in enumerate(bad)]
    rows = F.count(F.lit(1)).alias("rows")
    if key is None:
        counts = df.agg(rows, *found)
    else:
        counts = df.groupBy(key).agg(rows, *found).agg(
            F.count_if(F.col(key).isNull() | (F.col("rows") > 1)).alias("bad_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            *[F.sum(f"bad_{n}").alias(f"bad_{n}") for n in range(len(bad))],
        )
    report = {rule: F.col(f"bad_{n}") for n, (rule, _) in enumerate(bad)}
    if key is not None:
        report[f"{key} must be non-null and unique"] = F.col("bad_keys")
    if not allow_empty:
        report["table must not be empty"] = F.when(F.col("rows") == 0, 1).otherwise(0)
    if expected_rows is not None:
        report["row count must be as expected"] = F.abs(F.col("rows") - F.lit(expected_rows))
    return _as_report(counts, table, report)


def reference_report(child: DataFrame, table: str, key: str, parent: DataFrame, parent_table: str,
                     agree: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose key has no parent (NULL included), and rows that differ from their parent.

    Equal combinations are counted before the join, so a hot key is one row of
    it.  The parent's key is unique, as its own report shows.
    """
    combos = child.groupBy(key, *agree).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(key, *[F.col(a).alias(f"expected_{a}") for a in agree], F.lit(True).alias("known"))
    rows, matched = F.col("rows"), F.col("known").isNotNull()
    differs = {a: matched & ~F.col(a).eqNullSafe(F.col(f"expected_{a}")) for a in agree}
    counts = combos.join(known, key, "left").agg(
        F.sum(F.when(~matched, rows)).alias("unknown"),
        *[F.sum(F.when(condition, rows)).alias(f"differs_{a}") for a, condition in differs.items()],
    )
    return _as_report(counts, table, {
        f"{key} must exist in {parent_table}": F.col("unknown"),
        **{f"{a} must agree with {parent_table}": F.col(f"differs_{a}") for a in agree},
    })


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row counts."""
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows")).where(some_null | (F.col("key_rows") > 1))


def unknown_references(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Child keys (NULL included) without a parent, with their row counts."""
    return (
        child.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
        .join(parent.select(key), key, "left_anti")
    )


def not_in(column: str, allowed: tuple[str, ...]) -> Column:
    """True for values outside the domain, NULL included."""
    return ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))


def outside_domain(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values outside the domain with their row counts."""
    return df.where(not_in(column, allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("value_rows"))


def disagreements(child: DataFrame, key: str, attributes: tuple[str, ...], parent: DataFrame) -> DataFrame:
    """Combinations of ``key`` and attributes that differ from the parent's ``expected_*`` ones."""
    combos = child.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("key_rows"))
    expected = parent.select(key, *[F.col(a).alias(f"expected_{a}") for a in attributes])
    differs = reduce(lambda a, b: a | b,
                     [~F.col(a).eqNullSafe(F.col(f"expected_{a}")) for a in attributes])
    return combos.join(expected, key).where(differs)


def uncovered(parent: DataFrame, key: str, child: DataFrame) -> DataFrame:
    """Parent keys that no child row refers to."""
    return parent.select(key).join(child.select(key).distinct(), key, "left_anti")


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


def enforce(report: DataFrame, samples: dict[str, DataFrame] | None = None) -> None:
    """Raise if any rule of the report is broken; name the rules and their counts.

    Keys that break a rule are stored; the error tells how many there are, where
    they all are, and the first of them.
    """
    broken = report.where("violations > 0").collect()
    if not broken:
        return
    lines = [f"{r.table_name}: {r.rule} ({r.violations})" for r in broken]
    for rule, offenders in (samples or {}).items():
        if any(r.rule == rule for r in broken):
            column, path = offenders.columns[0], scratch_path(report.sparkSession, "offenders")
            offenders.write.parquet(path)
            kept = report.sparkSession.read.schema(offenders.schema).parquet(path)
            shown = [r[0] for r in kept.orderBy(F.col(column).asc_nulls_last()).limit(_SHOWN).collect()]
            lines.append(f"{rule}: {kept.count()} different keys, all in {path}, the first {shown}")
    raise TransformationError("; ".join(lines))


def require_unique(df: DataFrame, table: str, key: str) -> None:
    """One-to-one joins call this before they join."""
    enforce(table_report(df, table, key=key))


def require_single_rows(tables: dict[str, DataFrame], key: str) -> None:
    """Raise if a value of ``key`` occurs more than once in one of the named tables.

    Keys are counted, combined map-side; one offender at most reaches the driver.
    """
    repeated = [
        df.groupBy(key).count().where("count > 1").select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key_value"))
        for name, df in tables.items()]
    offender = reduce(DataFrame.unionByName, repeated).first()
    if offender is not None:
        raise LookupFailed(f"{offender.table_name}: {key} {offender.key_value} is not the only row of its key")
