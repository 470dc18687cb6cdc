"""Raw files to processed tables in one run."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from clockwright.functions.parsing import TIMESTAMP_PATTERN
from clockwright.plans import transform
from clockwright.scratch import materialize
from clockwright.sources.raw import RawPaths, extract_all
from clockwright.sources.tables import Output, load_all, read_table, table_path, write_routed

LOGGER = logging.getLogger(__name__)

# order of rows inside each stored table; also what its files are ranged by
STORED_ORDER = {
    "departments": ("department_id",),
    "employees": ("employee_id",),
    "shifts": ("employee_id", "scheduled_start"),
    "punches": ("employee_id", "clock_in", "punch_id"),
    "quarantine": ("punch_id",),
    "labels": ("anomaly_id",),
}


# keys that are looked up one by one
LOOK_UPS = {"punches": ("punch_id", "shift_id"), "quarantine": ("punch_id",), "labels": ("punch_id",)}


def run_etl(spark: SparkSession, raw_paths: RawPaths = RawPaths(),
            output_dir: str = "data/processed", *, multiline: bool = False,
            order: tuple[str, ...] = ("punch_id",), pattern: str = TIMESTAMP_PATTERN) -> dict[str, tuple[str, int]]:
    """Extract, transform and load; returns path and row count per table.

    ``multiline`` is for raw files with line breaks inside quotes, ``pattern``
    the form of their times, ``order`` says which copy of a punch came first.

    Every check is made before a table is written.  Checks, joins and sinks read
    the smaller tables several times, so their text is parsed once and staged as
    typed columns.  The punches are read once and classified once; the classification
    is stored, and one pass over it writes clean punches and quarantine, whose
    measures are made where they are written.  Labels
    are matched with the punches as stored.
    """
    LOGGER.info("reading raw tables")
    # employees and shifts are staged when they have their types
    raw = {name: df if name in ("punches", "employees", "shifts") else materialize(df, f"raw-{name}")
           for name, df in extract_all(spark, raw_paths, multiline=multiline).items()}
    transform.require_labels(raw["labels"])
    departments = transform.transform_departments(raw["departments"])
    employees = transform.transform_employees(raw["employees"], departments)
    shifts = transform.transform_shifts(raw["shifts"], employees, pattern=pattern)
    classified = materialize(
        transform.classified_punches(raw["punches"], shifts, employees, order=order, pattern=pattern), "classified")
    written = load_all({"departments": departments, "employees": employees, "shifts": shifts}, output_dir, STORED_ORDER)
    routed = transform.with_outcome(classified)
    outputs = {name: Output(table_path(output_dir, name), columns, STORED_ORDER[name])
               for name, columns in transform.punch_columns(transform.punch_measures(routed), raw["punches"].columns).items()}
    counts = write_routed(routed, transform.OUTCOME, outputs, output_dir, LOOK_UPS["punches"],
                          derive=transform.punch_measures)
    written |= {name: (output.path, counts[name]) for name, output in outputs.items()}
    labels = transform.label_columns(raw["labels"], read_table(spark, outputs[transform.CLEAN].path))
    written |= load_all({"labels": labels}, output_dir, STORED_ORDER, LOOK_UPS)
    LOGGER.info("wrote %s", {name: rows for name, (_, rows) in written.items()})
    return written
