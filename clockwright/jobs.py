"""Jobs to submit: ``spark-submit clockwright/jobs.py etl|train|evaluate ...``.

Each reads and writes stored tables only, so they can run one after another or
apart.  Paths may be on any storage that Spark reaches.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clockwright import settings  # noqa: E402
from clockwright.functions.parsing import TIMESTAMP_PATTERN  # noqa: E402
from clockwright.operators.forest import ForestConfig  # noqa: E402
from clockwright.plans import evaluation, scoring  # noqa: E402
from clockwright.plans.etl import run_etl  # noqa: E402
from clockwright.sources.raw import RawPaths  # noqa: E402
from clockwright.sources.tables import read_table, table_path, write_metrics  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="jobs.py", description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    etl = jobs.add_parser("etl", help="raw CSV files to checked and typed tables")
    for field in fields(RawPaths):
        etl.add_argument(f"--{field.name}", default=field.default, help="raw CSV file or folder")
    etl.add_argument("--multiline", action="store_true", help="fields may hold line breaks inside quotes")
    etl.add_argument("--pattern", default=TIMESTAMP_PATTERN, help="form of the times")
    etl.add_argument("--first-by", nargs="+", default=["punch_id"], help="columns that say which copy of a punch came first")
    train = jobs.add_parser("train", help="fit a forest on the stored punches, and store it with the scores")
    train.add_argument("--model", required=True, help="folder of the model")
    train.add_argument("--contamination", type=float, default=settings.CONTAMINATION)
    train.add_argument("--trees", type=int, default=settings.TREES)
    train.add_argument("--seed", type=int, default=settings.SEED)
    evaluate = jobs.add_parser("evaluate", help="scores against labels, as a JSON document")
    evaluate.add_argument("--metrics", required=True, help="folder of the document")
    for job in (etl, train, evaluate):
        job.add_argument("--tables", default="data/processed", help="folder of the processed tables")
    return parser


def _etl(spark: SparkSession, options: argparse.Namespace) -> dict:
    paths = RawPaths(**{f.name: getattr(options, f.name) for f in fields(RawPaths)})
    written = run_etl(spark, paths, options.tables, multiline=options.multiline, order=tuple(options.first_by),
                      pattern=options.pattern)
    return {name: rows for name, (_, rows) in written.items()}


def _train(spark: SparkSession, options: argparse.Namespace) -> dict:
    config = ForestConfig(trees=options.trees, contamination=options.contamination, seed=options.seed)
    model = scoring.train_model(read_table(spark, table_path(options.tables, "punches")), config)
    path = table_path(options.tables, "anomaly_scores")
    rows = scoring.save_artifacts(model, options.model, path)
    return {"scored": rows, "flagged": read_table(spark, path).where("predicted_anomaly").count()}


def _evaluate(spark: SparkSession, options: argparse.Namespace) -> dict:
    scores, labels, punches = (read_table(spark, table_path(options.tables, name))
                               for name in ("anomaly_scores", "labels", "punches"))
    return write_metrics(evaluation.evaluate(scores, labels, punches), options.metrics)


def main(arguments: list[str], spark: SparkSession | None = None) -> dict:
    """Run one job and return what it prints."""
    options = _parser().parse_args(arguments)
    session = spark or SparkSession.builder.appName(f"clockwright-{options.job}").getOrCreate()
    result = {"etl": _etl, "train": _train, "evaluate": _evaluate}[options.job](session, options)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
