"""The submitted jobs, one after another over raw files."""

import math

import pytest

from clockwright import jobs
from clockwright.registry.workforce import Workforce
from clockwright.sources import tables


def test_jobs_follow_each_other(spark, sf_dir, tmp_path):
    raw = Workforce(spark, sf_dir).raw.as_dict()
    paths = {name: str(tmp_path / "raw" / f"{name}.csv") for name in raw}
    tables.write_raw_csv(raw, paths)
    stored = str(tmp_path / "processed")
    counts = jobs.main(["etl", "--tables", stored, *[x for n, p in paths.items() for x in (f"--{n}", p)]], spark)
    assert counts["punches"] + counts["quarantine"] == raw["punches"].count()
    trained = jobs.main(["train", "--tables", stored, "--model", str(tmp_path / "model"), "--trees", "20"], spark)
    assert trained["scored"] == counts["punches"] and 0 < trained["flagged"] <= math.ceil(0.03 * trained["scored"])
    found = jobs.main(["evaluate", "--tables", stored, "--metrics", str(tmp_path / "metrics")], spark)
    assert found["true_positives"] + found["false_positives"] == trained["flagged"]
    assert sum(found[c] for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")) == trained["scored"]
    with pytest.raises(SystemExit):
        jobs.main(["nonsense"], spark)
