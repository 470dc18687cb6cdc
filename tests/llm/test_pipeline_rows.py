"""The pipeline over odd rows and empty tables: every stage takes what the one before left."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 99))
                    for _ in range(count))


@pytest.fixture
def folder(spark, docs_of, tmp_path):
    def store(texts, labels):
        docs_of(texts, {"words": F.lit("x"), "node": F.lit(1), "score": F.lit(2.0), "kept": F.lit(True)}).write.parquet(
            str(tmp_path / "documents.parquet"))
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)
    return store


def test_odd_rows(spark, folder):
    long = prose(99, 20_000)
    texts = [(i, prose(i, 40 + i)) for i in range(60)] + [(i, "you vile rotten scum " * 4 + prose(i, 9)) for i in range(60, 90)]
    texts += [(100, None), (101, ""), (None, None), (102, long), (103, long), (103, long), (None, prose(200, 50)),
              (104, prose(200, 50) + " end"), (105, "\U0001f600 漢字 naïve"), (7, prose(300, 30))]
    root = folder(texts, [(i, 1, int(i >= 60)) for i in range(90)] + [(None, None, None), (5, 1, 0)])
    docs, seen = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, root), f"test-{name}")
        seen.append((name, docs.columns, docs.count()))
    assert all(columns == seen[0][1] for _, columns, _ in seen[:-1]) and len(seen) == 5
    counts = [n for _, _, n in seen]
    assert counts == sorted(counts, reverse=True) and counts[0] < len(texts) and counts[-1] > 0
    known = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in texts}
    rows = docs.collect()
    assert {r.decoded_sha256 for r in rows} <= known and all(len(r.ids) == r.n_tokens for r in rows)
    toxic = {i for i, t in texts if t and t.startswith("you vile")}
    assert not toxic & {r.doc_id for r in rows}
    digests = [r.decoded_sha256 for r in rows]
    assert len(digests) == len(set(digests))


def test_empty_tables(spark, folder):
    root = folder([], [])
    assert corpus_pipeline.run(spark, root).count() == 0
