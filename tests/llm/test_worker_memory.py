"""What Python workers hold while the pipeline runs: few texts at a time, few arrays of n-grams, one worker per task."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from clockwright.llm import bpe, ngram_join
from clockwright.scratch import TEXTS_PER_BATCH, materialize, text_batches

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def held(function, *arguments):
    tracemalloc.start()
    try:
        found = function(*arguments)
        return found, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def fragment_of(sets):
    """A fragment's segments as they are sent, one row each; nodes are the numbers of the sets."""
    return pa.table({
        "fragment": pa.array([7] * len(sets), pa.int32()),
        "nodes": pa.array([int(i).to_bytes(16, "big") for i, _ in sets], pa.binary()),
        "sizes": pa.array([np.array([len(s)], "<u4").tobytes() for _, s in sets], pa.binary()),
        "grams": pa.array([ngram_join._pack(np.array(s, np.uint64)) for _, s in sets], pa.binary()),
    })


def test_a_fragment_takes_few_bytes_an_ngram():
    sets = [(i, np.arange(i * 4_000, i * 4_000 + 4_100)) for i in range(100)]
    table = fragment_of(sets)
    found, most = held(ngram_join._shared_of_fragment, table)
    assert sum(map(len, found.column("grams").to_pylist())) == 2 * 99 * 100
    assert most < 35 * 410_000


@pytest.mark.parametrize("seed", range(5))
def test_shared_ngrams_of_a_fragment(seed):
    drawn = np.random.default_rng(seed)
    sets = [(i, sorted(set(drawn.integers(0, 60, drawn.integers(1, 30)).tolist()))) for i in range(12)]
    sets += [sets[0], (50, [1 << 47])]      # a class that comes twice counts once; one that shares nothing
    own = dict(sets)
    classes = {g: sum(g in s for s in own.values()) for s in own.values() for g in s}
    expected = {i.to_bytes(16, "big"): [(g, classes[g]) for g in s if classes[g] > 1] for i, s in own.items()}
    found = ngram_join._shared_of_fragment(fragment_of(sets)).to_pylist()
    assert {r["node"]: list(zip(r["grams"], r["spread"])) for r in found} == {n: s for n, s in expected.items() if s}
    assert all(r["fragment"] == 7 for r in found) and len(found) == len({r["node"] for r in found})


def test_a_fragment_without_shared_ngrams():
    assert ngram_join._shared_of_fragment(fragment_of([(1, [5]), (2, [6]), (1, [5])])).num_rows == 0


def test_python_gets_few_texts_at_a_time(spark, docs_of, monkeypatch):
    seen, before = {}, spark.conf.get(ROWS)

    def recorded(df, label, *more):
        seen.setdefault(label, int(spark.conf.get(ROWS)))
        return stored[len(more)](df, label, *more)

    stored = {0: ngram_join.materialize, 1: ngram_join.materialize_in_buckets}
    for module, name in ((ngram_join, "materialize"), (ngram_join, "materialize_in_buckets"), (bpe, "materialize_in_buckets")):
        monkeypatch.setattr(module, name, recorded)
    docs = docs_of([" ".join(f"w{i}" for i in range(n, n + 30)) for n in (1, 2, 3)])
    ngram_join.drop_near_duplicates(docs)
    bpe.encode(docs, bpe.Vocabulary.load(spark, public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN))
    assert [seen[x] for x in ("classes", "shared", "blocks")] == [TEXTS_PER_BATCH] * 3
    assert seen["sets"] == int(before) and spark.conf.get(ROWS) == before


def test_batches_of_a_session_are_bounded_and_restored(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])

    def longest():
        return max(r.rows for r in materialize(spark.range(0, 4_000, 1, 1).mapInArrow(sizes, "rows long"), "sizes").collect())

    before = spark.conf.get(ROWS)
    with pytest.raises(ZeroDivisionError), text_batches(spark):
        assert longest() == TEXTS_PER_BATCH
        with text_batches(spark, 10 ** 6):
            assert longest() == TEXTS_PER_BATCH
        1 / 0
    assert spark.conf.get(ROWS) == before and longest() == 4_000


def test_the_last_stage_keeps_one_worker_per_task(spark, docs_of):
    texts = [(1, "some words, some words"), (2, None), (3, ""), (None, "\U0001f600 naïve 漢字"), (5, "x" * 300), (5, "again")]
    tokens = corpus_pipeline.tokenize(spark, docs_of(texts), "")
    plan = tokens._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN)
    apart = bpe.encode(docs_of(texts), vocabulary)
    apart = apart.select("doc_id", "ids", bpe.digests(vocabulary, apart["ids"]).alias("d")).select("doc_id", "ids", "d.*")
    together = bpe.encode(docs_of(texts), vocabulary, digest=True)
    assert together.columns == apart.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
