"""What a task holds and what is shuffled, as tables grow."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clockwright.llm import bpe, line_dedup, ngram_join
from clockwright.scratch import materialize


def test_a_block_takes_few_bytes_a_word():
    words = 2_000_000
    text = "".join(f" w{i % 5_000}" for i in range(20_000))
    pieces = bpe.splitter(public_tokenizers.PATTERN)(text)
    texts = words // len(pieces)
    batch = pa.RecordBatch.from_arrays([pa.array(range(texts), pa.int64()), pa.array([text] * texts)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        blocks = list(bpe._blocks(public_tokenizers.PATTERN, 10 ** 9)(iter([batch])))
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(blocks) == 1
    assert held < 20 * texts * len(pieces)


@pytest.mark.parametrize("count", [0, 1, 700_000])
def test_packed_ranks_come_back(count):
    drawn = np.random.default_rng(count)
    ranks = drawn.choice([0, 159, 160, 161, 20_639, 20_640, 1_003_679, 1_003_680, 2 ** 31], count).astype(np.uint32)
    assert np.array_equal(bpe._unpack_ranks(*bpe._pack_ranks(ranks)), ranks)


def near_copies(docs_of):
    """Groups of texts that differ in one word, and others that are alone."""
    def words(group, changed=None):
        return " ".join(f"g{group}w{i}" if i != changed else "other" for i in range(60))
    return docs_of([words(g, c) for g in range(20) for c in (None, 3, 58)] + [words(100 + g) for g in range(20)])


@pytest.fixture(scope="module")
def prepared(docs_of):
    docs = near_copies(docs_of)
    return ngram_join._prepared(docs, materialize(ngram_join.classes(docs), "classes"))


def test_sets_stay_where_they_are_when_pairs_are_verified(spark, prepared):
    _, sets = prepared
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = spark.createDataFrame([], "a binary, b binary").repartition(3)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        text = ngram_join.verify(pairs, sets)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Bucketed: true") == 2
    # the pairs by one end and, with a set, by the other; repartition is the third
    assert text.count("Exchange") == 3


def test_prefix_rows_without_a_partner_are_left_out(prepared):
    prefixes, _ = prepared
    held = prefixes.groupBy("fragment", "gram").agg(F.countDistinct("node").alias("classes"))
    assert prefixes.count() > 0
    assert held.where("classes < 2").count() == 0


def test_near_copies_are_found_as_before(docs_of):
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(near_copies(docs_of)).collect()}
    assert found == {i: i - i % 3 if i < 60 else i for i in range(80)}


def test_line_hashes_move_as_bytes(docs_of):
    line = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([f"a\nb\nc\n{line}", f"x\na\nb\nc\n{line}\nd"])
    picked = line_dedup.selected(docs)
    around = F.aggregate(F.transform("around", F.octet_length), F.lit(0), lambda total, n: total + n)
    found = picked.select(F.octet_length("digest"), F.octet_length("hash"), around / F.size("around")).distinct().collect()
    assert [tuple(r) for r in found] == [(32, 16, 16)]
    runs = line_dedup.passages(docs, line_dedup.PASSAGE_WORDS)
    found = runs.select(F.octet_length("digest"), F.octet_length("run")).distinct().collect()
    assert [tuple(r) for r in found] == [(32, 16)]
