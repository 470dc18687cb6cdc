"""The best documents for each of many queries, by integer term weights, in two ways of walking the lists.

The queries' vocabulary is small; documents are not.  One scan turns documents
into blocks of postings of that vocabulary, stored once.  A document's postings
are all in its block, so scores never meet in a shuffle.

1. Term at a time: lists of terms that few documents have are short.  In each
   block they are summed into accumulators, one sparse list per query, which are
   stored with the block.  The k-th best accumulator of a query over all blocks
   is a bound that its k-th best score cannot be below.
2. Document at a time: a query's accumulators are one more list with a largest
   value, beside its long lists.  Lists that cannot reach the bound together are
   not walked, only probed for the documents of the others, and only while a
   document can still reach the bound.  A block whose lists cannot reach it is
   skipped.  Each task raises the bound with what it has found.

Each task hands on k documents per query; Spark ranks them.  Queries come in
slices of a bounded number of terms, so that what is broadcast is bounded; every
slice is held against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from clockwright.scratch import materialize

TOP = 50
#: documents and terms of a block, about
BLOCK_ROWS = 4096
BLOCK_TERMS = 1_000_000
#: a list is short if at most one document in so many has its term
SHORT_PART = 64
#: terms of the queries of one slice, about
SLICE_TERMS = 200_000

_NONE = np.empty(0, np.int64)


def _bytes_to_terms() -> bytes:
    """A-Z in lower case, other letters and digits and all of non-ASCII as they are, the rest as blanks."""
    def kept(b: int) -> bool:
        return b >= 0x80 or chr(b).isalnum()
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if kept(b) else 0x20 for b in range(256))


_TERMS = _bytes_to_terms()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERMS).split()


def _pack(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(1).compress(values.astype(kind).tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind).astype(np.int64)


@dataclass(frozen=True)
class Queries:
    """A slice of queries: their ids, the vocabulary, and the numbers of each query's terms."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]

    @staticmethod
    def of(rows: list[Row]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        terms = []
        for row in rows:
            numbers = {vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(row["text"])}
            terms.append(np.array(sorted(numbers), np.int64))
        return Queries([row["item_id"] for row in rows], vocabulary, terms)


_BLOCK = ("counts array<long>, ids binary, lengths binary, terms binary, starts binary, places binary, times binary")


def _index(queries: Broadcast):
    """Blocks of postings: per known term, in order, the documents and how often they have it."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = queries.value[0].get
        ids, lengths, found = [], [], []
        gathered = 0

        def block() -> pa.RecordBatch:
            n = np.array(lengths, np.int64)
            numbers = np.concatenate(found)
            place = np.repeat(np.arange(len(found)), [len(f) for f in found])
            key, times = np.unique(numbers * len(found) + place, return_counts=True)
            term = key // len(found)
            terms, starts = np.unique(term, return_index=True)
            nulls = [i is None for i in ids]
            return pa.RecordBatch.from_arrays([
                pa.array([[int((n > 0).sum()), int(n.sum())]], pa.list_(pa.int64())),
                pa.array([_pack(np.array([[0 if i is None else i, null] for i, null in zip(ids, nulls)], np.int64), "<i8")], pa.binary()),
                *[pa.array([_pack(x, "<u4")], pa.binary()) for x in (n, terms, starts, key % len(found), times)]],
                ["counts", "ids", "lengths", "terms", "starts", "places", "times"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                ids.append(doc_id)
                lengths.append(len(words))
                found.append(np.array([x for x in map(look_up, words) if x is not None], np.int64))
                gathered += len(words)
                if len(ids) >= BLOCK_ROWS or gathered >= BLOCK_TERMS:
                    yield block()
                    ids, lengths, found, gathered = [], [], [], 0
        if ids:
            yield block()
    return build


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) of each block."""
    for batch in batches:
        for terms, starts, places in zip(*(batch.column(i).to_pylist() for i in range(3))):
            starts = _unpack(starts, "<u4")
            counts = np.diff(starts, append=len(_unpack(places, "<u4")))
            yield pa.RecordBatch.from_arrays([pa.array(_unpack(terms, "<u4")), pa.array(counts)], ["term", "documents"])


@dataclass(frozen=True)
class Weights:
    """What all documents together say: their number and length, each term's weight, and which lists are short."""

    documents: int
    length: int
    weight: np.ndarray
    short: np.ndarray

    @staticmethod
    def of(index: DataFrame, size: int) -> Weights:
        total = index.agg(F.sum(F.col("counts")[0]).alias("n"), F.sum(F.col("counts")[1]).alias("l")).first()
        documents, length = total["n"] or 0, total["l"] or 0
        df = np.zeros(size, np.int64)
        # one row per term of the slice
        for row in (index.select("terms", "starts", "places").mapInArrow(_frequencies, "term long, documents long")
                    .groupBy("term").agg(F.sum("documents").alias("df")).collect()):
            df[row["term"]] = row["df"]
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        return Weights(documents, length, weight, df * SHORT_PART <= documents)


def contributions(weight: np.ndarray, times: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the scores of documents of the given lengths, in whole numbers."""
    m = 100 - 50 + (50 * length * documents) // max(1, total)
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * m))


class _Lists:
    """A block's lists, opened: documents of a term, and what it adds to their scores."""

    def __init__(self, row: dict, weights: Weights) -> None:
        lengths = _unpack(row["lengths"], "<u4")
        self.terms = _unpack(row["terms"], "<u4")
        self.places = _unpack(row["places"], "<u4")
        self.starts = np.append(_unpack(row["starts"], "<u4"), len(self.places))
        term = np.repeat(self.terms, np.diff(self.starts))
        self.values = contributions(weights.weight[term], _unpack(row["times"], "<u4"), lengths[self.places],
                                    weights.documents, weights.length)
        self.rows = len(lengths)
        self.at = np.full(len(weights.weight), -1)
        self.at[self.terms] = np.arange(len(self.terms))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[term]
        if at < 0:
            return _NONE, _NONE
        span = slice(self.starts[at], self.starts[at + 1])
        return self.places[span], self.values[span]


def _accumulate(queries: Broadcast, weights: Broadcast):
    """Add to each block its accumulators: per query the documents that short lists have, and their sums."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Weights(*weights.value)
        short = [[t for t in terms.tolist() if w.short[t]] for terms in queries.value[1]]
        for batch in batches:
            bounds, places, sums = [], [], []
            for row in batch.to_pylist():
                lists = _Lists(row, w)
                total = np.zeros(lists.rows, np.int64)
                ends, at, values = [0], [], []
                for terms in short:
                    touched = []
                    for term in terms:
                        place, value = lists.of(term)
                        total[place] += value
                        touched.append(place)
                    place = np.unique(np.concatenate(touched)) if touched else _NONE
                    at.append(place)
                    values.append(total[place])
                    total[place] = 0
                    ends.append(ends[-1] + len(place))
                bounds.append(_pack(np.array(ends), "<i8"))
                places.append(_pack(np.concatenate([_NONE, *at]), "<u4"))
                sums.append(_pack(np.concatenate([_NONE, *values]), "<i8"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(x, pa.binary()) for x in (bounds, places, sums)]],
                [*batch.schema.names, "acc_starts", "acc_places", "acc_sums"])
    return add


def _largest(k: int):
    """(query, score): the k largest accumulators of each query in a task."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for starts, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for q, own in enumerate(np.split(_unpack(sums, "<i8"), _unpack(starts, "<i8")[1:-1])):
                    if len(own):
                        best[q] = np.sort(np.concatenate([best.get(q, _NONE), own]))[-k:]
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(best), [len(x) for x in best.values()])), pa.array(np.concatenate(list(best.values())))],
                ["query", "score"])
    return keep


class _Best:
    """The k best documents of a query so far: largest score first, then smallest id, null last."""

    def __init__(self, k: int, bound: int) -> None:
        self.k, self.bound = k, bound
        self.scores, self.ids, self.nulls = _NONE, _NONE, _NONE

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[:self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        if len(order) == self.k:
            self.bound = max(self.bound, int(self.scores[-1]))


def walk(lists: list[tuple[np.ndarray, np.ndarray]], rows: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all documents of a block whose score is above 0 and reaches ``bound``.

    Each list holds documents in order with positive or zero values.
    """
    lists = [x for x in lists if len(x[0])]
    tops = np.array([int(values.max()) for _, values in lists], np.int64)
    order = np.argsort(tops, kind="stable")
    reach = np.cumsum(tops[order])
    # lists that cannot reach the bound together are probed only
    probed = int(np.searchsorted(reach, bound, "left"))
    if probed == len(lists):
        return _NONE, _NONE
    score = np.zeros(rows, np.int64)
    for i in order[probed:]:
        place, value = lists[i]
        score[place] += value
    found = np.flatnonzero(score)
    total = score[found]
    for p in range(probed - 1, -1, -1):
        able = total + reach[p] >= bound
        found, total = found[able], total[able]
        place, value = lists[order[p]]
        at = np.minimum(np.searchsorted(place, found), len(place) - 1)
        total = total + np.where(place[at] == found, value[at], 0)
    able = (total >= bound) & (total > 0)
    return found[able], total[able]


def _search(queries: Broadcast, weights: Broadcast, bounds: Broadcast, k: int):
    """(query, doc_id, score): the k best documents of each query in a task."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Weights(*weights.value)
        long = [[t for t in terms.tolist() if not w.short[t]] for terms in queries.value[1]]
        best = [_Best(k, bounds.value.get(q, 0)) for q in range(len(long))]
        for batch in batches:
            for row in batch.to_pylist():
                lists = _Lists(row, w)
                ids, nulls = _unpack(row["ids"], "<i8").reshape(-1, 2).T
                ends, at, sums = _unpack(row["acc_starts"], "<i8"), _unpack(row["acc_places"], "<u4"), _unpack(row["acc_sums"], "<i8")
                for q, terms in enumerate(long):
                    own = slice(ends[q], ends[q + 1])
                    place, score = walk([(at[own], sums[own]), *map(lists.of, terms)], lists.rows, best[q].bound)
                    if len(place):
                        best[q].add(score, ids[place], nulls[place])
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            ids, nulls = (np.concatenate([getattr(b, x) for b in best]) for x in ("ids", "nulls"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(ids, pa.int64(), mask=nulls.astype(bool)),
                 pa.array(np.concatenate([b.scores for b in best]))], ["query", "doc_id", "score"])
    return find


def _slices(spark: SparkSession, items: DataFrame, slice_terms: int) -> Iterator[Queries]:
    """The distinct queries, in slices of about ``slice_terms`` terms; one slice at a time is on the driver."""
    rows = materialize(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), "queries")
    # a term and the break after it take two characters at least
    room = rows.agg(F.sum(F.char_length("text") / 2 + 1)).first()[0] or 0
    slices = max(1, math.ceil(room / slice_terms))
    for i in range(slices):
        yield Queries.of(rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i)
                         .orderBy("item_id", "text").collect())


def rank_documents(documents: DataFrame, items: DataFrame, *, k: int = TOP, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``items`` (item_id, text).

    Terms are runs of ASCII letters and digits and of other characters beyond
    ASCII, A-Z in lower case; a query's terms count once.  Only scores above 0
    are listed; equal scores go by doc_id, null last.  Items that repeat in full
    are one; rows with one item_id and different texts are ranked each for
    itself.  Null and empty texts have no terms.  Every row of ``documents`` is a
    document, repeated ones too.  Other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    share = spark.sparkContext.broadcast
    results = []
    for known in _slices(spark, items, slice_terms):
        queries = share((known.vocabulary, known.terms))    # plain values, which need no code on executors
        index = materialize(texts.mapInArrow(_index(queries), _BLOCK), "postings")
        weights = share(astuple(Weights.of(index, len(known.vocabulary))))
        blocks = materialize(index.mapInArrow(
            _accumulate(queries, weights), _BLOCK + ", acc_starts binary, acc_places binary, acc_sums binary"), "accumulators")
        by_score = Window.partitionBy("query").orderBy(F.desc("score"))
        kth = (blocks.select("acc_starts", "acc_sums").mapInArrow(_largest(k), "query long, score long")
               .withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).where(F.col("rank") == k))
        bounds = share({row["query"]: row["score"] for row in kth.collect()})      # one row per query of the slice
        found = blocks.mapInArrow(_search(queries, weights, bounds, k), "query long, doc_id long, score long")
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ids = spark.createDataFrame([(q, i) for q, i in enumerate(known.ids)], "query long, item_id long")
        results.append(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                       .join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"))
    ranked = results[0]
    for more in results[1:]:
        ranked = ranked.unionByName(more)
    return ranked
