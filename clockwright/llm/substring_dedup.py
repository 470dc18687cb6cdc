"""Passages that an earlier document has, removed word by word.

A window is ``WIDTH`` consecutive words of one document.  A word goes if a
window over it begins in a document of a smaller id, too.

1. Documents are put into blocks of about ``BLOCK_WORDS`` words, which are
   stored once, compressed.  A long text is a block of its own.
2. Each window gets two Rabin-Karp hashes from running sums: one numbers a
   fragment, the other is its 64-bit key in there.  A block sends each key once,
   with its smallest document, so a window that a third of all documents has
   takes one entry per block.
3. Spark brings equal fragments together, where the smallest document of each
   key is found.  What goes back to a block is one bit per key: whether another
   block has a smaller document with it.
4. Each block is read again with its bits.  Marked windows merge into maximal
   intervals, and the words outside them stay.

The number of fragments follows the number of words, so that a fragment's size
does not, and the two hashes together have more bits the more words there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from clockwright.scratch import materialize

#: words of a window
WIDTH = 13
#: words of a block, about
BLOCK_WORDS = 500_000
#: words per fragment, about, and the fewest fragments
FRAGMENT_WORDS = 1_000_000
MIN_FRAGMENTS = 256
#: words whose hashes a task remembers
_KNOWN_WORDS = 200_000

_LOWEST = -(2 ** 63)
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_BLOCK = "ids binary, words long, texts binary"


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _blocks(block_words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(3).compress
        ids: list[int | None] = []
        texts: list[bytes] = []
        gathered = 0

        def block() -> pa.RecordBatch:
            # ascending ids, so that the first occurrence in a block is that of its smallest document
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
            # words cannot hold a blank or a line feed
            stored = compress(b"\n".join(texts[i] for i in order))
            numbers = pa.array([ids[i] for i in order], pa.int64())
            nulls = numbers.null_count
            packed = np.array([nulls, *numbers.fill_null(_LOWEST).to_pylist()], "<i8").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([compress(packed)], pa.binary()), pa.array([gathered], pa.int64()), pa.array([stored], pa.binary())],
                ["ids", "words", "texts"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode().split()       # bytes split at ASCII white space only
                if ids and gathered + len(words) > block_words:
                    yield block()
                    ids, texts, gathered = [], [], 0
                ids.append(doc_id)
                texts.append(b" ".join(words))
                gathered += len(words)
        if ids:
            yield block()
    return build


def _opened(ids: bytes, texts: bytes) -> tuple[np.ndarray, int, list[list[bytes]]]:
    """Ids in ascending order, how many of the first are null, and the words of each text."""
    expand = zstandard.ZstdDecompressor().decompress
    numbers = np.frombuffer(expand(ids), "<i8")
    return numbers[1:], int(numbers[0]), [x.split() for x in expand(texts).split(b"\n")]


def rabin_karp(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Hashes of all windows of a row of word hashes, from sums of ``word * base ** place`` modulo 2 ** 64."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    count = len(words)
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(count - 1, base)]))
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(count - width, inverse)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers, dtype=np.uint64)])
    return (sums[width:] - sums[:-width]) * back


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


class _Windows:
    """The windows of a block's texts: keys, fragments, and the first place of each key, by fragment."""

    def __init__(self, texts: list[list[bytes]], known: _Hashes, width: int, fragments: int) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        hashed = np.fromiter((known[w] for t in texts for w in t), np.uint64, int(sizes.sum()))
        self.ends = np.cumsum(sizes)
        text = np.repeat(np.arange(len(texts)), sizes)
        # windows that stay within one text
        self.places = np.flatnonzero(text[:len(text) - width + 1] == text[width - 1:]) if len(text) >= width else np.empty(0, np.int64)
        keys = _mixed(rabin_karp(hashed, width, _BASES[0]))[self.places]
        self.texts = text[self.places]
        self.keys, first, self.which = np.unique(keys, return_index=True, return_inverse=True)
        self.first = first
        spread = _mixed(rabin_karp(hashed, width, _BASES[1]))[self.places[first]]
        fragment = ((spread >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        #: distinct keys by fragment, and inside one by place
        self.order = np.lexsort((first, fragment))
        self.fragments, self.starts = np.unique(fragment[self.order], return_index=True)


def _segments(width: int, fragments: int):
    """Packed keys of a block by fragment, with the ids of their first documents."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, compress = _Hashes(), zstandard.ZstdCompressor(1).compress
        for batch in batches:
            for block, ids, texts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                numbers, _, words = _opened(ids.as_py(), texts.as_py())
                w = _Windows(words, known, width, fragments)
                keys = np.split(w.keys[w.order], w.starts[1:])
                owners = np.split(numbers[w.texts[w.first[w.order]]], w.starts[1:])
                yield pa.RecordBatch.from_arrays([
                    pa.array(w.fragments.astype(np.int64)), pa.array(np.full(len(w.fragments), block, np.int64)),
                    pa.array([k.astype("<u8").tobytes() for k in keys] if len(w.fragments) else [], pa.binary()),
                    pa.array([compress(np.diff(o, prepend=0).astype("<i8").tobytes()) for o in owners]
                             if len(w.fragments) else [], pa.binary()),
                ], ["fragment", "block", "keys", "owners"])
    return cut


def _earlier(table: pa.Table) -> pa.Table:
    """Of one fragment, per block: a bit per key, set if another block has a smaller document with it."""
    expand = zstandard.ZstdDecompressor().decompress
    keys = [np.frombuffer(x.as_py(), "<u8") for x in table.column("keys")]
    owners = np.concatenate([np.cumsum(np.frombuffer(expand(x.as_py()), "<i8")) for x in table.column("owners")])
    ends = np.cumsum([len(k) for k in keys])
    joined = np.concatenate(keys)
    order = np.lexsort((owners, joined))
    ordered, by_key = joined[order], owners[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    least = by_key[np.flatnonzero(new)][np.cumsum(new) - 1]
    marked = np.zeros(len(joined), bool)
    marked[order] = least < by_key
    bits = [np.packbits(x) for x in np.split(marked, ends[:-1])]
    some = [i for i, b in enumerate(bits) if b.any()]
    return pa.table([table.column("block").take(pa.array(some, pa.int64())),
                     table.column("fragment").take(pa.array(some, pa.int64())),
                     pa.array([bits[i].tobytes() for i in some], pa.binary())], names=["block", "fragment", "bits"])


_RESULT = ("doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string")


def _removal(width: int, fragments: int):
    """The words that stay in each text of a block, and the intervals that go."""
    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for ids, texts, found in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                numbers, nulls, words = _opened(ids.as_py(), texts.as_py())
                w = _Windows(words, known, width, fragments)
                bits = {x["fragment"]: x["bits"] for x in found or ()}
                ends = [*w.starts[1:].tolist(), len(w.order)]
                elsewhere = np.zeros(len(w.keys), bool)
                for fragment, start, end in zip(w.fragments.tolist(), w.starts.tolist(), ends):
                    if packed := bits.get(fragment):
                        elsewhere[w.order[start:end]] = np.unpackbits(np.frombuffer(packed, np.uint8), count=end - start)
                # in this block: windows of a document above the smallest that has the key
                own = numbers[w.texts]
                marked = elsewhere[w.which] | (own > own[w.first][w.which])
                change = np.zeros(int(w.ends[-1]) + 1, np.int64)
                np.add.at(change, w.places[marked], 1)
                np.add.at(change, w.places[marked] + width, -1)
                gone = np.cumsum(change[:-1]) > 0
                yield _kept(numbers, nulls, words, gone)
    return clear


def _kept(numbers: np.ndarray, nulls: int, words: list[list[bytes]], gone: np.ndarray) -> pa.RecordBatch:
    kept, removed, spans, first = [], [], [], 0
    for text in words:
        mask = gone[first:first + len(text)]
        first += len(text)
        removed.append(int(mask.sum()))
        if removed[-1]:
            border = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans.append([{"start": s, "end": e} for s, e in border.tolist()])
            text = [text[i] for i in np.flatnonzero(~mask).tolist()]
        else:
            spans.append([])
        kept.append(b" ".join(text).decode())
    ids = pa.array(numbers, pa.int64(), mask=np.arange(len(numbers)) < nulls)
    sizes = [len(text) for text in words]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "n_removed", "removed", "kept"])


def drop_repeated_passages(documents: DataFrame, *, width: int = WIDTH, block_words: int = BLOCK_WORDS,
                           fragment_words: int = FRAGMENT_WORDS, min_fragments: int = MIN_FRAGMENTS) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept) for every row of ``documents``.

    ``removed`` holds the maximal intervals of removed words, numbered from 0,
    end exclusive; ``kept`` the other words, joined by one blank.  Words are what
    ASCII white space separates, unchanged.  Windows are judged on the input.
    Rows with one doc_id are one document's parts: they remove nothing from each
    other.  A null doc_id is smaller than all others.  Null and empty texts have
    no words; texts shorter than a window stay.  Only doc_id and text are read.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = materialize(
        rows.mapInArrow(_blocks(block_words), _BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    fragments = max(min_fragments, -(-total // fragment_words))
    segments = blocks.select("block", "ids", "texts").mapInArrow(
        _segments(width, fragments), "fragment long, block long, keys binary, owners binary")
    bits = segments.groupBy("fragment").applyInArrow(_earlier, "block long, fragment long, bits binary")
    marks = materialize(bits, "marks").groupBy("block").agg(F.collect_list(F.struct("fragment", "bits")).alias("found"))
    return (blocks.join(marks, "block", "left").select("ids", "texts", "found")
            .mapInArrow(_removal(width, fragments), _RESULT))
