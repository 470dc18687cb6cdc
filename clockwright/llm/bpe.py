"""Byte-level BPE: every distinct pre-token is encoded once, whatever the corpus' size.

1. Texts are put into blocks of bounded length, which are stored once; a long
   text is a block of its own.  A block ranks its distinct pre-tokens, the
   frequent ones first, and holds each text as ranks: what stands where.
2. Each block sends every distinct pre-token once, by fragment of a hash, so
   equal words of all blocks meet and a word that is everywhere takes one entry
   per block.  Each distinct word is encoded once, by merging byte pairs in the
   order of their ranks, and its ids go back to the blocks that sent it.
3. Each text is put together from its ranks and its block's ids.  Blocks are
   stored in buckets of their number, so only the ids move.

The number of fragments follows the number of words sent, so that a fragment's
size does not.  Decoding looks up every id in the table of token bytes.  The
vocabulary is a file of ranks whose path is a parameter; it is read by the
driver and has a fixed size, so it is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clockwright.scratch import materialize_in_buckets, text_batches

#: characters of a block, about; longer texts are blocks of their own
BLOCK_CHARS = 12_000_000
#: words per fragment, about, and the fewest fragments
FRAGMENT_WORDS = 400_000
MIN_FRAGMENTS = 64
#: words whose ids are put together at a time
_TOGETHER = 500_000
#: ranks that are packed or unpacked at a time
_RANKS_TOGETHER = 1 << 18
#: a character that no version of Unicode assigns
_UNASSIGNED = "\uffff"
#: pieces up to this length are merged by looking through all pairs
_SHORT = 64

# --- fixed values ---------------------------------------------------------------------
#: the pattern for which the letters, numbers and white space of the first 256 code points are known
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\\t-\\r \\x85\\xa0"
# --------------------------------------------------------------------------------------


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that splits a text into the pattern's matches.

    For texts of the first 256 code points the usual pattern is spelled out
    without properties of characters, which is twice as fast.
    """
    findall, unknown = regex.compile(pattern).findall, {}

    def general(text: str) -> list[str]:
        new = [c for c in set(text) if unicodedata.category(c) == "Cn"]
        unknown.update({c: _unknown(c, pattern) for c in new if c not in unknown})
        odd = [c for c in new if unknown[c]]
        if not odd:
            return findall(text)
        pieces, at = [], 0
        for piece in findall(text.translate(dict.fromkeys(map(ord, odd), _UNASSIGNED))):
            pieces.append(text[at:at + len(piece)])
            at += len(piece)
        return pieces

    if pattern != _PATTERN:
        return general
    latin = re.compile(
        f" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
        f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+").findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general(text)
        return latin(text)

    return split


def _unknown(character: str, pattern: str) -> bool:
    """Whether the character is too new to be a letter or number for the reference encoder, whatever ``regex`` says."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {(a + character).encode(): 256 + i for i, a in enumerate("a1")}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return all(len(probe.encode_ordinary(a + character)) > 1 for a in "a1")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from lines of base64 bytes and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank, leftmost first, is merged until none has a rank.

    Empty bytes have no ids.
    """
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > _SHORT:
        return _merge_long(piece, ranks)
    none = len(ranks) + (1 << 32)
    edge = list(range(len(piece) + 1))
    rank = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while rank and (least := min(rank)) != none:
        i = rank.index(least)
        del edge[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks.get(piece[edge[i]:edge[i + 2]], none)
        if i:
            rank[i - 1] = ranks.get(piece[edge[i - 1]:edge[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(edge, edge[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with the pairs in a heap, so long pieces take n log n steps."""
    size = len(piece)
    stop = list(range(1, size + 1))     # where the part that starts here ends; 0: merged into an earlier one
    before = list(range(-1, size))      # start of the part before

    def pair(i: int) -> tuple[int, int, int, int] | None:
        middle = stop[i]
        if middle >= size:
            return None
        rank = ranks.get(piece[i:stop[middle]])
        return None if rank is None else (rank, i, middle, stop[middle])

    waiting = [p for p in map(pair, range(size)) if p]
    heapq.heapify(waiting)
    while waiting:
        _, i, middle, end = heapq.heappop(waiting)
        if stop[i] != middle or stop[middle] != end:
            continue                    # one of its parts has been merged since
        stop[i], stop[middle] = end, 0
        if end < size:
            before[end] = i
        for j in (i, before[i]):
            if j >= 0 and (p := pair(j)):
                heapq.heappush(waiting, p)
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i:stop[i]]])
        i = stop[i]
    return ids


@dataclass(frozen=True)
class Vocabulary:
    """Ranks and the pattern that splits a text into pre-tokens."""

    ranks: Broadcast
    pattern: str
    kind: str       # type of a packed id

    @staticmethod
    def load(spark: SparkSession, path: str, pattern: str) -> Vocabulary:
        ranks = read_ranks(path)
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks single bytes: {lacking[:5]}")
        # two bytes hold most vocabularies
        kind = "<u2" if max(ranks.values()) <= 0xFFFF else "<u4"
        return Vocabulary(spark.sparkContext.broadcast(ranks), pattern, kind)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Compressed numbers, byte by byte of all of them: high bytes are mostly alike."""
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)
    return zstandard.ZstdCompressor(3).compress(planes.T.tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


#: first bytes of numbers of one, two, three and five bytes begin here
_TWO, _THREE, _FIVE = 160, 240, 255
_FROM_TWO, _FROM_THREE = _TWO, _TWO + (_THREE - _TWO) * 256
_FROM_FIVE = _FROM_THREE + (_FIVE - _THREE) * 65536


def _pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Small numbers in one byte, others in more; first bytes and further bytes are compressed apart."""
    first = np.empty(len(ranks), np.uint8)
    more: tuple[list[np.ndarray], ...] = ([], [], [], [])
    for at in range(0, len(ranks), _RANKS_TOGETHER):
        some = ranks[at:at + _RANKS_TOGETHER].astype(np.int64)
        kind = np.searchsorted([_FROM_TWO, _FROM_THREE, _FROM_FIVE], some, "right")
        two, three, five = some[kind == 1] - _FROM_TWO, some[kind == 2] - _FROM_THREE, some[kind == 3]
        some[kind == 1] = _TWO + (two >> 8)
        some[kind == 2] = _THREE + (three >> 16)
        some[kind == 3] = _FIVE
        first[at:at + _RANKS_TOGETHER] = some
        for own, part in zip(more, (two & 255, three >> 8 & 255, three & 255, five.astype("<u4").view(np.uint8))):
            own.append(part.astype(np.uint8))
    compress = zstandard.ZstdCompressor(3).compress
    return compress(first.tobytes()), compress(b"".join(part.tobytes() for own in more for part in own))


def _unpack_ranks(first: bytes, more: bytes) -> np.ndarray:
    """The numbers, in four bytes each."""
    expand = zstandard.ZstdDecompressor().decompress
    heads = np.frombuffer(expand(first), np.uint8)
    twos, threes = (int(np.count_nonzero((heads >= low) & (heads < high))) for low, high in ((_TWO, _THREE), (_THREE, _FIVE)))
    low, middle, least, whole = np.split(np.frombuffer(expand(more), np.uint8), np.cumsum([twos, threes, threes]))
    whole = np.ascontiguousarray(whole).view("<u4")
    ranks, seen = np.empty(len(heads), np.uint32), np.zeros(3, np.int64)
    for at in range(0, len(heads), _RANKS_TOGETHER):
        some = heads[at:at + _RANKS_TOGETHER].astype(np.int64)
        kind = np.searchsorted([_TWO, _THREE, _FIVE], some, "right")
        two, three, five = (np.flatnonzero(kind == k) for k in (1, 2, 3))
        (i, j, k), seen = seen, seen + (len(two), len(three), len(five))
        some[two] = _FROM_TWO + (some[two] - _TWO << 8) + low[i:seen[0]]
        some[three] = (_FROM_THREE + (some[three] - _THREE << 16) + (middle[j:seen[1]].astype(np.int64) << 8)
                       + least[j:seen[1]])
        some[five] = whole[k:seen[2]]
        ranks[at:at + _RANKS_TOGETHER] = some
    return ranks


_BLOCK = "docs binary, sizes binary, ranks binary, more_ranks binary, words binary, lengths binary, distinct_words long"


def _blocks(pattern: str, block_chars: int):
    """Blocks of texts as ranks of their distinct words by frequency, and these words by rank."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern)
        compress = zstandard.ZstdCompressor(3).compress
        docs: list[int | None] = []
        texts: list[np.ndarray] = []
        known: dict[str, int] = {}
        gathered = 0

        def block() -> pa.RecordBatch:
            """The block of what was gathered, which is given up piece by piece: a task never holds it twice."""
            ids = np.array([[0 if d is None else d, d is None] for d in docs], np.int64)
            sizes = _pack(np.array([len(t) for t in texts], np.int64), "<u4")
            numbers = np.concatenate(texts)
            texts.clear()
            docs.clear()
            counts = np.zeros(len(known), np.int64)
            for at in range(0, len(numbers), _RANKS_TOGETHER):
                counts += np.bincount(numbers[at:at + _RANKS_TOGETHER], minlength=len(known))
            frequent = np.argsort(-counts, kind="stable")
            rank = np.empty(len(known), np.uint32)
            rank[frequent] = np.arange(len(known), dtype=np.uint32)
            for at in range(0, len(numbers), _RANKS_TOGETHER):
                numbers[at:at + _RANKS_TOGETHER] = rank[numbers[at:at + _RANKS_TOGETHER]]
            words = list(known)
            known.clear()
            words = [words[i].encode() for i in frequent.tolist()]
            packed = (_pack(ids.ravel(), "<i8"), sizes, *_pack_ranks(numbers), compress(b"".join(words)),
                      _pack(np.array([len(w) for w in words], np.int64), "<u4"))
            return pa.RecordBatch.from_arrays(
                [*[pa.array([x], pa.binary()) for x in packed], pa.array([len(words)], pa.int64())],
                ["docs", "sizes", "ranks", "more_ranks", "words", "lengths", "distinct_words"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = text.as_py()
                if docs and gathered + len(content) > block_chars:
                    yield block()
                    gathered = 0
                docs.append(doc_id)
                # four bytes a word: a text has fewer words than bytes, and a string ends at 2 GB
                texts.append(np.array([known.setdefault(w, len(known)) for w in split(content)], np.uint32))
                gathered += len(content)
        if docs:
            yield block()
    return build


def _sent(fragments: int):
    """(fragment, block, ranks, words, lengths): the words of each block by fragment of their hash."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, compress = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(3).compress
        for batch in batches:
            for block, words, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
                joined, stops = expand(words), np.cumsum(_unpack(lengths, "<u4").astype(np.int64)).tolist()
                parts = [joined[i:j] for i, j in zip([0, *stops], stops)]
                hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in parts], np.uint64)
                fragment = ((hashed >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
                order = np.argsort(fragment, kind="stable")
                found, first = np.unique(fragment[order], return_index=True)
                spans = np.split(order, first[1:]) if len(found) else []
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.astype(np.int64)), pa.array(np.full(len(found), block, np.int64)),
                    pa.array([_pack(np.diff(ranks, prepend=0), "<u4") for ranks in spans], pa.binary()),
                    pa.array([compress(b"".join([parts[i] for i in ranks.tolist()])) for ranks in spans], pa.binary()),
                    pa.array([_pack(np.array([len(parts[i]) for i in ranks.tolist()], np.int64), "<u4") for ranks in spans], pa.binary()),
                ], ["fragment", "block", "ranks", "words", "lengths"])
    return send


def _encode_fragment(ranks: Broadcast, kind: str):
    """Of one fragment: every distinct word is encoded once; each block gets the ids of its words in their order."""
    def encode_words(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        merges, known, sizes, ids = ranks.value, {}, [], []
        for words, lengths in zip(table.column("words"), table.column("lengths")):
            joined, at, found = expand(words.as_py()), 0, []
            for length in _unpack(lengths.as_py(), "<u4").tolist():
                word = joined[at:at + length]
                at += length
                if (own := known.get(word)) is None:
                    own = known[word] = merge_pairs(word, merges)
                found.append(own)
            sizes.append(_pack(np.array([len(x) for x in found], np.int64), "<u4"))
            ids.append(_pack(np.array([i for x in found for i in x], np.int64), kind))
        return pa.table([table.column("block"), table.column("ranks"), pa.array(sizes, pa.binary()),
                         pa.array(ids, pa.binary())], names=["block", "ranks", "sizes", "ids"])
    return encode_words


def _assemble(kind: str, ranks: Broadcast | None = None):
    """(doc_id, ids) of the texts of blocks, from their ranks and the ids of their words; with ranks, their digests, too."""
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None if ranks is None else _digester(ranks.value)
        for batch in batches:
            for docs, sizes, first_bytes, more, distinct, found in zip(*(batch.column(i).to_pylist() for i in range(6))):
                docs = _unpack(docs, "<i8").reshape(-1, 2)
                lengths, starts, parts, upto = np.zeros(distinct, np.int64), np.zeros(distinct, np.int64), [], 0
                for part in found or ():
                    own, size = np.cumsum(_unpack(part["ranks"], "<u4").astype(np.int64)), _unpack(part["sizes"], "<u4").astype(np.int64)
                    lengths[own], starts[own] = size, upto + np.cumsum(size) - size
                    parts.append(_unpack(part["ids"], kind).astype(np.int32))
                    upto += len(parts[-1])
                ids = np.concatenate([np.empty(0, np.int32), *parts])
                word = _unpack_ranks(first_bytes, more)
                stops = np.concatenate([[0], np.cumsum(_unpack(sizes, "<u4").astype(np.int64))])
                # some texts at a time, so that the ids of a block are never all in one array
                first = 0
                while first < len(docs):
                    last = max(first + 1, int(np.searchsorted(stops, stops[first] + _TOGETHER, "right")) - 1)
                    own = word[stops[first]:stops[last]]
                    size = lengths[own]
                    ends = np.cumsum(size)
                    total = int(ends[-1]) if len(ends) else 0
                    values = ids[np.repeat(starts[own] - (ends - size), size) + np.arange(total)]
                    offsets = np.concatenate([[0], ends])[stops[first:last + 1] - stops[first]]
                    columns = [
                        pa.array(docs[first:last, 0], pa.int64(), mask=docs[first:last, 1].astype(bool)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)),
                    ]
                    if digest is not None:
                        spans = zip(offsets.tolist(), offsets[1:].tolist())
                        columns += [pa.array(x, pa.string()) for x in zip(*(digest(values[i:j].tolist()) for i, j in spans))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "ids_sha256", "decoded_sha256"][:len(columns)])
                    first = last
    return assemble


def encode(documents: DataFrame, vocabulary: Vocabulary, *, block_chars: int = BLOCK_CHARS,
           fragment_words: int = FRAGMENT_WORDS, min_fragments: int = MIN_FRAGMENTS, digest: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of every text, one row per row of ``documents``.

    Null and empty texts have no ids.  Special tokens are ordinary text.
    Repeated rows each have their ids; doc_id may be null or repeat.  Only
    doc_id and text are read.  The ids depend on the text alone, not on blocks
    and fragments.

    With ``digest``, ids_sha256 and decoded_sha256 follow, as ``digests`` has
    them.  They are made where texts are put together, so a task keeps one
    Python worker and not two, and the ids do not go to a second one.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # bucketed, so that the ranks, the larger part, stay where they are when the ids come back
    with text_batches(documents.sparkSession):
        blocks = materialize_in_buckets(rows.mapInArrow(_blocks(vocabulary.pattern, block_chars), _BLOCK)
                                        .withColumn("block", F.monotonically_increasing_id()), "blocks", "block")
    total = blocks.agg(F.sum("distinct_words")).first()[0] or 0
    fragments = max(min_fragments, -(-total // fragment_words))
    sent = blocks.select("block", "words", "lengths").mapInArrow(
        _sent(fragments), "fragment long, block long, ranks binary, words binary, lengths binary")
    found = (sent.groupBy("fragment").applyInArrow(
                 _encode_fragment(vocabulary.ranks, vocabulary.kind), "block long, ranks binary, sizes binary, ids binary")
             .groupBy("block").agg(F.collect_list(F.struct("ranks", "sizes", "ids")).alias("found")))
    return (blocks.join(found.hint("merge"), "block", "left").select("docs", "sizes", "ranks", "more_ranks", "distinct_words", "found")
            .mapInArrow(_assemble(vocabulary.kind, vocabulary.ranks if digest else None),
                        "doc_id long, ids array<int>" + ", ids_sha256 string, decoded_sha256 string" * digest))


def decode(vocabulary: Vocabulary, ids: Column) -> Column:
    """The bytes that a list of ids stands for; an id without bytes is an error, null and empty lists are empty."""
    ranks = vocabulary.ranks

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = {rank: token for token, rank in ranks.value.items()}
        for column in batches:
            yield pd.Series([b"" if x is None else b"".join(map(table.__getitem__, x.tolist())) for x in column],
                            dtype=object)

    return decoded(ids)


def _digester(ranks: dict[bytes, int]) -> Callable[[list[int]], tuple[str, str]]:
    """Of a text's ids, the digests of their decimal list and of the bytes that they decode to."""
    table = {rank: token for token, rank in ranks.items()}
    decimal = {rank: str(rank) for rank in table}

    def digest(ids: list[int]) -> tuple[str, str]:
        return (hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest())

    return digest


def digests(vocabulary: Vocabulary, ids: Column) -> Column:
    """ids_sha256 and decoded_sha256: of the decimal ids joined by commas, and of the decoded bytes, in hexadecimal."""
    ranks = vocabulary.ranks

    @F.pandas_udf("ids_sha256 string, decoded_sha256 string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        digest = _digester(ranks.value)
        for column in batches:
            # text by text: numbers as objects take many times their size
            found = [digest([] if x is None else x.tolist()) for x in column]
            yield pd.DataFrame(found, columns=["ids_sha256", "decoded_sha256"], dtype=object)

    return both(ids)
