"""Exact similarity join on word n-grams by vertical partitioning.

Every text is the set of its distinct five-word shingles; two texts are linked
when the Jaccard similarity of their sets is at least 0.75.  Texts with equal
sets form a class and are joined once.

The global order of n-grams (by hash) is cut into fragments, and each class's
set into segments, one per fragment.

1. In each fragment the documents of every n-gram are counted.  N-grams of one
   class only cannot be in any intersection and are dropped; the others are
   counted per class and summed over the fragments.  A class with fewer than
   75 % shared n-grams has no link, which leaves few classes to compare.
2. The shared n-grams of a class are ordered by rarity; two linked classes share
   one of the first ``n - ceil(0.75 n) + 1``.  These prefixes yield candidates.
   At the first n-gram that two classes share, neither can share more than it has
   left from there on; pairs that this rules out are never made.
3. For candidate pairs the overlap is counted in each group of fragments
   separately, from the segments of both, and summed per pair.

A large group of near copies would yield all its pairs.  For components
they are not needed, so candidates come in rounds: first each class is compared
with the class of each prefix n-gram that has the fewest n-grams of its own, then
with others like it where an n-gram still joins different components; last, every
remaining pair of different components that shares a prefix n-gram and can share
enough from it on is compared, whatever their number.  No link between components
is lost, and pairs inside a component are not made.

Where links are asked for, ``class_links`` verifies every pair of classes that
shares a prefix n-gram, and ``link_counts`` counts them per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clockwright.llm.components import components
from clockwright.scratch import materialize, materialize_in_buckets, text_batches

WIDTH = 5
#: similarity in hundredths
LEAST = 75
#: n-grams of a fragment, which one task holds at a time, and the fewest fragments
FRAGMENT_SIZE = 2_000_000
MIN_FRAGMENTS = 64
#: n-grams that a task gathers before it sends segments on
_GATHERED = 1_000_000
_KNOWN_WORDS = 100_000
#: per round, different draws of centres and how far they reach; the last round after them compares all that are left
_ROUNDS = ((1, 1), (8, 4))
#: groups of fragments in which the overlap of a pair is counted
_PARTS = 8

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)
_32, _48 = np.uint64(32), np.uint64((1 << 48) - 1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, as unsigned numbers."""
    words = text.encode().translate(_UPPER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        mixed += hashed[i:len(words) - width + 1 + i] * _ODD[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _ODD[0]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD[1]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _class_of(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def classes(documents: DataFrame, *, digest: bool = False) -> DataFrame:
    """(doc_id, n, node) for every row: the size of its set, and its class; null for an empty set.  With the text's digest if asked."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            sizes, nodes = [], []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), known)
                sizes.append(len(hashes))
                nodes.append(_class_of(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), *batch.columns[2:]],
                ["doc_id", "n", "node", "digest"][:batch.num_columns + 1])

    texts, schema = _texts(documents), "doc_id long, n long, node binary"
    if digest:
        texts, schema = texts.withColumn("digest", F.sha2("text", 256)), f"{schema}, digest string"
    return texts.mapInArrow(classify, schema)


def _stored_classes(documents: DataFrame, *, digest: bool = False) -> DataFrame:
    with text_batches(documents.sparkSession):
        return materialize(classes(documents, digest=digest), "classes")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _segments(documents: DataFrame, fragments: int) -> DataFrame:
    """Packed segments: for a fragment, nodes (16 bytes each), their numbers of n-grams and the n-grams (6 bytes)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        nodes: list[bytes] = []
        sets: list[np.ndarray] = []
        gathered = 0

        def sent() -> pa.RecordBatch:
            """Segments of all gathered sets, by fragment; arrays of all of them, not one per segment."""
            hashes, sizes = np.concatenate(sets), [len(s) for s in sets]
            sets.clear()
            own = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, 16)
            nodes.clear()
            # the upper 32 bits number the fragments; arrays of all n-grams are few at a time, as every worker holds them
            wide = hashes >> _32
            wide *= np.uint64(fragments)
            wide >>= _32
            fragment = wide.astype(np.min_scalar_type(fragments))
            del wide
            order = np.argsort(fragment, kind="stable")
            fragment, grams = fragment[order], hashes[order]
            del hashes
            owner = np.repeat(np.arange(len(own), dtype=np.int32), sizes)[order]
            del order
            starts = np.flatnonzero(np.concatenate([[True], (fragment[1:] != fragment[:-1]) | (owner[1:] != owner[:-1])]))
            stops = np.append(starts[1:], len(grams))
            numbers, whose, where = (stops - starts).astype("<u4"), owner[starts], fragment[starts]
            full, first = np.unique(where, return_index=True)
            spans = list(zip(first.tolist(), [*first[1:].tolist(), len(starts)]))
            return pa.RecordBatch.from_arrays([
                pa.array(full.astype(np.int32)),
                pa.array([own[whose[i:j]].tobytes() for i, j in spans], pa.binary()),
                pa.array([numbers[i:j].tobytes() for i, j in spans], pa.binary()),
                pa.array([_pack(grams[starts[i]:stops[j - 1]] & _48) for i, j in spans], pa.binary()),
            ], ["fragment", "nodes", "sizes", "grams"])

        for batch in batches:
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), known)
                if not len(hashes):
                    continue
                nodes.append(_class_of(hashes))
                sets.append(hashes)
                gathered += len(hashes)
                if gathered >= _GATHERED:
                    yield sent()
                    gathered = 0
        if gathered:
            yield sent()

    return _texts(documents).mapInArrow(cut, "fragment int, nodes binary, sizes binary, grams binary")


def _pack(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _shared_of_fragment(table: pa.Table) -> pa.Table:
    """Of one fragment, per class: the n-grams that other classes have too, and in how many classes they are."""
    fragment = table.column("fragment")[0].as_py()
    packed = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.uint8).reshape(-1, 16)
    numbers = np.frombuffer(b"".join(table.column("sizes").to_pylist()), "<u4")
    # a class counts once, however many texts it has
    halves = packed.view("<u8")
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    ordered = halves[order]
    keep = np.zeros(len(numbers), bool)
    keep[order[np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])]] = True
    nodes, ends = packed[keep], np.cumsum(numbers[keep], dtype=np.int64)
    del packed, halves, order, ordered
    # arrays of all n-grams are few at a time: these, their order and, for a moment, the ordered ones
    all_grams, upto, at = np.empty(ends[-1], np.uint64), 0, 0
    for sizes, values in zip(table.column("sizes"), table.column("grams")):
        count = len(sizes.as_py()) // 4
        kept = _unpack(values.as_py())[np.repeat(keep[upto:upto + count], numbers[upto:upto + count])]
        all_grams[at:at + len(kept)] = kept
        upto, at = upto + count, at + len(kept)
    order = np.argsort(all_grams)
    ordered = all_grams[order]
    new = np.ones(len(order) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:-1])
    del ordered
    several = ~(new[:-1] & new[1:])
    places, new = order[several], new[:-1][several]
    del order, several
    count = np.diff(np.flatnonzero(new), append=len(places))
    back = np.argsort(places)
    places, spread = places[back], np.repeat(np.minimum(count, 2 ** 31 - 1).astype(np.int32), count)[back]
    per_node = np.bincount(np.searchsorted(ends, places, "right"), minlength=len(nodes))
    has = np.flatnonzero(per_node)
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_node[has])]).astype(np.int32))
    named = pa.Array.from_buffers(pa.binary(16), len(has), [None, pa.py_buffer(nodes[has].tobytes())]).cast(pa.binary())
    return pa.table([
        named, pa.array(np.full(len(has), fragment, np.int32)),
        pa.ListArray.from_arrays(offsets, pa.array(all_grams[places].astype(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(spread)),
    ], names=["node", "fragment", "grams", "spread"])


_SHARED = "node binary, fragment int, grams array<bigint>, spread array<int>"


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest shared n-grams of each class, as many as must hold one of any linked class."""
    for batch in batches:
        found, sizes, numbers = [], [], batch.column("n").to_pylist()
        for n, parts in zip(numbers, batch.column("parts")):
            parts = parts.values
            fragment = np.repeat(parts.field("fragment").to_numpy(), parts.field("grams").value_lengths().to_numpy())
            gram = parts.field("grams").flatten().to_numpy()
            spread = parts.field("spread").flatten().to_numpy()
            take = len(gram) - -(-LEAST * n // 100) + 1
            order = np.lexsort((gram, fragment, spread))[:take]
            found.append((fragment[order], gram[order], len(gram) - np.arange(len(order)), n - len(gram)))
            sizes.append(len(order))
        yield pa.RecordBatch.from_arrays([
            batch.column("node").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
            pa.array(np.concatenate([f[0] for f in found]).astype(np.int32)),
            pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
            pa.array(np.repeat(np.array(numbers, np.int64), sizes)),
            pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)),
            pa.array(np.repeat(np.array([f[3] for f in found], np.int32), sizes)),
        ], ["node", "fragment", "gram", "n", "rest", "own"])


def _prepared(documents: DataFrame, of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix n-grams and segments of the classes that may be linked.

    The first is (node, fragment, gram, n, rest, own), where rest is how many
    shared n-grams the class has from this one on, and own how many no other
    class has, without rows that no link can come from; the second (node, n, parts), the shared n-grams by groups of
    fragments, the same groups for every class.
    """
    total = of.agg(F.sum("n")).first()[0] or 0
    fragments = max(MIN_FRAGMENTS, -(-total // FRAGMENT_SIZE))
    with text_batches(documents.sparkSession):
        shared = materialize(
            _segments(documents, fragments).groupBy("fragment").applyInArrow(_shared_of_fragment, _SHARED), "shared")
    sizes = of.where(F.col("node").isNotNull()).groupBy("node").agg(F.max("n").alias("n"))
    # shared n-grams move once, to their class, and in buckets they stay there when pairs are verified
    gathered = (shared.groupBy("node").agg(F.sum(F.size("grams")).alias("shared"),
                                           F.collect_list(F.struct("fragment", "grams", "spread")).alias("own"))
                .join(sizes, "node").where(F.col("shared") * 100 >= F.col("n") * LEAST))
    sets = materialize_in_buckets(gathered.select("node", "n", "own", _by_part(F.col("own")).alias("parts")), "sets", "node")
    prefixes = materialize(sets.select("node", "n", F.col("own").alias("parts")).mapInArrow(
        _prefixes, "node binary, fragment int, gram long, n long, rest int, own int"), "prefixes")
    return _able(prefixes), sets.select("node", "n", "parts")


def _able(prefixes: DataFrame) -> DataFrame:
    """The rows of prefix n-grams from which a link can come: others have the n-gram, and its smallest class is not too unlike."""
    others = (prefixes.groupBy(*_GRAM).agg(F.min("n").alias("least_n"), F.count(F.lit(1)).alias("holders"))
              .where("holders > 1"))
    return materialize(
        prefixes.join(others, _GRAM).where(_may_link(F.col("n"), F.col("rest"), F.col("least_n"), F.col("rest")))
        .select(*prefixes.columns), "able")


def _by_part(own: Column) -> Column:
    """The n-grams of a class's segments by groups of fragments; those of different fragments stay apart."""
    def whole(segment: Column) -> Column:
        return F.transform(segment["grams"], lambda g: g.bitwiseXOR(F.shiftleft(segment["fragment"].cast("bigint"), 48)))

    return F.transform(F.sequence(F.lit(0), F.lit(_PARTS - 1)), lambda p: F.flatten(F.transform(
        F.filter(own, lambda segment: segment["fragment"] % _PARTS == p), whole)))


def class_links(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Membership, (doc_id, n, node) of every row, and every link (a, b) between different classes, a < b, once.

    Documents of one class have equal sets and are linked with each other; so no
    link between two documents is lost.  All pairs of classes that share a prefix
    n-gram are verified, which can be the square of a group of near copies.
    """
    of = _stored_classes(documents)
    prefixes, sets = _prepared(documents, of)
    candidates = _all_pairs(prefixes.withColumn("label", F.col("node")))
    return of, materialize(verify(candidates, sets), "class-links")


def link_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_size, n_links) for every row: rows of its class, itself included, and other rows it is linked with.

    A text without shingles has no class and no links; both numbers are 0.
    """
    of, pairs = class_links(documents)
    sizes = materialize(of.where(F.col("node").isNotNull()).groupBy("node").agg(F.count(F.lit(1)).alias("class_size")), "class-sizes")
    ends = pairs.select("a", F.col("b").alias("node")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("node")))
    outside = ends.join(sizes, "node").groupBy(F.col("a").alias("node")).agg(F.sum("class_size").alias("outside"))
    counted = sizes.join(outside, "node", "left").select(
        "node", "class_size", (F.col("class_size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    return of.join(counted, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("class_size", "n_links")])


def links(documents: DataFrame, of: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Classes and their components: (doc_id, n, node) of every row, (node, label) of every linked class."""
    of = _stored_classes(documents) if of is None else of
    prefixes, sets = _prepared(documents, of)
    found = None        # verified links so far
    for number, centres in enumerate((*_ROUNDS, None)):
        labelled = (prefixes.withColumn("label", F.col("node")) if found is None
                    else _across(prefixes, components(found)))
        if labelled is None:
            break
        candidates = _stars(labelled, *centres, number) if centres else _all_pairs(labelled)
        verified = materialize(verify(candidates, sets), "verified")
        found = verified if found is None else found.unionByName(verified)
    return of, components(found)


_GRAM = ["fragment", "gram"]


def _may_link(n: Column, rest: Column, other_n: Column, other_rest: Column) -> Column:
    """Whether two classes that share their first n-gram here can share enough: 100 o >= 75 (n + m - o)."""
    return F.least(rest, other_rest) * (100 + LEAST) >= (n + other_n) * LEAST


def _across(prefixes: DataFrame, labels: DataFrame) -> DataFrame | None:
    """The rows of prefix n-grams that still stand in more than one component, with their components."""
    rows = prefixes.join(labels, "node", "left").select(
        "node", *_GRAM, "n", "rest", "own", F.coalesce("label", "node").alias("label"))
    mixed = rows.groupBy(*_GRAM).agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    left = materialize(rows.join(mixed.select(*_GRAM), _GRAM), "across")
    return None if left.isEmpty() else left


def _stars(rows: DataFrame, orders: int, spread: int, seed: int) -> DataFrame:
    """Each class with one class of each of its n-grams, the centre; pairs of one component left out.

    In a group of near copies the text they were made from has the fewest n-grams
    of its own and is like most of them, so centres are those with the fewest, give
    or take ``spread``, by ``orders`` different draws.
    """
    draw = F.xxhash64("node", F.pmod(F.col("gram"), F.lit(orders)), F.lit(seed))
    rows = rows.withColumn("order", F.struct(F.col("own") + F.pmod(draw, F.lit(spread)), draw))
    centres = rows.groupBy(*_GRAM).agg(F.min_by(F.struct("node", "label", "n", "rest"), "order").alias("c"))
    return (rows.join(centres, _GRAM)
            .where((F.col("label") != F.col("c.label"))
                   & _may_link(F.col("n"), F.col("rest"), F.col("c.n"), F.col("c.rest")))
            .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct())


def _all_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different components that share a prefix n-gram from which on they may share enough.

    One side of such a pair is always outside the n-gram's largest component,
    so only classes outside it are joined with the others.
    """
    per_label = rows.groupBy(*_GRAM, "label").count()
    largest = per_label.groupBy(*_GRAM).agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
    marked = rows.join(largest, _GRAM)
    minor = marked.where(F.col("label") != F.col("largest")).select(
        *_GRAM, F.col("node").alias("x"), F.col("label").alias("x_label"), F.col("n").alias("x_n"),
        F.col("rest").alias("x_rest"))
    return (marked.join(minor, _GRAM)
            .where((F.col("label") != F.col("x_label")) & ((F.col("label") == F.col("largest")) | (F.col("x") < F.col("node")))
                   & _may_link(F.col("n"), F.col("rest"), F.col("x_n"), F.col("x_rest")))
            .select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct())


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: overlaps are counted in each part of the fragments separately and summed per pair."""
    left = sets.select(F.col("node").alias("a"), F.col("parts").alias("parts_a"), F.col("n").alias("n_a"))
    right = sets.select(F.col("node").alias("b"), F.col("parts").alias("parts_b"), F.col("n").alias("n_b"))
    counts = F.zip_with("parts_a", "parts_b", lambda x, y: F.size(F.array_intersect(x, y)))
    whole = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "n_a", "n_b", F.aggregate(counts, F.lit(0), lambda total, part: total + part).alias("both"))
    return whole.where(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * LEAST).select("a", "b")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    component_id is the smallest doc_id that links lead to, the row's own
    included.  Words are what ASCII white space separates, with A-Z in lower
    case; a text of fewer than five words is one shingle.  Null and empty texts
    and those without words have no shingles, link with nothing and keep their
    own id.  Repeated rows are linked.  A null doc_id takes part like others but
    never names a component that has ids.  Only doc_id and text are read.
    """
    of, by_node = _named(documents)
    return of.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _named(documents: DataFrame, of: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The classes of all rows, and (node, label, component_id) of every class."""
    of, labels = links(documents, of)
    named = (of.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
             .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    named = materialize(named, "named")
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return of, materialize(named.join(names, "label").select("node", "label", "component_id"), "component-names")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each component, and every text without words, with all columns.

    The document that stays has the smallest id, and of several texts with this
    id the smallest digest; of rows with its id and text, one stays.  Each row
    follows its own text, whatever others have its id.  Rows without an id go
    only when they are linked with one that has an id.
    """
    of, by_node = _named(documents, _stored_classes(documents, digest=True))
    own = (of.groupBy("doc_id", "digest").agg(F.first("node").alias("node"), F.count(F.lit(1)).alias("rows"))
           .join(by_node, "node", "left"))
    free = own.where(F.col("node").isNull() | F.col("component_id").isNull()).select(
        "doc_id", "digest", F.lit(1).cast("bigint").alias("rows"))
    chosen = (own.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("label").agg(F.min(F.struct("doc_id", "digest", "rows")).alias("s")).select("s.*"))
    stays = materialize(free.unionByName(chosen).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "rows"), "stays").withColumnRenamed("rows", "__rows")
    text_digest = F.sha2(F.coalesce(documents["text"], F.lit("")), 256)
    same = documents["doc_id"].cast("bigint").eqNullSafe(F.col("__id")) & (text_digest == F.col("__digest"))
    several = stays.where("__rows > 1")
    once = documents.join(stays.where("__rows = 1"), same, "left_semi")
    if several.isEmpty():
        return once
    repeated = documents.join(several, same, "left_semi").withColumn("__digest", text_digest)
    return once.unionByName(repeated.dropDuplicates(["doc_id", "__digest"]).drop("__digest"))
