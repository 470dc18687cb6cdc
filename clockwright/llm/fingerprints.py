"""Document fingerprints: every shingle hash below a fixed fraction of the hash space.

The sketch has no size of its own; it grows with the text.  Sketches of parts
merge into the sketch of the whole by union, and the share of one sketch found
in another estimates containment, also between texts of very unequal length.

Shingles are five words (a shorter text is one shingle), hashed by MD5 so that
any engine can recompute a sketch.  The smallest hash is kept even when it is
above the threshold, so that a short text has a fingerprint; a merge keeps it
right, because the smallest hash of a union is one of the two smallest.

One hash says little, so ``least`` keeps more: the smallest ``least`` hashes, be
they above the threshold or not.  Shorter sets are kept whole, and merges stay
right for the same reason.  Sketches then reach to different heights, and are
compared as far as both do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: words of a shingle
WIDTH = 5
#: digits kept of a hash (48 bits): ample to tell the shingles of two texts apart
DIGITS = 12
#: hashes below this hexadecimal number are kept: one in eight
THRESHOLD = "2" + "0" * (DIGITS - 1)

#: hashes that a sketch of a short text keeps at least, if it has as many
LEAST = 64

_SPACE = "[\\x20\\x09-\\x0D]+"
_LOWEST = -(2 ** 63)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPACE), "")


def with_sketch(rows: DataFrame, text: str, column: str, threshold: str = THRESHOLD, least: int = 1) -> DataFrame:
    """Add the sketch of a text column: sorted distinct hashes below the threshold, and the ``least`` smallest.

    Words and hashes are bound as elements of one-element lists: as columns they
    would be copied into the functions over them, and made again per word, when
    a filter on a result is moved down.
    """
    def hashed(words: Column) -> Column:
        # word by word: a slice reads the whole list, for every shingle; words past the end are null and left out
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0))),
            lambda i: F.substring(F.md5(F.concat_ws(" ", *[F.get(words, i + k) for k in range(WIDTH)])), 1, DIGITS))

    def kept(hashes: Column) -> Column:
        return _bound(F.array_distinct(F.filter(hashes, lambda h: h < threshold)), lambda below: F.sort_array(
            # as many below the threshold are the smallest already, and the others need not be sorted
            F.when(F.size(below) >= least, below)
            .otherwise(F.array_union(below, F.slice(F.sort_array(F.array_distinct(hashes)), 1, least)))))

    def sketch(words: Column) -> Column:
        return F.when(F.size(words) > 0, _bound(hashed(words), kept)).otherwise(F.array().cast("array<string>"))

    return rows.withColumn(column, _bound(words_of(F.col(text)), sketch))


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, where the value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other holds; 0 if one of them is empty, 1 if both are."""
    smaller = F.least(F.size(a), F.size(b))
    return (F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller)
            .when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0)))


def likeness_within(a: Column, b: Column, least: int, threshold: str = THRESHOLD) -> Column:
    """Likeness by the hashes up to the height that both sketches reach.

    A sketch of fewer than ``least`` hashes is the whole set; others have all
    hashes below the threshold and up to their own largest.  0 if nothing of
    one text is as low as the other's sketch reaches.
    """
    def reach(sketch: Column) -> Column:
        return F.when(F.size(sketch) < least, F.lit("g")).otherwise(
            F.greatest(F.array_max(sketch), F.lit(f"{int(threshold, 16) - 1:0{DIGITS}x}")))

    # bound: inside a filter the height would be found again, over both sketches, for every hash
    def within(pair: Column) -> Column:
        return F.struct(F.filter(pair["a"], lambda h: h <= pair["height"]).alias("a"),
                        F.filter(pair["b"], lambda h: h <= pair["height"]).alias("b"))

    pair = F.struct(a.alias("a"), b.alias("b"), F.least(reach(a), reach(b)).alias("height"))
    return _bound(_bound(pair, within), lambda low: likeness(low["a"], low["b"]))


def merge(a: Column, b: Column, threshold: str = THRESHOLD, least: int = 1) -> Column:
    """Sketch of the union of two shingle sets: what is below the threshold, and the ``least`` smallest."""
    both = F.array_sort(F.array_union(a, b))
    return F.filter(both, lambda h, i: (h < threshold) | (i < least))


def as_text(sketched: Column) -> Column:
    return F.array_join(sketched, " ")


def with_next(rows: DataFrame, columns: tuple[str, ...], blocks: int, *, key: str = "doc_id",
              tie: str = "text") -> DataFrame:
    """Add ``next_<column>``: the value in the next row by (key, tie); the last row's next is the first.

    Rows are dealt to about ``blocks`` ranges of the key, by quantiles, and sorted
    inside them; the first row of a range is also sent to the range before it.
    Only the borders reach the driver, a few numbers per range.  Null keys come
    first.  Rows move once.
    """
    place = F.coalesce(F.col(key).cast("bigint"), F.lit(_LOWEST))
    keys = rows.select(place.alias("__key"))
    cuts = [i / blocks for i in range(1, blocks)]
    found = keys.agg(F.percentile_approx("__key", cuts, 100 * blocks).alias("q")).first()["q"] if cuts else []
    borders = sorted(set(found or []))
    # a key belongs to the range of the borders that are below it
    block = (F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b < F.col("__key")))
             if borders else F.lit(0))
    firsts = sorted((r["block"], r["first"]) for r in
                    keys.groupBy(block.alias("block")).agg(F.min("__key").alias("first")).collect())
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    width = len(borders) + 1
    first_of = F.array(*[F.lit(dict(firsts).get(b, _LOWEST)) for b in range(width)])
    block_before = F.array(*[F.lit(before.get(b, 0)) for b in range(width)])
    placed = rows.withColumn("__key", place).withColumn("__block", block)
    own = F.struct(F.col("__block").alias("block"), F.lit(0).alias("visit"))
    guest = F.struct(F.get(block_before, F.col("__block")).alias("block"), F.lit(1).alias("visit"))
    targets = F.when(F.get(first_of, F.col("__block")) == F.col("__key"), F.array(own, guest)).otherwise(F.array(own))
    sent = placed.withColumn("__to", F.explode(targets)).select(
        *rows.columns, "__key", F.col("__to.block").alias("__at"), F.col("__to.visit").alias("__visit"))
    order = Window.partitionBy("__at").orderBy("__visit", "__key", tie)
    return (sent.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
            .where("__visit = 0").drop("__key", "__at", "__visit"))


def fingerprint_documents(documents: DataFrame, *, blocks: int | None = None, least: int = 1) -> DataFrame:
    """Fingerprints of every text and of its edited text, and what they say of likeness.

    The edited text has its last quarter of code points (rounded down) replaced
    by the first as many, or all, of the next document by (doc_id, text), the
    first following the last.

    Columns: doc_id, n_chars, edited_text, sketch, edited_sketch (sorted lists
    of hashes), near_edited, near_next (likeness to the edited text and to the
    next document).  Null texts count as empty; a text without words has an
    empty sketch, alike only to another such.  One document is its own next.
    Repeated rows follow each other.  Other columns are not read.  With
    ``least`` above 1, sketches hold as many hashes at least, and likeness is
    taken as far as both reach.
    """
    spark = documents.sparkSession
    if blocks is None:
        blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sketched = with_sketch(texts, "text", "sketch", least=least).withColumn("sketch", as_text(F.col("sketch")))
    rows = with_next(sketched, ("text", "sketch"), blocks)
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.char_length("text") - quarter)
    edited = rows.withColumn("edited_text", F.concat(head, F.substring(F.col("next_text"), F.lit(1), quarter)))
    edited = with_sketch(edited, "edited_text", "edited_sketch", least=least).withColumns(
        {"sketch": _parts("sketch"), "next_sketch": _parts("next_sketch")})

    def alike(other: str) -> Column:
        a, b = F.col("sketch"), F.col(other)
        return likeness(a, b) if least == 1 else likeness_within(a, b, least)

    return edited.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "edited_text", "sketch", "edited_sketch",
        alike("edited_sketch").alias("near_edited"),
        alike("next_sketch").alias("near_next"))


def _parts(column: str) -> Column:
    return F.array_remove(F.split(F.col(column), " "), "")
