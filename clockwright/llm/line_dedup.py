"""Repeated runs of lines, found by winnowing over line hashes.

A run is ``RUN`` consecutive lines.  Pairs of adjacent lines are hashed, and of
the hashes in each run the smallest is selected (the rightmost of equals), which
depends on the run's lines alone: two equal runs always share a selected hash.

Selected hashes that occur once are done with.  The places of the others are
extended to both sides, as far as a run around them can reach; equal runs are
joined with their first place, and the lines of every later run are deleted.
Overlapping runs make repeats of any length.  First means: in an earlier
document, by (doc_id, digest), or earlier in the same one without overlap.

Lines differ in length, so a passage, one line or two adjacent ones that hold
``PASSAGE_WORDS`` words or more, is a run too, in texts of any number of lines.
They are hashed whole, without winnowing.

Hashes are kept as bytes: written as hex they would take twice the shuffle, the
files and the memory of every step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clockwright.scratch import materialize

#: lines hashed together, hashes of which the smallest is selected, and the lines of a run that this makes
GRAM, WINDOW = 2, 2
RUN = GRAM + WINDOW - 1
#: words from which one line, or two adjacent ones, are a run, and the most lines of such a passage
PASSAGE_WORDS = 50
PASSAGE_LINES = 2

_SPACE = "[\\x20\\x09-\\x0D]+"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _md5(value: Column) -> Column:
    return F.unhex(F.md5(value))


def _md5_of(hashes: Column, start: Column, length: int) -> Column:
    """One hash of the ``length`` hashes from ``start`` on, all of which must be there."""
    return _md5(F.concat(*[F.get(hashes, start + i) for i in range(length)]))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _upto(last: Column) -> Column:
    """0, 1, ... ``last``; nothing if it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def selected(documents: DataFrame) -> DataFrame:
    """(doc_id, digest, place, hash, from, around): selected hashes, with the line hashes a run around can hold."""
    rows = (documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest(F.col("text")).alias("digest"),
                             F.transform(_lines(F.col("text")), _md5).alias("lines"))
            .where(F.size("lines") >= RUN).dropDuplicates(["doc_id", "digest"]))
    lines, grams = F.col("lines"), F.col("grams")
    rows = rows.withColumn("grams", F.transform(_upto(F.size(lines) - GRAM), lambda i: _md5_of(lines, i, GRAM)))

    def chosen(start: Column) -> Column:
        window = F.reverse(F.slice(grams, start + 1, F.lit(WINDOW)))
        return start + WINDOW - F.array_position(window, F.array_min(window)).cast("int")

    places = F.array_distinct(F.transform(_upto(F.size(lines) - RUN), chosen))
    begin = F.greatest(F.col("place") - (WINDOW - 1), F.lit(0))
    return (rows.withColumn("place", F.explode(places))
            .select("doc_id", "digest", "place", F.get(grams, F.col("place")).alias("hash"), begin.alias("from"),
                    F.slice(lines, begin + 1, F.col("place") - begin + GRAM + WINDOW - 1).alias("around")))


def passages(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, digest, start, length, run): one line or two adjacent ones that hold ``words`` words or more."""
    line = F.col("lines")
    counted = F.transform(_lines(F.col("text")), lambda x: F.struct(
        _md5(x).alias("hash"), F.size(F.array_remove(F.split(x, _SPACE), "")).alias("words")))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest(F.col("text")).alias("digest"),
                            counted.alias("lines"))

    def of(length: int) -> Column:
        def at(start: Column) -> Column:
            return F.struct(start.alias("start"), F.lit(length).alias("length"),
                            _md5_of(line["hash"], start, length).alias("run"),
                            sum(F.get(line["words"], start + i) for i in range(length)).alias("words"))
        return F.transform(_upto(F.size(line) - length), at)

    found = F.filter(F.concat(*[of(n) for n in range(1, PASSAGE_LINES + 1)]), lambda x: x["words"] >= words)
    return rows.select("doc_id", "digest", F.explode(found).alias("p")).select(
        "doc_id", "digest", "p.start", "p.length", "p.run").distinct()


def repeated_lines(documents: DataFrame, passage_words: int | None = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, digest, removed): numbers, from 0, of the lines that belong to later runs.

    Without ``passage_words`` only runs of ``RUN`` lines count.
    """
    picked = materialize(selected(documents), "fingerprints")
    several = picked.groupBy("hash").count().where("count > 1").select("hash")
    around = F.col("around")
    run = F.explode(F.transform(
        _upto(F.size(around) - RUN),
        lambda i: F.struct((F.col("from") + i).alias("start"), _md5_of(around, i, RUN).alias("run"))))
    # neighbouring places reach the same runs
    runs = (picked.join(several, "hash").select("doc_id", "digest", run.alias("r"))
            .select("doc_id", "digest", "r.start", F.lit(RUN).alias("length"), "r.run").distinct())
    if passage_words is not None:
        runs = runs.unionByName(passages(documents, passage_words))
    runs = materialize(runs, "runs")
    order = F.struct(F.coalesce("doc_id", F.lit(-(2 ** 63))).alias("id"), "digest", "start")
    first = runs.groupBy("run").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
    same = F.col("doc_id").eqNullSafe(F.nullif(F.col("first.id"), F.lit(-(2 ** 63)))) & (F.col("first.digest") == F.col("digest"))
    later = (runs.join(materialize(first, "first-runs"), "run")
             .where(~same | (F.col("start") >= F.col("first.start") + F.col("length"))))
    lines = later.select("doc_id", "digest", F.explode(F.transform(_upto(F.col("length") - 1), lambda i: F.col("start") + i)).alias("line"))
    return lines.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def drop_repeated_lines(documents: DataFrame, *, passage_words: int | None = PASSAGE_WORDS) -> DataFrame:
    """All rows and columns of ``documents``, ``text`` without the lines of later runs, and n_lines, n_removed.

    Every row stays; a text of which all lines go is empty.  Null texts stay
    null and have one empty line, like empty texts.  Runs are three lines, or
    one or two with ``passage_words`` words or more between them; without
    ``passage_words``, texts of fewer than three lines are unchanged.  Rows with
    the same doc_id and text are one document and end alike.  n_lines and
    n_removed replace columns of these names.
    """
    removed = repeated_lines(documents, passage_words).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("removed").alias("__removed"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (_digest(F.col("text")) == F.col("__digest"))
    joined = documents.join(removed, same, "left").withColumn("__lines", _lines(F.col("text")))
    hit = F.col("__removed").isNotNull()
    flagged = F.transform(F.col("__lines"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    left = F.transform(F.filter(flagged, lambda x: ~F.array_contains(F.col("__removed"), x["i"])), lambda x: x["line"])
    result = {
        "text": F.when(hit, F.array_join(left, "\n")).otherwise(F.col("text")),
        "n_lines": F.size("__lines").cast("bigint"),
        "n_removed": F.when(hit, F.size("__removed")).otherwise(F.lit(0)).cast("bigint"),
    }
    kept = [c for c in documents.columns if c not in result]
    return joined.select(*kept, *[value.alias(name) for name, value in result.items()])
