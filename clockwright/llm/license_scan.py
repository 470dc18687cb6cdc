"""Licence notices by a positional index of rare template words.

The index holds, for every template word, its postings (template, position) and
its inverse document frequency over the whole corpus.  In each file the rarest
word of a template's key phrase is looked up; every place where it stands fixes
the relative position of the template.  There the template's postings are
intersected with the file's words by position, weighted by rarity, and the key
phrases, which a notice must contain word for word, are verified.

The index depends on the templates alone (``TEMPLATES``, a parameter) and is
part of the expressions; nothing is broadcast or shuffled but one count per
template word.  All work on a file happens inside its row, without Python, and
files without a rare word cost one substring search per template.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values ---------------------------------------------------------------------
#: phrases whose every place is reported, and their labels
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: label, wording, key phrases; all in words as the scan sees them
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files", ("permission is hereby granted", "free of charge")),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("gpl-3", "licensed under the gnu general public license version 3",
     ("gnu general public license", "version 3")),
    ("gpl-2", "licensed under the gnu general public license version 2",
     ("gnu general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ("gnu affero general public license",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# --------------------------------------------------------------------------------------

#: share of a template's rarity that must stand in place beside the key phrases
MIN_SCORE = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]   # (position in the template, words)


def compile_template(label: str, wording: str, phrases: tuple[str, ...]) -> Template:
    words = tuple(wording.split())
    keys = []
    for phrase in phrases:
        part = tuple(phrase.split())
        places = [i for i in range(len(words)) if words[i:i + len(part)] == part]
        if not part or not places:
            raise ValueError(f"key phrase {phrase!r} is not in template {wording!r}")
        keys.append((places[0], part))
    return Template(label, words, tuple(keys))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, as far as equality with ASCII words goes.

    Two letters beyond ASCII have an ASCII letter in their lower case; they are
    replaced by another letter first, which keeps them parts of their words.
    """
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("ÿ")), F.lit("İ"), F.lit("ÿ"))
    return F.lower(plain)


def words_of(low: Column) -> Column:
    return F.array_remove(F.split(low, _SEPARATORS), "")


def rarity(words: DataFrame, column: str, vocabulary: list[str]) -> dict[str, float]:
    """ln((1 + files) / (1 + files with the word)) over all files; bounded by the templates' words."""
    present = words.select(F.explode(F.array_append(
        F.array_intersect(column, F.array(*map(F.lit, vocabulary))), F.lit(""))).alias("word"))
    files = {r["word"]: r["count"] for r in present.groupBy("word").count().collect()}
    total = files.get("", 0)
    return {w: math.log((1 + total) / (1 + files.get(w, 0))) for w in vocabulary}


def _stands(words: Column, at: Column, part: tuple[str, ...]) -> Column:
    same = [F.coalesce(F.get(words, at + i) == w, F.lit(False)) for i, w in enumerate(part)]
    return reduce(Column.__and__, same)


def _starts(words: Column, low: Column, keys, idf: dict[str, float]) -> Column:
    """Starts (of position 0) at which all key phrases stand, found from their rarest word."""
    spots = [(idf[w], -(at + i), w) for at, part in keys for i, w in enumerate(part)]
    _, minus_at, anchor = max(spots)
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == anchor)
    starts = F.transform(places, lambda i: i + minus_at)
    def verified(s: Column) -> Column:
        return reduce(Column.__and__, [_stands(words, s + at, part) for at, part in keys])
    nothing = F.array().cast("array<int>")
    return F.when(F.contains(low, F.lit(anchor)) & (F.size(words) > 0), F.filter(starts, verified)).otherwise(nothing)


def scan(documents: DataFrame, *, templates=TEMPLATES, base=BASE_PHRASES, min_score: float = MIN_SCORE,
         text: str = "text") -> DataFrame:
    """Licence labels of every row; its other columns are kept, those named below replaced.

    n_words; n_base, first_word, last_word, base_labels: the places of the base
    phrases; labels: theirs and those of the templates found; score: the largest
    share of a template's rarity that stands in place, among templates whose key
    phrases stand there (0 without one).

    Null and empty texts have no words, no labels and score 0; first_word and
    last_word are null without a place.  Places may overlap and all count.
    Equal texts have equal results; an empty table gives an empty result.
    """
    compiled = [compile_template(*t) for t in templates]
    phrases = [compile_template(label, phrase, (phrase,)) for label, phrase in base]
    vocabulary = sorted({w for t in compiled + phrases for w in t.words})
    content = F.coalesce(F.col(text), F.lit(""))
    idf = rarity(documents.select(words_of(lowered(content)).alias("words")), "words", vocabulary)

    low, words = F.col("__low"), F.col("__words")
    rows = (documents.withColumn("__low", lowered(content)).withColumn("__words", words_of(low)))
    found = rows.withColumns(
        {f"__base{i}": _starts(words, low, p.keys, idf) for i, p in enumerate(phrases)}
        | {f"__score{i}": _best(words, low, t, idf) for i, t in enumerate(compiled)})
    base_places = F.concat(*[F.col(f"__base{i}") for i in range(len(phrases))])
    base_labels = [F.when(F.size(f"__base{i}") > 0, F.lit(p.label)) for i, p in enumerate(phrases)]
    own_labels = [F.when(F.col(f"__score{i}") >= min_score, F.lit(t.label)) for i, t in enumerate(compiled)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    result = {
        "n_words": F.size(words).cast("bigint"),
        "n_base": F.size(base_places).cast("bigint"),
        "first_word": F.array_min(base_places).cast("bigint"),
        "last_word": F.array_max(base_places).cast("bigint"),
        "base_labels": joined(base_labels),
        "labels": joined(base_labels + own_labels),
        "score": F.greatest(*[F.col(f"__score{i}") for i in range(len(compiled))], F.lit(0.0)),
    }
    kept = [c for c in documents.columns if c not in result]
    return found.select(*kept, *[value.alias(name) for name, value in result.items()])


def _best(words: Column, low: Column, template: Template, idf: dict[str, float]) -> Column:
    """The largest share of the template's rarity in place at one of its starts, or null.

    Words in no or every file weigh as their rarity says; should all weigh
    nothing, every word counts the same.
    """
    weights = [idf[w] for w in template.words]
    if not sum(weights):
        weights = [1.0] * len(weights)
    total = sum(weights)
    def share(s: Column) -> Column:
        hits = [F.when(F.get(words, s + i) == w, F.lit(v)).otherwise(F.lit(0.0))
                for i, (w, v) in enumerate(zip(template.words, weights))]
        return F.round(reduce(Column.__add__, hits) / F.lit(total), 6)
    return F.array_max(F.transform(_starts(words, low, template.keys, idf), share))
