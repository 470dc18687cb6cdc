"""Secrets by shape, and by how random their characters follow each other.

Known shapes come from regular expressions.  Beyond them, every long token is
scored by two first-order Markov models of characters, one of random strings
and one of ordinary identifiers and numbers: the logarithm of the ratio of their
transition probabilities, in all and per transition.  Tokens that look random
enough are added.

The models are trained on samples that the corpus labels itself: values inside
the known shapes are random strings, long tokens of letters and runs of digits
outside them are ordinary identifiers and numbers.  Transitions are counted over all documents, combined
map-side; only the counts, at most twice the square of the alphabet, reach the
driver, and come back as one constant array that is indexed by character codes.

Everything runs inside rows by built-in functions.  Positions follow from the
lengths of matches and of the pieces between them, which the same expression
yields in the same order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values ---------------------------------------------------------------------
KINDS = ("assign", "access", "hex", "markov")
_NAME = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
ASSIGN = _NAME + r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
# --------------------------------------------------------------------------------------

#: tokens that the models score, and what stands for ordinary identifiers and numbers
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
ORDINARY = r"[A-Za-z_]{12,}|(?<![A-Za-z0-9+/_-])[0-9]{4,}(?![A-Za-z0-9+/_-])"
#: symbols a token can have
ALPHABET = 66
#: log-likelihood ratio, in nats, from which a token counts as random: in all, and per transition on the mean
MIN_TOTAL, MIN_RATIO = 6.0, 0.2

_BLOCK = 256
_SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _steps(text: Column, pattern: str, value_group: int | None = None) -> Column:
    """For each match in order: characters before it since the last one, its own, its value's."""
    parts = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")]
    if value_group is not None:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))
    zipped = F.filter(F.arrays_zip(*parts), lambda z: z["hit"].isNotNull())
    last = "hit" if value_group is None else "value"
    return F.transform(zipped, lambda z: F.struct(
        F.char_length(z["gap"]).alias("gap"), F.char_length(z["hit"]).alias("width"),
        z["hit"].alias("hit"), z[last].alias("value")))


_STEP = "array<struct<gap:int,width:int,hit:string,value:string>>"
_PLACED = "array<struct<start:int,stop:int,hit:string,value:string>>"


def _placed(steps: Column) -> Column:
    """Steps as positions.  Sums run inside blocks, then over them, so long lists stay cheap."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast(_PLACED).alias("spans"))

    def add(acc: Column, step: Column) -> Column:
        start = acc["total"] + step["gap"]
        stop = start + step["width"]
        span = F.struct(start.alias("start"), stop.alias("stop"), step["hit"].alias("hit"), step["value"].alias("value"))
        return F.struct(stop.alias("total"), F.array_append(acc["spans"], span).alias("spans"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["spans"], lambda s: F.struct(
            (s["start"] + acc["total"]).alias("start"), (s["stop"] + acc["total"]).alias("stop"),
            s["hit"].alias("hit"), s["value"].alias("value")))
        return F.struct((acc["total"] + block["total"]).alias("total"), F.concat(acc["spans"], moved).alias("spans"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), zero, add))
    return F.when(F.size(steps) > 0, F.aggregate(blocks, zero, join)["spans"]).otherwise(F.array().cast(_PLACED))


def with_matches(rows: DataFrame, text: str) -> DataFrame:
    """Add the three lists of known shapes as ``__assign``, ``__access``, ``__hex``."""
    content = F.col(text)
    none = F.array().cast(_STEP)
    steps = {
        "__assign": F.when(content.rlike(_NAME), _steps(content, ASSIGN, 1)).otherwise(none),
        "__access": F.when(F.contains(content, F.lit("AKIA")), _steps(content, ACCESS)).otherwise(none),
        "__hex": F.when(content.rlike(r"[0-9a-f]{%d}" % MIN_HEX), _steps(content, HEX)).otherwise(none),
    }
    shortest = {"__assign": MIN_ASSIGN, "__access": MIN_ACCESS, "__hex": MIN_HEX}
    stepped = rows.withColumns(steps)
    placed = stepped.withColumns({name: _placed(F.col(name)) for name in steps})
    return placed.withColumns({name: _of_length(F.col(name), least) for name, least in shortest.items()})


def _of_length(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.char_length(s["value"]) >= least)


def _pairs(token: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(token) - 1), lambda i: F.substring(token, i, 2))


def transition_counts(documents: DataFrame, text: str) -> dict[tuple[str, bool], int]:
    """How often one character follows another in random strings and in ordinary identifiers.

    All documents count.  At most 2 x 128 x 128 numbers are returned.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = with_matches(documents.select(content.alias("__text")), "__text")
    random = F.concat(*[F.transform(F.col(c), lambda s: s["value"]) for c in ("__assign", "__access", "__hex")])
    ordinary = F.regexp_extract_all(F.col("__text"), F.lit(ORDINARY), F.lit(0))
    samples = rows.select(F.explode(F.concat(
        F.transform(random, lambda t: F.struct(t.alias("token"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda t: F.struct(t.alias("token"), F.lit(False).alias("random"))))).alias("s"))
    pairs = (samples.select("s.random", "s.token").where(F.char_length("token") > 1)
             .select("random", F.explode(_pairs(F.col("token"))).alias("pair")))
    return {(r["pair"], r["random"]): r["count"] for r in pairs.groupBy("pair", "random").count().collect()}


def ratios(counts: dict[tuple[str, bool], int], smoothing: float = 1.0) -> list[float]:
    """Log-likelihood ratio of every transition, at 128 x first code + second code.

    Without samples of a class its model is uniform; without any, all ratios are 0.
    """
    before = {}
    for (pair, random), n in counts.items():
        before[pair[0], random] = before.get((pair[0], random), 0) + n

    def probability(a: str, b: str, random: bool) -> float:
        return (counts.get((a + b, random), 0) + smoothing) / (before.get((a, random), 0) + smoothing * ALPHABET)

    return [round(math.log(probability(chr(a), chr(b), True) / probability(chr(a), chr(b), False)), 6)
            for a in range(128) for b in range(128)]


def total_ratio(token: Column, table: Column) -> Column:
    """Sum of the ratios of the token's transitions; its characters are ASCII."""
    codes = F.transform(F.split(token, ""), F.ascii)
    return F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), F.when(acc["last"] < 0, acc["sum"]).otherwise(
            acc["sum"] + F.get(table, acc["last"] * 128 + c)).alias("sum")))["sum"]


def scan(documents: DataFrame, *, text: str = "text", min_total: float = MIN_TOTAL, min_ratio: float = MIN_RATIO) -> DataFrame:
    """Secrets of every row; its other columns are kept, those named below replaced.

    n_assign, n_access, n_hex, n_markov: spans per kind; base: the spans of the
    known shapes as (start, kind, stop), ordered; spans: all spans.  Positions
    are code points from 0, stops exclusive.  A scored token that overlaps a
    known shape is not added.

    Null and empty texts have no spans.  Equal texts have equal results; an
    empty table gives an empty result.
    """
    table_values = ratios(transition_counts(documents, text))
    # one constant array, folded when the query is planned
    table = F.split(F.lit(",".join(map(repr, table_values))), ",").cast("array<double>")
    rows = with_matches(documents.withColumn("__text", F.coalesce(F.col(text), F.lit(""))), "__text")

    def of_kind(column: str, kind: int) -> Column:
        return F.transform(F.col(column), lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["stop"].alias("stop"))).cast(_SPAN)

    known = F.array_sort(F.concat(*[of_kind(f"__{k}", i) for i, k in enumerate(KINDS[:3])]))
    content = F.col("__text")
    rows = rows.withColumn("__base", known).withColumn(
        "__steps", F.when(content.rlike(CANDIDATE), _steps(content, CANDIDATE)).otherwise(F.array().cast(_STEP)))
    free = F.filter(_placed(F.col("__steps")), lambda s: ~F.exists(
        F.col("__base"), lambda b: (s["start"] < b["stop"]) & (b["start"] < s["stop"])))
    rows = rows.withColumn("__free", free)
    # a short token needs more per transition than a long one to say as much in all
    scored = F.filter(F.col("__free"), lambda s: total_ratio(s["hit"], table) >= F.greatest(
        F.lit(min_total), min_ratio * (F.char_length(s["hit"]) - 1)))
    rows = rows.withColumn("__markov", scored)
    result = {f"n_{k}": F.size(f"__{k}").cast("bigint") for k in KINDS}
    result |= {"base": F.col("__base"), "spans": F.array_sort(F.concat(F.col("__base"), of_kind("__markov", 3)))}
    kept = [c for c in documents.columns if c not in result]
    return rows.select(*kept, *[value.alias(name) for name, value in result.items()])


def as_text(spans: Column) -> Column:
    """Spans as kind:start:stop, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
