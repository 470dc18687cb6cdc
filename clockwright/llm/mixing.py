"""A corpus drawn to target weights of sources, languages and topics.

Iterative proportional fitting rakes the token totals of the cells (source,
language, topic) until the shares of each dimension meet their targets.  A
cell's factor, its raked weight over its tokens, is what its documents are
sampled by, and no document is repeated.  With a share of the tokens to keep, the
factors are scaled to it and probabilities end at 1: what a cell lacks goes to the
others in proportion to their weights, and ``cell_report`` tells how much it is.
Without one, the largest factor is scaled to probability 1, so the expected shares
are the targets exactly, and the rarest cell decides how much is sampled.

Cells are far fewer than documents but may still be many, so raking runs as
Spark aggregates over the stored cells; a sweep is one job.  Each document's
draw depends on its id alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from clockwright.scratch import materialize

DIMENSIONS = ("source", "lang", "topic")
#: digits of the MD5 that make a draw, and decimals of a probability
_DRAW_DIGITS, _DECIMALS = 12, 9
MISSING = "(none)"

#: topics by the first marker that a text holds
TOPICS = (("licence", ("icense", "rights reserved")), ("contact", ("@",)), ("table", (" | ",)), ("loud", ("!!",)))
OTHER_TOPIC = "general"


def topic_of(text: Column) -> Column:
    """A coarse topic from markers in the text; the first topic with a marker wins."""
    chosen = F
    for topic, markers in TOPICS:
        hit = F.lit(False)
        for marker in markers:
            hit = hit | F.contains(text, F.lit(marker))
        chosen = chosen.when(hit, F.lit(topic))
    return chosen.otherwise(F.lit(OTHER_TOPIC))


def token_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("bigint")


@dataclass(frozen=True)
class Targets:
    """Target shares per dimension.

    ``shares`` maps a dimension to {category: weight}; categories that are not
    named get no weight, or with ``keep_unnamed`` the share of the tokens that
    they have, and the named ones divide the rest.  A dimension that is not in ``shares`` is tempered: a
    category's target is its token total to the power ``temper``, so 1 leaves
    it as it is and 0 makes all categories equal.
    """

    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    temper: float = 0.7
    keep_unnamed: bool = False

    def of(self, cells: DataFrame, dimension: str) -> DataFrame:
        """(category, target): shares that sum to 1 over the categories that hold tokens."""
        totals = cells.groupBy(dimension).agg(F.sum("tokens").alias("total"))
        if dimension in self.shares:
            given = F.create_map(*[F.lit(x) for pair in self.shares[dimension].items() for x in pair])
            named = F.try_element_at(given, F.col(dimension)).cast("double")
            if self.keep_unnamed:
                return _with_unnamed(totals.where("total > 0").select(
                    F.col(dimension).alias("category"), named.alias("weight"), F.col("total").cast("double").alias("total")))
            weight = F.coalesce(named, F.lit(0.0))
        else:
            weight = F.pow(F.col("total").cast("double"), F.lit(self.temper))
        weighed = totals.where("total > 0").select(F.col(dimension).alias("category"), weight.alias("weight"))
        whole = weighed.agg(F.sum("weight").alias("whole"))
        return weighed.crossJoin(F.broadcast(whole)).select(   # one row
            "category", F.when(F.col("whole") > 0, F.col("weight") / F.col("whole")).otherwise(F.lit(0.0)).alias("target"))


def _with_unnamed(weighed: DataFrame) -> DataFrame:
    """(category, target): categories without weight keep their share of the totals, the others divide the rest."""
    unnamed = F.col("weight").isNull()
    sums = weighed.agg(F.sum("weight").alias("whole"), F.sum("total").alias("all"),
                       F.coalesce(F.sum(F.when(unnamed, F.col("total"))), F.lit(0.0)).alias("rest"))
    kept = F.when(F.col("whole") > 0, F.col("rest") / F.col("all")).otherwise(F.lit(1.0))
    named = F.when(F.col("whole") > 0, F.col("weight") / F.col("whole") * (1 - kept)).otherwise(F.lit(0.0))
    return weighed.crossJoin(F.broadcast(sums)).select(   # one row
        "category", F.when(unnamed, F.col("total") / F.col("rest") * kept).otherwise(named).alias("target"))


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens and documents per cell of prepared rows."""
    return rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, sweeps: int, tolerance: float) -> DataFrame:
    """Add ``weight``: token shares fitted to the targets of each dimension in turn.

    Stops when no share is off by more than ``tolerance`` after a sweep, or
    after ``sweeps``.  Cells without tokens, or of a category without target,
    get weight 0; if targets contradict each other, the last dimension holds.
    Targets are joined once, before the first sweep, so that a sweep joins the
    shares alone: every small table joined is held by the driver for a while.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    fitted = cells.withColumn("weight", F.col("tokens") / F.lit(float(total or 1)))
    for dimension in DIMENSIONS:
        wanted = targets[dimension].select(F.col("category").alias("__of"), F.col("target").alias(_target(dimension)))
        fitted = fitted.join(wanted, F.col(dimension) == F.col("__of"), "left").drop("__of")
    fitted = materialize(fitted, "targeted")
    for _ in range(sweeps):
        for dimension in DIMENSIONS:
            shares = fitted.groupBy(F.col(dimension).alias("__of")).agg(F.sum("weight").alias("__share"))
            factor = (F.when(F.col("__share") > 0, F.coalesce(_target(dimension), F.lit(0.0)) / F.col("__share"))
                      .otherwise(F.lit(0.0)))
            fitted = (fitted.join(shares, F.col(dimension) == F.col("__of"))
                      .withColumn("weight", F.col("weight") * factor).drop("__of", "__share"))
        fitted = materialize(fitted, "raked")
        if _worst_gap(fitted) <= tolerance:
            break
    return fitted.drop(*map(_target, DIMENSIONS))


def _target(dimension: str) -> str:
    return f"__target_{dimension}"


def _worst_gap(fitted: DataFrame) -> float:
    """The largest difference between a raked share and its target, which cells carry."""
    categories = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("category"),
                                    F.coalesce(_target(d), F.lit(0.0)).alias("target")) for d in DIMENSIONS])
    shares = (fitted.select("weight", F.inline(categories)).groupBy("dimension", "category")
              .agg(F.sum("weight").alias("share"), F.max("target").alias("target")))
    return shares.agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0] or 0.0


def draw_of(key: Column, seed: int) -> Column:
    """A number in [0, 1) from an id, the same in any engine; null ids draw as the empty text."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":mix:{seed}"))), 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16 ** _DRAW_DIGITS))


def _described(documents: DataFrame, topic: Column | None) -> dict[str, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return {"source": F.coalesce(F.col("source").cast("string"), F.lit(MISSING)),
            "lang": F.coalesce(F.col("lang").cast("string"), F.lit(MISSING)),
            "topic": topic_of(text) if topic is None else topic}


def _scale_for(cells: DataFrame, share: float) -> float:
    """What factors are multiplied by so that probabilities, 1 at most, are expected to keep ``share`` of the tokens.

    Cells at probability 1 give what they hold, and the others make up for them;
    each step puts more cells at 1, until none follows.
    """
    whole = cells.agg(F.sum("tokens")).first()[0] or 0
    scale, full_before = 0.0, -1
    while True:
        full = F.col("factor") * F.lit(scale) >= 1
        found = cells.where("factor > 0").agg(
            F.sum(F.when(full, F.col("tokens"))).alias("given"), F.count_if(full).alias("full"),
            F.sum(F.when(~full, F.col("factor") * F.col("tokens"))).alias("open")).first()
        if found["full"] == full_before or not found["open"]:
            return scale
        full_before = found["full"]
        scale = max(scale, (share * whole - (found["given"] or 0)) / found["open"])


def calibrate(documents: DataFrame, targets: Targets, *, topic: Column | None, sweeps: int,
              tolerance: float, share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without texts, probability per cell with its tokens and the tokens it lacks)."""
    if share is not None and not 0 < share <= 1:
        raise ValueError("the share to keep must be above 0 and at most 1")
    rows = materialize(documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[value.alias(name) for name, value in _described(documents, topic).items()],
        token_count(F.coalesce(F.col("text"), F.lit(""))).alias("tokens")), "mix-rows")
    cells = materialize(cells_of(rows), "mix-cells")
    wanted = {d: materialize(targets.of(cells, d), f"target-{d}") for d in DIMENSIONS}
    fitted = rake(cells, wanted, sweeps=sweeps, tolerance=tolerance)
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    if share is None:
        largest = fitted.agg(F.max(factor)).first()[0] or 1.0
        wish = factor / F.lit(largest)
    else:
        wish = factor * F.lit(_scale_for(fitted.withColumn("factor", factor), share))
    return rows, materialize(
        fitted.select(*DIMENSIONS, F.round(F.least(wish, F.lit(1.0)), _DECIMALS).alias("probability"), "tokens", "documents",
                      (F.greatest(wish - 1, F.lit(0.0)) * F.col("tokens")).alias("lacking")), "mix-factors")


def probabilities(documents: DataFrame, targets: Targets = Targets(), *, topic: Column | None = None, seed: int = 0,
                  sweeps: int = 20, tolerance: float = 1e-6, share: float | None = None) -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, probability, sampled.

    A null source or language is a category of its own, ``(none)``.  Null and
    empty texts hold no tokens and are sampled with the probability of their
    cell; cells without tokens or target have probability 0.  Repeated ids draw
    alike.  Without documents, or when no category has a target, nothing is
    sampled.  Other columns are not read.  ``share`` is the part of all tokens
    that is expected to stay, as far as cells with a target hold as many.
    """
    rows, cells = calibrate(documents, targets, topic=topic, sweeps=sweeps, tolerance=tolerance, share=share)
    return rows.join(cells.drop("tokens"), list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "tokens", "probability",
        (draw_of(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"))


def cell_report(documents: DataFrame, targets: Targets = Targets(), *, topic: Column | None = None, sweeps: int = 20,
                tolerance: float = 1e-6, share: float | None = None) -> DataFrame:
    """Per cell: source, lang, topic, probability, tokens, documents, lacking.

    lacking is how many tokens more than the cell holds its scaled weight asks for.
    """
    return calibrate(documents, targets, topic=topic, sweeps=sweeps, tolerance=tolerance, share=share)[1]


#: cells that a broadcast may hold; a larger table is joined by shuffling
MAX_BROADCAST_CELLS = 50_000


def sample(documents: DataFrame, targets: Targets = Targets(), *, topic: Column | None = None, seed: int = 0,
           sweeps: int = 20, tolerance: float = 1e-6, share: float | None = None) -> DataFrame:
    """The rows of ``documents`` that ``probabilities`` samples, with all their columns.

    Each row has the probability of its own cell, whatever others have its id.
    A table of few cells is broadcast, so texts do not move.
    """
    _, cells = calibrate(documents, targets, topic=topic, sweeps=sweeps, tolerance=tolerance, share=share)
    cells = cells.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.col("probability").alias("__probability"))
    small = cells.count() <= MAX_BROADCAST_CELLS
    own = {f"__own_{name}": value for name, value in _described(documents, topic).items()}
    same = [F.col(f"__own_{d}") == F.col(f"__{d}") for d in DIMENSIONS]
    drawn = draw_of(F.col("doc_id").cast("bigint"), seed) < F.col("__probability")
    return (documents.withColumns(own).join(F.broadcast(cells) if small else cells, same).where(drawn)
            .select(*[F.col(c) for c in documents.columns]))
