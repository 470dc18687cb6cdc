"""The review table: a stored base plus append-only updates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clockwright import settings
from clockwright.errors import LookupFailed
from clockwright.operators.quality import require_single_rows

#: ranges of scores that are counted to find a page
SCORE_RANGES = 256

REVIEW_COLUMNS = (
    "punch_id", "shift_id", "employee_id", "department_id", "clock_in", "anomaly_score",
    "predicted_anomaly", "reason_hint", "review_status", "reviewer_notes",
)


def seed(scores: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Base rows after seeding: known punches stay as they are, new ones start as pending.

    punch_id is the table's key: a new punch that occurs twice is an error.
    """
    fresh = scores if existing is None else scores.join(existing.select("punch_id"), "punch_id", "left_anti")
    require_single_rows({"scores": fresh}, "punch_id")
    rows = fresh.withColumns({
        "review_status": F.lit(settings.REVIEW_STATUSES[0]),
        "reviewer_notes": F.lit(None).cast("string"),
    }).select(*REVIEW_COLUMNS)
    return rows if existing is None else existing.select(*REVIEW_COLUMNS).unionByName(rows)


def update_problem() -> Column:
    """Why an update is refused; NULL for a valid one."""
    known = F.coalesce(F.col("review_status").isin(*settings.REVIEW_STATUSES), F.lit(False))
    return (
        F.when(~known, "unknown_review_status")
        .when(F.length("reviewer_notes") > settings.MAX_NOTE_LENGTH, "notes_too_long")
    )


def checked_updates(updates: DataFrame) -> DataFrame:
    return updates.withColumn("problem", update_problem())


def unknown_updates(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of punches that are not in the review table."""
    return updates.join(base.select("punch_id"), "punch_id", "left_anti")


def apply_updates(base: DataFrame, updates: DataFrame) -> DataFrame:
    """The review table with the last valid update per punch.

    Status and notes travel together, so an update without notes clears them.
    The last update is found by a map-side-combined aggregate.
    """
    last = (
        updates.where(update_problem().isNull())
        .groupBy("punch_id")
        .agg(F.max_by(F.struct("review_status", "reviewer_notes"), F.struct("updated_at", "seq")).alias("__last"))
    )
    def latest(name: str) -> Column:
        return F.when(F.col("__last").isNotNull(), F.col(f"__last.{name}")).otherwise(F.col(name)).alias(name)
    return base.join(last, "punch_id", "left").select(
        *[c for c in REVIEW_COLUMNS if c not in ("review_status", "reviewer_notes")],
        latest("review_status"), latest("reviewer_notes"),
    )


def filtered(view: DataFrame, *, flagged_only: bool = True, review_status: str | None = None,
             department_id: str | None = None) -> DataFrame:
    """Conjunction of the given filters; empty text means no filter."""
    conditions = []
    if flagged_only:
        conditions.append(F.col("predicted_anomaly"))
    if review_status:
        conditions.append(F.col("review_status") == review_status)
    if department_id:
        conditions.append(F.col("department_id") == department_id)
    return reduce(DataFrame.where, conditions, view)


def total(view: DataFrame) -> DataFrame:
    return view.agg(F.count(F.lit(1)).alias("total"))


def page(view: DataFrame, *, limit: int = settings.PAGE_LIMIT_DEFAULT, offset: int = 0) -> DataFrame:
    """Highest scores first, punch_id on ties."""
    if not 1 <= limit <= settings.PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be within 1..{settings.PAGE_LIMIT_MAX}")
    if offset < 0:
        raise ValueError("offset cannot be negative")
    return view.orderBy(F.col("anomaly_score").desc(), F.col("punch_id")).offset(offset).limit(limit)


@dataclass(frozen=True)
class ScoreRanges:
    """How many records lie in each range of scores, highest range first; a range ends below the one before."""

    lows: tuple[float, ...]
    rows: tuple[int, ...]

    @staticmethod
    def of(view: DataFrame, ranges: int = SCORE_RANGES) -> ScoreRanges:
        """Borders by approximate quantiles, counts exact; at most ``ranges`` numbers reach the driver."""
        shares = [i / ranges for i in range(1, ranges)]
        borders = sorted(set(view.agg(F.percentile_approx("anomaly_score", shares, 100 * ranges)).first()[0] or []))
        lows = [float("-inf"), *borders]
        number = F.size(F.filter(F.array(*map(F.lit, lows)), lambda low: low <= F.col("anomaly_score"))) - 1
        counts = {r["number"]: r["count"] for r in view.groupBy(number.alias("number")).count().collect()}
        return ScoreRanges(tuple(reversed(lows)), tuple(counts.get(n, 0) for n in reversed(range(len(lows)))))

    def spanning(self, offset: int, limit: int) -> tuple[float, float, int]:
        """(low, high, skip): the scores that hold the page, high excluded, and the records of theirs before it."""
        high, before = float("inf"), 0
        at = 0
        while at < len(self.rows) and before + self.rows[at] <= offset:
            before, high, at = before + self.rows[at], self.lows[at], at + 1
        low, reach = high, before
        while at < len(self.rows) and reach < offset + limit:
            reach, low, at = reach + self.rows[at], self.lows[at], at + 1
        return low, high, offset - before


def page_within(view: DataFrame, ranges: ScoreRanges, *, limit: int = settings.PAGE_LIMIT_DEFAULT,
                offset: int = 0) -> DataFrame:
    """The same page as ``page``, found by counts: only the score ranges that hold it are read and ordered.

    ``ranges`` are those of ``view`` and serve all its pages.
    """
    low, high, skip = ranges.spanning(offset, limit)
    score = F.col("anomaly_score")
    return page(view.where((score >= F.lit(low)) & (score < F.lit(high))), limit=limit, offset=skip)


def page_after(view: DataFrame, score: float, punch_id: str, *, limit: int = settings.PAGE_LIMIT_DEFAULT) -> DataFrame:
    """The page that follows the record with this score and punch_id; nothing before it is ordered."""
    lower = F.col("anomaly_score") < F.lit(score)
    tied = (F.col("anomaly_score") == F.lit(score)) & (F.col("punch_id") > F.lit(punch_id))
    return page(view.where(lower | tied), limit=limit)


def listing(view: DataFrame, *, flagged_only: bool = True, review_status: str | None = None,
            department_id: str | None = None, limit: int = settings.PAGE_LIMIT_DEFAULT, offset: int = 0) -> dict:
    """One page of records (at most 200) and the total under the same filters."""
    rows = filtered(view, flagged_only=flagged_only, review_status=review_status, department_id=department_id)
    items = [r.asDict() for r in page(rows, limit=limit, offset=offset).collect()]
    return {"items": items, "total": total(rows).first().total, "limit": limit, "offset": offset}


def get(view: DataFrame, punch_id: str) -> dict:
    row = view.where(F.col("punch_id") == punch_id).first()
    if row is None:
        raise LookupFailed(f"anomaly record not found: {punch_id}")
    return row.asDict()


def get_many(view: DataFrame, requests: DataFrame) -> DataFrame:
    """Look-ups for a table of requested punch_ids; ``found`` is false for unknown ones."""
    wanted = requests.select("punch_id").distinct()
    return wanted.join(view.withColumn("found", F.lit(True)), "punch_id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


def summary(view: DataFrame) -> DataFrame:
    """Total, flagged, pending and confirmed records in one scan.  Pending counts unflagged rows too."""
    return view.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("predicted_anomaly").alias("flagged_records"),
        F.count_if(F.col("review_status") == "pending").alias("pending_reviews"),
        F.count_if(F.col("review_status") == "confirmed_issue").alias("confirmed_issues"),
    )
