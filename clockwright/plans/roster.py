"""Expected shifts of active employees.

Days are bits: 64 to a word, words numbered from 1970.  A schedule is a few
words that the driver knows, the days an employee worked are or-ed together per
word, and what is left of a schedule is an and-not.  Days become rows only at the end.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clockwright import settings
from clockwright.functions.times import shift_interval


def _day_list(first: date, last: date) -> Column:
    if last < first:
        raise ValueError(f"the range of days is reversed: {first} to {last}")
    return F.sequence(F.lit(first), F.lit(last))


def calendar_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(_day_list(first, last)).alias("day"))


_WORD = 64
_EPOCH = date(1970, 1, 1)


def _schedule_bits(first: date, last: date) -> tuple[int, dict[str, list[int]]]:
    """The number of the first word, and the words of each schedule, as signed numbers."""
    if last < first:
        raise ValueError(f"the range of days is reversed: {first} to {last}")
    begin, end = (first - _EPOCH).days, (last - _EPOCH).days
    every_day, weekdays = settings.SCHEDULES
    words = {every_day: [0] * (end // _WORD - begin // _WORD + 1)}
    words[weekdays] = list(words[every_day])
    for number in range(begin, end + 1):
        at, bit = number // _WORD - begin // _WORD, 1 << number % _WORD
        words[every_day][at] |= bit
        if (_EPOCH + timedelta(number)).weekday() < 5:
            words[weekdays][at] |= bit
    signed = {name: [w - (1 << _WORD) if w >> (_WORD - 1) else w for w in bits] for name, bits in words.items()}
    return begin // _WORD, signed


def _days_of(first_word: Column, bits: Column) -> Column:
    """The days of a bitmap, in order."""
    def days(word: Column, number: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)),
                        lambda bit: F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1)
        return F.transform(hits, lambda bit: F.date_from_unix_date(
            ((first_word + number) * _WORD + bit).cast("int")))
    return F.flatten(F.transform(bits, days))


def roster_days(employees: DataFrame, departments: DataFrame, first: date, last: date) -> DataFrame:
    """Active employees with the bitmap of their eligible days (``first_word``, ``free``).

    An unknown department or schedule of an active employee is an error.
    """
    spark = employees.sparkSession
    first_word, schedules = _schedule_bits(first, last)
    active = employees.where(F.col("employment_status") == settings.EMPLOYMENT_STATUSES[0])
    schedule = F.coalesce("operating_schedule", F.lit("NULL"))
    unknown = F.raise_error(F.concat(F.lit("unknown operating schedule: "), schedule)).cast("array<bigint>")
    nowhere = F.raise_error(F.concat(F.lit("active employee without a known department: "),
                                     F.coalesce("employee_id", F.lit("NULL")))).cast("string")
    free = unknown
    for name, words in schedules.items():
        free = F.when(F.col("operating_schedule") == name, F.array(*[F.lit(w).cast("bigint") for w in words])).otherwise(free)
    # rows are small now and grow by the days they get: spread them first, by a fixed
    # number of partitions, since adaptive execution would merge them again
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        active.select("employee_id", "department_id")
        .join(departments.select("department_id", "operating_schedule", F.lit(True).alias("__known")),
              "department_id", "left")
        .withColumn("operating_schedule", F.when(F.col("__known"), F.col("operating_schedule")).otherwise(nowhere))
        .drop("__known")
        .repartition(spread, "employee_id")
        .withColumns({"first_word": F.lit(first_word), "free": free})
    )


def roster_slots(roster: DataFrame) -> DataFrame:
    """One row per active employee and eligible day."""
    return roster.select("employee_id", "department_id", "operating_schedule",
                         F.explode(_days_of(F.col("first_word"), F.col("free"))).alias("day"))


def worked_days(shifts: DataFrame) -> DataFrame:
    """(employee_id, worked): a map from the number of a word to the bits of the days with a shift."""
    number = F.unix_date(F.col("scheduled_start").cast("date"))
    days = shifts.where(number.isNotNull()).select(
        "employee_id", F.floor(number / _WORD).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(_WORD))).alias("bit"))
    return (days.groupBy("employee_id", "word").agg(F.bit_or("bit").alias("bits"))
            .groupBy("employee_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("worked")))


def roster_gaps(roster: DataFrame, shifts: DataFrame) -> DataFrame:
    """Slots without a shift of that employee on that day.

    Slots are never shuffled: bitmaps meet, and what is left of them is exploded.
    """
    def left(bits: Column, number: Column) -> Column:
        done = F.coalesce(F.element_at("worked", (F.col("first_word") + number).cast("int")), F.lit(0).cast("bigint"))
        return bits.bitwiseAND(F.bitwise_not(done))

    rest = roster.join(worked_days(shifts), "employee_id", "left").withColumn("free", F.transform("free", left))
    return roster_slots(rest)


def slot_intervals(slots: DataFrame, start_hour: Column | int) -> DataFrame:
    """Slots with planned start and end; evening shifts end on the next day."""
    hour = F.lit(start_hour) if isinstance(start_hour, int) else start_hour
    start, end = shift_interval(F.col("day"), hour, settings.STANDARD_SHIFT_HOURS)
    return slots.withColumns({"scheduled_start": start, "scheduled_end": end})
