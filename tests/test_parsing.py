import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from clockwright.errors import ExtractionError
from clockwright.functions import numbers, parsing, text, times
from clockwright.functions.parsing import null_na_tokens
from clockwright.sources.raw import RawPaths, extract_all, read_csv


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_na_tokens(spark):
    table = spark.createDataFrame([(t,) for t in parsing.NA_TOKENS + (" NA ", "na", "0")], "v string")
    kept = [r.v for r in parsing.null_na_tokens(table).collect() if r.v is not None]
    assert kept == [" NA ", "na", "0"]


def test_timestamps(spark):
    good = {"2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30), "2026-01-01T00:00:00": datetime(2026, 1, 1)}
    bad = ["2026-01-01 08:00:00", "2026-01-01T08:00:00.5", "2026-01-01T08:00:00Z", " 2026-01-01T08:00:00",
           "2026-02-30T08:00:00", "2026-01-01T24:00:00", "2026", "2026-01-01", "not-a-time", "", None,
           "2026-01-01T08:00:00\n"]
    assert column(spark, [*good, *bad], parsing.parse_timestamp) == [*good.values(), *[None] * len(bad)]


def test_dates(spark):
    assert column(spark, ["2026-02-28", "2026-02-30", "2026-2-1", None], parsing.parse_date) == [
        date(2026, 2, 28), None, None, None]


def test_rates(spark):
    values = ["12.5", "5d", "0x10", "1e2", " 7 ", "nan", "-3", "inf", "-inf", "", ".5", "7.", None]
    assert column(spark, values, parsing.parse_number) == [
        12.5, None, None, 100.0, 7.0, None, -3.0, float("inf"), float("-inf"), None, 0.5, 7.0, None]
    numeric = [12.5, 0.0, -3.0, float("nan"), None, float("inf")]
    assert column(spark, numeric, parsing.not_positive, "double") == [False, True, True, True, True, False]


def test_flags(spark):
    assert column(spark, ["TRUE", "False", " true", "1", None], parsing.parse_flag) == [True, False, None, None, None]


def test_durations_ignore_daylight_saving(spark):
    table = spark.sql("select timestamp_ntz'2026-03-08 01:30:00' a, timestamp_ntz'2026-03-08 03:30:00' b")
    row = table.select(times.hours_between(F.col("a"), F.col("b")).alias("h"),
                       times.minutes_between(F.col("b"), F.col("a")).alias("m")).first()
    assert (row.h, row.m) == (2.0, -120.0)


def test_week_starts_on_monday(spark):
    table = spark.sql("select explode(array(timestamp_ntz'2026-01-04 23:30:00', timestamp_ntz'2026-01-05 00:00:00')) t")
    assert [r.x for r in table.select(times.week_start(F.col("t")).alias("x")).collect()] == [
        date(2025, 12, 29), date(2026, 1, 5)]


def test_overnight_shift(spark):
    start, end = times.shift_interval(F.lit(date(2026, 1, 3)), F.lit(16), 8)
    row = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (row.s, row.e) == (datetime(2026, 1, 3, 16), datetime(2026, 1, 4))


def test_nearest_minute_rounds_half_to_even(spark):
    table = spark.sql("select timestamp_ntz'2026-01-01 00:00:30' a, timestamp_ntz'2026-01-01 00:01:30' b, "
                      "timestamp_ntz'1969-12-31 23:59:10' c")
    row = table.select(*[times.nearest_minute(F.col(c), F.lit(0.0)).alias(c) for c in "abc"]).first()
    assert row == (datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 2), datetime(1969, 12, 31, 23, 59))


@hyp(max_examples=20, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=50, max_size=50))
def test_money_is_half_up_on_the_decimal_text(spark, values):
    expected = [float(Decimal(str(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert column(spark, values, numbers.money, "double") == expected


@hyp(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(-10**6, 10**6).map(lambda i: i / 16),
                          st.integers(-10**7, 10**7).map(lambda i: (i * 10 + 5) / 10_000)), min_size=60, max_size=60))
def test_three_decimals_as_python_rounds(spark, values):
    assert column(spark, values, numbers.round3, "double") == [round(v, 3) for v in values]


def test_clip(spark):
    assert column(spark, [5.0, -5.0, 15.0], lambda v: numbers.clip(v, 0, 10), "double") == [5.0, 0.0, 10.0]
    with pytest.raises(ValueError):
        numbers.clip(F.lit(1), 10, 0)


def test_identifiers(spark):
    assert column(spark, [1, 42, 999, 12345678], lambda v: numbers.numbered_id("punch", v), "long") == [
        "PCH0000001", "PCH0000042", "PCH0000999", "PCH12345678"]
    for bad in (0, None):
        with pytest.raises(Exception, match="at least 1"):
            column(spark, [bad], lambda v: numbers.numbered_id("employee", v), "long")


def test_non_finite_values(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert column(spark, values, numbers.zero_if_not_finite, "double") == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_first_of_equal_columns_wins(spark):
    table = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 3.0, 3.0), (0.0, -1.0, 5.0)], "a double, b double, c double")
    assert [r.x for r in table.select(numbers.largest_column(("a", "b", "c")).alias("x")).collect()] == ["b", "a", "c"]


def test_json_record(spark):
    table = spark.sql("select timestamp_ntz'2026-03-08 02:30:00' t, cast('nan' as double) x, cast(null as string) s, 1.5D y")
    assert table.select(text.json_record(table).alias("j")).first().j == \
        '{"t":"2026-03-08T02:30:00","x":null,"s":null,"y":1.5}'


def test_triage_text_names_missing_fields(spark):
    table = spark.sql("select 'P1' punch_id, timestamp_ntz'2026-01-01 08:00:00' clock_in")
    lines = table.select(text.triage_text(table).alias("t")).first().t.split("\n")
    assert lines[1] == "punch_id: P1" and "clock_in: 2026-01-01T08:00:00" in lines and lines[-1] == "reason_hint: None"


def test_csv_dialect(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n"x""y",NA, NA \n"two\nlines",1,\n')
    rows = read_csv(spark, str(path), multiline=True).collect()
    assert [tuple(r) for r in rows] == [('x"y', None, " NA "), ("two\nlines", "1", None)]


def test_rows_of_another_width(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,2,3\n4\n"5,5",6\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [
        ("1", "2", "3"), ("4", None, None), ("5,5", "6", None)]
    assert read_csv(spark, str(path)).count() == 3
    path.write_text("a,b,c\n1,2,3\n4,5,6,7\n")
    with pytest.raises(Exception, match="more fields than the header: 4,5,6,7"):
        read_csv(spark, str(path)).select("b").count()
    path.write_text('a b,c.d\n"x, y",NA\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [("x, y", None)]


def test_missing_input(spark, tmp_path):
    with pytest.raises(ExtractionError):
        read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ExtractionError):
        extract_all(spark, RawPaths(*[str(tmp_path / "absent.csv")] * 5))


@pytest.mark.parametrize("block", [24, 200, 1 << 20])
def test_csv_in_blocks_is_what_one_reader_finds(spark, tmp_path, block):
    """Records that cross block borders, and one that is longer than several blocks."""
    rng = random.Random(block)
    folder = tmp_path / "t.csv"
    folder.mkdir()
    rows = []
    for part in range(3):
        text = ["a,b,c"]
        for i in range(20):
            value = "".join(rng.choice(["x", "\n", '""', ",", "yz", "\r\n", " "]) for _ in range(rng.choice([0, 3, 9, 90])))
            text.append(f'{part}.{i},"{value}",{rng.choice(["", "tail", "1"])}')
            rows.append(value)
        (folder / f"p{part}.csv").write_text("\n".join(text) + rng.choice(["", "\n"]), newline="")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        found = read_csv(spark, str(folder), multiline=True)
        got = sorted((tuple(r) for r in found.collect()), key=str)
        if block == 24:
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 50
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
             .csv(str(folder)))
    assert got == sorted((tuple(r) for r in null_na_tokens(whole).collect()), key=str)
    assert len(got) == len(rows) == 60


def test_csv_that_ends_inside_quotes_or_differs_is_refused(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n')
    with pytest.raises(ExtractionError, match="ends inside quotes"):
        read_csv(spark, str(tmp_path / "open.csv"), multiline=True)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two" / "two.csv").write_text("b,a\n4,3\n")
    with pytest.raises(ExtractionError, match="header"):
        read_csv(spark, str(tmp_path / "two"), multiline=True)
    (tmp_path / "wide.csv").write_text('\r\na,b\r\n1,"2\r\n3"\r\n\r\n4\r\n')
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "wide.csv"), multiline=True).collect())) == [
        ("1", "2\r\n3"), ("4", None)]
    (tmp_path / "wider.csv").write_text('a,b\n1,"2\n",3\n')
    with pytest.raises(Exception, match="more fields"):
        read_csv(spark, str(tmp_path / "wider.csv"), multiline=True).collect()
    (tmp_path / "nothing.csv").write_text("")
    with pytest.raises(ExtractionError):
        read_csv(spark, str(tmp_path / "nothing.csv"), multiline=True)


def test_csv_that_would_be_misread_is_refused(spark, tmp_path):
    broken = tmp_path / "broken.csv"
    broken.write_text('a,b,c\n1,"x\ny",3\n')
    with pytest.raises(ExtractionError, match="multiline"):
        read_csv(spark, str(broken))
    assert [tuple(r) for r in read_csv(spark, str(broken), multiline=True).collect()] == [("1", "x\ny", "3")]
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "one.csv").write_text("a,b\n1,2\n")
    (folder / "two.csv").write_text("b,a\n4,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder)).collect()
