"""Column helpers on literal values: nulls, no match, ties, leap days, zero divisors."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text


def values(spark, kind, items, column):
    frame = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i int, v {kind}")
    return [row.r for row in frame.select("i", column.alias("r")).orderBy("i").collect()]


def day(text_):
    return datetime.date.fromisoformat(text_)


@pytest.mark.parametrize("op, value, expected", [("==", 2, "nyn"), ("<", 2, "ynn"), ("<=", 2, "yyn"), (">", 2, "nny"), (">=", 2, "nyy"), ("in", [1, 3], "yny")])
def test_if_else(spark, op, value, expected):
    assert "".join(values(spark, "int", [1, 2, 3], predicates.if_else("v", value, "y", "n", op))) == expected
    assert values(spark, "int", [None], predicates.if_else("v", value, "y", "n", op)) == ["n"]


def test_unknown_operator():
    with pytest.raises(NotImplementedError):
        predicates.predicate("v", "!=", 1)


def test_branches(spark):
    v = F.col("v")
    assert values(spark, "int", [1, 5, 9, None], predicates.first_match([(v < 5, "a"), (v < 9, "b")])) == ["a", "b", None, None]
    assert values(spark, "int", [1, 0, None], predicates.three_state(v == 1, v == 0)) == [True, False, None]
    assert values(spark, "int", [0, 9, 10, 99, None], predicates.banded("v", [(None, 9, "low"), (10, 50, "mid")], "else")) == ["low", "low", "mid", "else", "else"]
    assert values(spark, "int", [1, 5, None], predicates.below("v", [(5, "s")], "l")) == ["s", "l", "l"]
    assert values(spark, "string", ["a", "z", None], predicates.replace_values("v", {"a": "b", "b": "c"})) == ["b", "z", None]
    assert values(spark, "string", ["a", None], predicates.label_null("v", F.upper("v"))) == ["A", "Not provided"]


def test_extraction(spark):
    assert values(spark, "string", ["ab12", "none", None], text.extract("v", r"(\d+)")) == ["12", None, None]
    assert values(spark, "string", ["a1b22", "x"], text.extract_all("v", r"\d+")) == [["1", "22"], []]


def test_replacement(spark):
    assert values(spark, "string", ["1,234,5", "7", None], text.replace_first("v", ",", "")) == ["1234,5", "7", None]
    assert values(spark, "string", ["a$b$", "x"], text.replace_first("v", "$", "\\$1")) == ["a\\$1b$", "x"]
    fixes = [("Math", "Mathematics"), ("Engish", "English")]
    assert values(spark, "string", ["Math", "Engish Math", "Art", "", None], text.replace_texts("v", fixes)) == ["Mathematics", "English Mathematics", "Art", "", None]
    assert values(spark, "string", ["ab"], text.replace_texts("v", [("a", "b"), ("b", "c")])) == ["bc"]


def test_trimming_and_padding(spark):
    assert values(spark, "string", ["1.5M", "MM", "7"], text.strip_end("v", "KMB")) == ["1.5", "", "7"]
    assert values(spark, "string", ["$1$", "1"], text.strip_prefix("v", "$")) == ["1$", "1"]
    assert values(spark, "string", ["7", "12345", None], text.pad_left("v", 3)) == ["007", "12345", None]
    frame = spark.createDataFrame([(" a ", 1)], "`x y` string, n int")
    assert rows(text.trim_strings(frame)) == [("a", 1)]


def test_parts_and_names(spark):
    assert values(spark, "string", ["a_b", "a", None], text.part("v", "_", 1)) == ["b", None, None]
    assert values(spark, "string", ["A", None], text.email("v", F.lit("B"), F.lit("C"))) == ["a.b@c.com", None]
    assert values(spark, "string", ["1.2|x"], text.part("v", "|", 0)) == ["1.2"]


def test_amounts(spark):
    assert values(spark, "string", ["$1.5M", "2K", "$3B", "17", None, "n"], amounts.parse_amount("v")) == [1_500_000, 2_000, 3_000_000_000, 17, None, None]
    assert values(spark, "string", ["1,250K", "3M", "1,000"], amounts.parse_grouped_amount("v")) == [1_250_000, 3_000_000, 1_000]
    assert values(spark, "string", ["$12.5", "3"], amounts.parse_price("v")) == [12.5, 3.0]
    assert values(spark, "double", [4.0, 0.0, None], amounts.ratio(F.lit(2), "v")) == [0.5, None, None]


@pytest.mark.parametrize(
    "layout, written",
    [
        ("iso", "2023-02-01"), ("month_first", "2/1/2023"), ("day_first", "01/02/2023"), ("day_short_month", "01-Feb-2023"),
        ("day_long_month", "1-February-2023"), ("month_first_short_year", "02-01-23"), ("joined_long_month", "01February2023"),
        ("written", "Wednesday, 01 February, 2023"), ("written", "1 February, 2023"),
    ],
)
def test_date_layouts(spark, layout, written):
    assert values(spark, "string", [written, None], dates.parse_date("v", layout)) == [day("2023-02-01"), None]


def test_short_years_run_from_1969(spark):
    assert values(spark, "string", ["12-31-68", "01-01-69"], dates.parse_date("v", "month_first_short_year")) == [day("2068-12-31"), day("1969-01-01")]


def test_date_parts(spark):
    days = [day("2024-01-01"), day("2024-01-07"), None]
    assert values(spark, "date", days, dates.weekday_number("v")) == [1, 7, None]
    assert values(spark, "date", days, dates.weekday_name("v")) == ["Monday", "Sunday", None]
    assert values(spark, "date", days, dates.month_year("v", "MMM-yy")) == ["Jan-24", "Jan-24", None]
    assert values(spark, "date", [day(f"2024-{m:02}-01") for m in (1, 4, 7, 10)], dates.fiscal_quarter("v")) == [3, 4, 1, 2]


def test_anniversary_of_leap_day(spark):
    found = values(spark, "date", [day("2012-02-29"), day("2012-03-01"), None], dates.anniversary("v", 2022))
    assert found == [None, day("2022-03-01"), None]
    assert values(spark, "date", [day("2012-02-29")], dates.anniversary("v", 2024)) == [day("2024-02-29")]


def test_spans(spark):
    start = F.lit(day("2020-01-01"))
    ends = [day("2021-01-01"), day("2020-12-31"), day("2019-12-31")]
    assert values(spark, "date", ends, dates.whole_years_between(start, "v")) == [1, 0, -1]
    assert values(spark, "date", ends, dates.whole_months_between(start, "v")) == [12, 11, -1]
    assert values(spark, "date", [day("2019-05-01"), day("2021-05-01"), None], dates.earliest(start, "v")) == [day("2019-05-01"), day("2020-01-01"), day("2020-01-01")]


def test_times_and_school_years(spark):
    assert values(spark, "string", ["9:05", "23:59", "24:00", "x", None], dates.time_of_day("v")) == ["09:05:00", "23:59:00", None, None, None]
    born = [day("2014-09-01"), day("2014-08-31"), day("2011-09-01"), day("2011-08-31"), None]
    assert values(spark, "date", born, dates.academic_year("v")) == [1, 2, 4, None, None]
