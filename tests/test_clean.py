from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelmart.functions import calendar as cal
from parcelmart.functions import clean, numeric


def apply(spark, texts, rule):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("t"))).collect()]


def test_singularize(spark):
    words = ["batteries", "classes", "clothes", "bags", "glass", "ies", "", None]
    assert apply(spark, words, clean.singularize) == ["battery", "class", "clothes", "bag", "glass", "ies", "", None]


def test_category(spark):
    words = ["  Toy  Bags ", "Electronics", "BAG", " ", "", None, "\tshoes\n", "bags\u00a0", "toy\u2003bags"]
    expected = ["toybag", "electronic", "bag", None, None, None, "shoes", "bag", "toybag"]
    assert apply(spark, words, clean.normalize_category) == expected


def test_gender(spark):
    words = ["F", "Female", " female ", "M", "male", "x", "", None, "\tF\n", "F\r", "\u00a0m\u3000"]
    assert apply(spark, words, clean.normalize_gender) == ["F", "F", "F", "M", "M", None, None, None, "F", "F", "M"]


def test_clean_text(spark):
    words = [" a ", "nan", " NaT", "None ", "  ", None]
    assert apply(spark, words, clean.clean_text) == ["a", None, None, None, None, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05", date(2024, 1, 5)),
        (" 2024-01-05 ", date(2024, 1, 5)),
        ("1/5/2024", date(2024, 1, 5)),
        ("01/05/2024", date(2024, 1, 5)),
        ("2024-01-05 10:30:00", date(2024, 1, 5)),
        ("2024-01-05T23:30:00-05:00", date(2024, 1, 6)),
        ("2024/01/05", date(2024, 1, 5)),
        ("Jan 5, 2024", date(2024, 1, 5)),
        ("1/5/2024 10:30:00", date(2024, 1, 5)),
        ("2024-1-5", date(2024, 1, 5)),
        ("\t1/5/2024\n", date(2024, 1, 5)),
        ("20240105", date(2024, 1, 5)),
        ("January 5, 2024", date(2024, 1, 5)),
        ("5 Jan 2024", date(2024, 1, 5)),
        ("1/1/20241", None),
        ("2024/1/123", None),
        ("0024-01-05", None),
        ("9024-01-05", None),
        ("13/45/2024", None),
        ("2024-02-30", None),
        ("12:30:00", None),
        ("nan", None),
        ("NaT", None),
        ("", None),
        (None, None),
    ],
)
def test_mixed_date(spark, text, expected):
    assert apply(spark, [text], clean.parse_mixed_date) == [expected]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 8),)], "d date")
    got = [tuple(r) for r in df.select(*cal.calendar_attrs(F.col("d"))).collect()]
    assert got == [(20240106, 2024, 1, 1, 6, 5, True), (20240108, 2024, 1, 1, 8, 0, False)]


def test_labels(spark):
    df = spark.createDataFrame([(2024, 3), (2024, 0), (2024, None)], "y int, m int")
    assert [r[0] for r in df.select(cal.period_label(F.col("y"), F.col("m"))).collect()] == ["2024-03", "2024", "2024"]
    assert cal.prev_quarter(2025, 1) == (2024, 4) and cal.prev_quarter(2025, 3) == (2025, 2)
    assert cal.date_text_to_id("2024-01-31") == 20240131


@pytest.mark.parametrize(
    "cur, prev, expected",
    [("200", "100", "100.00"), ("50", "100", "-50.00"), ("1", "3", "-66.67"), ("5", "0", None), ("5", None, None),
     ("100.25", "200", "-49.88"), ("2.005", "2", "0.50")],
)
def test_growth(spark, cur, prev, expected):
    df = spark.createDataFrame([(cur, prev)], "c string, p string")
    money = [F.col(x).cast("decimal(18,2)") for x in "cp"]
    got = df.select(numeric.growth_pct(*money).cast("string")).first()[0]
    assert got == expected


def test_mean_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST(0.05 AS DECIMAL(18,2)) AS pos, CAST(-0.05 AS DECIMAL(18,2)) AS neg, 0L AS none")
    row = df.select(
        numeric.rounded_mean(F.col("pos"), F.lit(2)).cast("string"),
        numeric.rounded_mean(F.col("neg"), F.lit(2)).cast("string"),
        numeric.rounded_mean(F.col("pos"), F.col("none")),
    ).first()
    assert tuple(row) == ("0.03", "-0.03", None)


def test_numbers_and_money_text(spark):
    assert apply(spark, ["1.5", "x", None], lambda c: numeric.to_number(c, 0.0)) == [1.5, 0.0, 0.0]
    assert apply(spark, ["1.5", "x"], numeric.to_number) == [1.5, None]
    assert apply(spark, ["1234567.5", None], lambda c: numeric.money_text(c)) == ["1,234,567.50", ""]


def test_fallback_formats_are_a_parameter(spark):
    rule = lambda c: clean.parse_mixed_date(c, ["dd.MM.yyyy"])
    assert apply(spark, ["05.01.2024", "Jan 5, 2024", "2024-01-05"], rule) == [date(2024, 1, 5), None, date(2024, 1, 5)]


def test_parameter_dates():
    assert cal.date_text_to_id("2024-1-5") == cal.date_text_to_id("2024-01-05") == 20240105
    with pytest.raises(ValueError):
        cal.date_text_to_id("2024-13-01")
