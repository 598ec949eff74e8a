"""Cleaning expressions on literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from gondola.functions import cleaning
from gondola.functions.columns import contains_text


def values(spark, items, column):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("x"))).collect()]


def test_strip_is_python_strip(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    items = [f"{s}a b{s}" for s in spaces] + ["​x​", "", "   "]
    assert values(spark, items, cleaning.stripped) == [item.strip() for item in items]


def test_text(spark):
    items = [" a ", "", " ", "nan", " None ", "NaN", None, "Nan\t"]
    assert values(spark, items, cleaning.text_or_null) == ["a", None, None, None, None, "NaN", None, "Nan"]


@pytest.mark.parametrize(
    "text, number",
    [
        ("1234.56", 1234.56),
        ("1.234,56", 1234.56),
        ("1,234.56", 1.23456),
        ("1.234", 1.234),
        (" 7,5\t", 7.5),
        ("-3", -3.0),
        ("+1e3", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1d", None),
        ("1f", None),
        ("0x10", None),
        ("1 2", None),
        ("1,2,3", None),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_number(spark, text, number):
    assert values(spark, [text], cleaning.number_or_null) == [number]


def test_timestamp(spark):
    found = values(
        spark, ["2026-05-23T04:00:00-0300", "2026-05-23", "ayer", None], lambda c: cleaning.timestamp_or_null(c).cast("string")
    )
    assert found == ["2026-05-23 07:00:00", "2026-05-23 00:00:00", None, None]


def test_identifier_rejects_a_trailing_newline_inside(spark):
    assert values(spark, ["12", " 12 ", "12\n", "1\n2", "12a", ""], cleaning.is_identifier) == [
        True, True, True, False, False, False,
    ]


def test_footer(spark):
    items = ["Última actualización: hoy", "ULTIMA ACTUALIZACION", " última Actualizacion x", "1", "otra última actualización"]
    assert values(spark, items, lambda c: cleaning.is_footer(F.array(c))) == [True, True, True, False, False]


def test_publication_date(spark):
    names = ["2026-05-23/a.zip", "x_2026-05-23.zip", "2026-02-30/2026-03-01.zip", "a.zip"]
    day = datetime.date(2026, 5, 23)
    assert values(spark, names, cleaning.publication_date) == [day, day, None, None]


def test_text_search(spark):
    items = ["Leche 100%", "LECHE", "a\\b", "A_B", None, "x"]
    assert values(spark, items, lambda c: F.coalesce(contains_text("x", " leche "), F.lit(False))) == [
        True, True, False, False, False, False,
    ]
    assert values(spark, items, lambda c: contains_text("x", "a\\b")) == [False, False, True, False, None, False]
    assert values(spark, items, lambda c: contains_text("x", "a_b")) == [False, False, True, True, None, False]
