import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import (
    email_local_part,
    has_more_than_2_decimals,
    is_not_letters_only,
    parse_day_first_date,
    round_money,
    strip_non_letters,
)
from strata.functions.dates import REFERENCE_DATE_FORMATS

DATE_CASES = [
    ("3/1/2016", dt.date(2016, 1, 3)),
    ("03/1/2016", dt.date(2016, 1, 3)),
    ("03/01/2016", dt.date(2016, 1, 3)),
    ("21/8/2016", dt.date(2016, 8, 21)),
    ("31/2/2016", None),
    ("1/13/2016", None),
    ("2016-01-03", None),
    ("3/1/16", None),
    (" 3/1/2016", None),
    ("03/01/12016", None),
    (None, None),
]


def test_day_first_parse_literal_rows(rows):
    df = rows([(s,) for s, _ in DATE_CASES], "s string")
    got = [r[0] for r in df.select(parse_day_first_date("s")).collect()]
    assert got == [d for _, d in DATE_CASES]


def test_single_format_equals_reference_chain(rows):
    df = rows([(s,) for s, _ in DATE_CASES], "s string")
    out = df.select(parse_day_first_date("s").alias("one"),
                    parse_day_first_date("s", REFERENCE_DATE_FORMATS).alias("chain"))
    assert out.filter(~F.col("one").eqNullSafe(F.col("chain"))).count() == 0


def test_strip_non_letters_and_email_local_part(rows):
    df = rows([("Mary O'Brien 3", "j.doe9@x.com"), (None, "plain"), ("Zoë", None)],
              "name string, email string")
    got = df.select(strip_non_letters("name"), strip_non_letters(email_local_part("email"))).collect()
    assert [tuple(r) for r in got] == [("MaryOBrien", "jdoe"), (None, "plain"), ("Zo", None)]


def test_letters_only_predicate(rows):
    df = rows([("",), ("A b",), ("é",), ("Ab",), (None,)], "n string")
    flagged = [r[0] for r in df.filter(is_not_letters_only("n")).collect()]
    assert flagged == ["", "A b", "é"]


def test_round_money_half_up(rows):
    df = rows([(2.675,), (-2.675,), (1.005,)], "x double")
    got = [r[0] for r in df.select(round_money("x")).collect()]
    assert got == [Decimal("2.68"), Decimal("-2.68"), Decimal("1.01")]


def test_decimal_places_numeric(rows):
    df = rows([(12345678.9,), (1.0e-4,), (1.25,), (1.255,), (None,)], "x double")
    flagged = [r[0] for r in df.filter(has_more_than_2_decimals("x")).collect()]
    # 12345678.9 has one decimal (a string test would read "23456789E7")
    assert flagged == [1.0e-4, 1.255]


def test_decimal_places_on_decimal_and_integer(rows):
    df = rows([(Decimal("1.2300"), 5), (Decimal("1.2345"), 7)], "x decimal(18,4), i int")
    assert df.filter(has_more_than_2_decimals("x")).count() == 1
    assert df.filter(has_more_than_2_decimals("i")).count() == 0
