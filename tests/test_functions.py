"""Scalar functions on the edge values of FIXTURES.md section 4."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from stratum.functions import (
    email_ok,
    not_blank,
    not_null,
    not_sentinel,
    parse_date,
    parse_int,
    parse_money,
    phone_ok,
    present,
    strip_chars,
)
from stratum.functions.values import DATE_ISO


def one_col(spark, values, expr_fn, name="v"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr_fn(name)).collect()]


def test_parse_date_day_first_lenient(spark):
    vals = ["08-01-2026 14:00", "08-01-2026 14:00:05", "2026-01-08 14:00:00", "8-1-2026 14:00",
            "31-02-2026 10:00", "", None]
    assert one_col(spark, vals, parse_date) == [dt.date(2026, 1, 8)] + [None] * 6


@pytest.mark.parametrize("bad", ["08-01-2026 14:00:05", "2026-01-08 14:00:00", "31-02-2026 10:00", ""])
def test_parse_date_strict_raises(spark, bad):
    with pytest.raises(Exception):
        one_col(spark, [bad], lambda c: parse_date(c, strict=True))


def test_parse_date_strict_good_and_null(spark):
    assert one_col(spark, ["08-01-2026 14:00", None], lambda c: parse_date(c, strict=True)) == [
        dt.date(2026, 1, 8), None]


def test_parse_date_iso(spark):
    assert one_col(spark, ["2026-01-08 14:00:00", "08-01-2026 14:00"], lambda c: parse_date(c, DATE_ISO)) == [
        dt.date(2026, 1, 8), None]


def test_strip_chars(spark):
    assert one_col(spark, ["$44,196.98", "$1,000,000.00", None], strip_chars) == ["44196.98", "1000000.00", None]


def test_parse_money_values(spark):
    vals = ["$44,196.98", "$48604.41", "-$5.00", "$ 12.5 ", "1e3", "1.005", "2.675"]
    want = ["44196.98", "48604.41", "-5.00", "12.50", "1000.00", "1.01", "2.68"]
    assert one_col(spark, vals, parse_money) == [Decimal(w) for w in want]


def test_parse_money_malformed_lenient(spark):
    assert one_col(spark, ["($5.00)", "€5", "abc", "", "$99999999999999.99"], parse_money) == [None] * 5


def test_parse_money_precision_18_fits(spark):
    assert one_col(spark, ["$99999999999999.99"], lambda c: parse_money(c, 18)) == [Decimal("99999999999999.99")]


@pytest.mark.parametrize("bad", ["($5.00)", "abc", "$99999999999999.99"])
def test_parse_money_strict_raises(spark, bad):
    with pytest.raises(Exception):
        one_col(spark, [bad], lambda c: parse_money(c, strict=True))


def test_parse_int(spark):
    assert one_col(spark, ["7", " 7 ", "7.9", "x", "3000000000", None], parse_int) == [7, 7, None, None, None, None]
    with pytest.raises(Exception):
        one_col(spark, ["7.9"], lambda c: parse_int(c, strict=True))


def test_phone_pattern(spark):
    vals = ["555-1234", "-", "555-1234\n", "+1 555", "", None]
    assert one_col(spark, vals, phone_ok) == [True, True, True, False, False, None]


def test_email_pattern(spark):
    vals = ["a@b.co", "a@b..com", "a@b", "a b@c.com", " a@b.co", None]
    assert one_col(spark, vals, email_ok) == [True, True, False, False, False, None]


def test_present(spark):
    vals = ["  ", "NaN ", " NaN", "nan", "\t", "", None, "x"]
    assert one_col(spark, vals, present) == [False, False, False, True, True, False, False, True]


def test_present_parts_three_valued(spark):
    assert one_col(spark, [None], not_null) == [False]
    assert one_col(spark, [None], not_blank) == [None]
    assert one_col(spark, [None], not_sentinel) == [None]
