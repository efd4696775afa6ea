"""Property tests: Spark expressions against small Python models, and
dedupe / split invariants on generated rows."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions import email_ok, parse_money, phone_ok, present
from stratum.functions.predicates import EMAIL_PATTERN, PHONE_PATTERN
from stratum.operators import dedupe_any, dedupe_first, reject_all, reject_distinct, split

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

maybe_text = lambda alphabet, n: st.one_of(st.none(), st.text(alphabet=alphabet, max_size=n))


def spark_values(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


def model_present(v):
    return v is not None and v.strip(" ") not in ("", "NaN")


def model_match(pattern, v):
    return None if v is None else re.search(pattern, v) is not None


def model_money(v, precision):
    if v is None:
        return None
    s = re.sub(r"[$,]", "", v).strip()
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", s):
        return None
    try:
        d = Decimal(s).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return d if abs(d) < Decimal(10) ** (precision - 2) else None


@SETTINGS
@given(st.lists(maybe_text(" \tNaNnx", 6), min_size=1, max_size=40))
def test_present_matches_model(spark, values):
    assert spark_values(spark, values, present) == [model_present(v) for v in values]


@SETTINGS
@given(st.lists(maybe_text("0123456789-+ x\n", 8), min_size=1, max_size=40))
def test_phone_matches_model(spark, values):
    assert spark_values(spark, values, phone_ok) == [model_match(PHONE_PATTERN, v) for v in values]


@SETTINGS
@given(st.lists(maybe_text("ab1.@-_ %+co", 10), min_size=1, max_size=40))
def test_email_matches_model(spark, values):
    assert spark_values(spark, values, email_ok) == [model_match(EMAIL_PATTERN, v) for v in values]


@SETTINGS
@given(st.lists(maybe_text("0123456789.-$, e", 9), min_size=1, max_size=40))
def test_money_matches_model(spark, values):
    got = spark_values(spark, values, lambda c: parse_money(c, 15))
    assert got == [model_money(v, 15) for v in values]


rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), st.integers(0, 5),
              st.one_of(st.none(), st.sampled_from(["x", "", "NaN", "  "]))),
    min_size=1, max_size=30,
)


@SETTINGS
@given(rows_strategy)
def test_dedupe_invariants(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w string")
    first = dedupe_first(df, ["k"], [F.col("v").asc_nulls_last()])
    got = sorted(((r.k or "~"), r.v) for r in first.collect())
    want = {}
    for k, v, _ in rows:
        want[k] = min(want.get(k, v), v)
    assert got == sorted(((k or "~"), v) for k, v in want.items())
    once = dedupe_any(df, ["k"])
    assert once.count() == len(want) == dedupe_any(once, ["k"]).count()


@SETTINGS
@given(rows_strategy)
def test_split_invariants(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w string")
    rules = [("w_present", present("w")), ("k_present", present("k"))]
    valid, rejected = split(df, rules, "all")
    n_valid, n_rej = valid.count(), rejected.count()
    assert n_valid + n_rej == len(rows)
    assert n_valid == sum(1 for k, _, w in rows if model_present(w) and model_present(k))
    assert reject_distinct(df, rules).count() == len({r for r in rows if not (model_present(r[2]) and model_present(r[0]))})
    assert reject_all(df, rules).count() == n_rej


def model_date(v):
    import datetime as dt

    m = re.fullmatch(r"(\d{2})-(\d{2})-(\d{4}) (\d{2}):(\d{2})", v)
    if not m:
        return None
    d, mo, y, h, mi = map(int, m.groups())
    if h > 23 or mi > 59:
        return None
    try:
        return dt.date(y, mo, d)
    except ValueError:
        return None


day_first_text = st.builds(
    lambda d, mo, y, h, mi: f"{d:02d}-{mo:02d}-{y:04d} {h:02d}:{mi:02d}",
    st.integers(0, 39), st.integers(0, 19), st.integers(1900, 2100), st.integers(0, 29), st.integers(0, 69),
)


@SETTINGS
@given(st.lists(day_first_text, min_size=1, max_size=40))
def test_day_first_date_matches_model(spark, values):
    from stratum.functions import parse_date

    assert spark_values(spark, values, parse_date) == [model_date(v) for v in values]


def model_iso_date(v):
    import datetime as dt

    m = re.fullmatch(r"(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})", v)
    if not m:
        return None
    y, mo, d, h, mi, s = map(int, m.groups())
    if h > 23 or mi > 59 or s > 59:
        return None
    try:
        return dt.date(y, mo, d)
    except ValueError:
        return None


iso_text = st.builds(
    lambda y, mo, d, h, mi, s: f"{y:04d}-{mo:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}",
    st.integers(1900, 2100), st.integers(0, 19), st.integers(0, 39), st.integers(0, 29), st.integers(0, 69),
    st.integers(0, 69),
)


@SETTINGS
@given(st.lists(iso_text, min_size=1, max_size=40))
def test_iso_date_matches_model(spark, values):
    from stratum.functions import parse_date
    from stratum.functions.values import DATE_ISO

    assert spark_values(spark, values, lambda c: parse_date(c, DATE_ISO)) == [model_iso_date(v) for v in values]
