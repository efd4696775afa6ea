"""Batch selection, rules and split, dedupe, contracts, stamps, audit."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import (
    SILVER_8,
    SILVER_8_CAPS,
    EmptyContractError,
    audit_counts,
    batch_max,
    clean_deposits,
    dedupe_any,
    dedupe_first,
    dedupe_latest,
    deposit_rules,
    latest_batch,
    project_to,
    reject_all,
    reject_distinct,
    row_count,
    split,
    stamp_ingestion,
    validate,
)
from stratum.sources import deposits_from_orders

from conftest import SF_SMALL

T1, T2 = dt.datetime(2026, 1, 5), dt.datetime(2026, 2, 5)


def test_latest_batch_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", T1), ("b", T2), ("c", T2), ("d", None)], "k string, ingestion_timestamp timestamp"
    )
    assert sorted(r.k for r in latest_batch(df).collect()) == ["b", "c"]
    assert batch_max(df).collect()[0][0] == T2


def test_latest_batch_filter_reaches_parquet_scan(spark, tmp_dir):
    df = spark.createDataFrame([("a", T1), ("b", T2)], "k string, ingestion_timestamp timestamp")
    df.write.parquet(tmp_dir + "/raw")
    plan = latest_batch(spark.read.parquet(tmp_dir + "/raw"))._jdf.queryExecution().executedPlan().toString()
    assert "ScalarSubquery" in plan or "Subquery" in plan
    assert "PushedFilters: [IsNotNull(ingestion_timestamp), EqualTo(ingestion_timestamp" in plan


def test_split_conserves_rows(spark):
    dep = latest_batch(deposits_from_orders(spark, SF_SMALL))
    valid, rejected = split(dep, deposit_rules(), "all")
    assert valid.count() + rejected.count() == dep.count()
    assert rejected.exceptAll(reject_all(dep, deposit_rules())).isEmpty()


def test_reject_distinct_equals_subtract(spark):
    dep = latest_batch(deposits_from_orders(spark, SF_SMALL))
    rules = deposit_rules()
    mine = reject_distinct(dep, rules)
    theirs = dep.subtract(validate(dep, rules))
    assert mine.count() == theirs.count()
    assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()
    assert reject_all(dep, rules).distinct().count() == mine.count()


def test_except_collapses_equal_rejects(spark):
    rows = [(None, "x"), (None, "x"), ("", "y"), ("NaN", "z"), ("  ", "w")]
    df = spark.createDataFrame(rows, "deposit_id string, other string")
    from stratum.functions import present

    rules = [("deposit_id_present", present("deposit_id"))]
    assert reject_all(df, rules).count() == 5
    assert reject_distinct(df, rules).count() == 4


def test_null_rule_result_rejects(spark):
    df = spark.createDataFrame([("x@y.com",), (None,)], "email_address string")
    from stratum.functions import email_ok

    valid, rejected = split(df, [("email", email_ok())])
    assert [r[0] for r in valid.collect()] == ["x@y.com"]
    assert [r[0] for r in rejected.collect()] == [None]


def test_dedupe_any_null_key_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, v int")
    out = dedupe_any(df, ["k"])
    assert out.count() == 3
    assert dedupe_any(out, ["k"]).count() == 3  # twice = once
    cond = out["k"].eqNullSafe(df["k"]) & (out["v"] == df["v"])
    assert out.join(df, cond, "left_anti").isEmpty()  # survivors are input rows


def test_dedupe_first_and_latest(spark):
    df = spark.createDataFrame(
        [("a", "D2", dt.date(2026, 1, 2)), ("a", "D1", dt.date(2026, 1, 1)), ("a", None, dt.date(2026, 1, 3)),
         (None, "D9", None), (None, "D8", None)],
        "account_id string, deposit_id string, deposit_date date",
    )
    first = dedupe_first(df, ["account_id"], [F.col("deposit_id").asc_nulls_last()])
    assert sorted((r.account_id or "", r.deposit_id) for r in first.collect()) == [("", "D8"), ("a", "D1")]
    latest = dedupe_latest(df, ["account_id"], "deposit_date")
    assert sorted((r.account_id or "", r.deposit_id) for r in latest.collect()) == [("", "D8"), ("a", None)]


def test_dedupe_first_limits_before_shuffle(spark):
    dep = deposits_from_orders(spark, SF_SMALL)
    plan = dedupe_first(dep, ["account_id"], [F.col("deposit_id").asc_nulls_last()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dedupe_keys_unique(spark):
    dep = deposits_from_orders(spark, SF_SMALL)
    out = dedupe_first(dep, ["account_id"], [F.col("deposit_id").asc_nulls_last()])
    assert out.count() == dep.select("account_id").distinct().count()
    assert out.groupBy("account_id").count().where("count > 1").isEmpty()


def test_contract_projects_in_order(spark):
    dep = clean_deposits(deposits_from_orders(spark, SF_SMALL))
    out = project_to(dep, SILVER_8)
    assert out.columns == [t for _, _, t in SILVER_8]
    assert dict(out.dtypes)["amount"] == "decimal(15,2)"
    assert dict(out.dtypes)["deposit_date"] == "date"
    caps = project_to(clean_deposits(deposits_from_orders(spark, SF_SMALL), precision=18), SILVER_8_CAPS)
    assert caps.columns[0] == "Deposit_id" and dict(caps.dtypes)["Amount"] == "decimal(18,2)"


def test_empty_contract_raises(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(EmptyContractError):
        project_to(df, [])


def test_case_only_rename(spark):
    df = spark.createDataFrame([(1,)], "customer_id int")
    assert df.withColumnRenamed("customer_id", "CUSTOMER_ID").columns == ["CUSTOMER_ID"]


def test_stamp_is_one_value_per_query(spark):
    df = stamp_ingestion(deposits_from_orders(spark, SF_SMALL).drop("ingestion_timestamp"))
    assert df.select("ingestion_timestamp").distinct().count() == 1


def test_audit_counts_add_up(spark):
    dep = latest_batch(deposits_from_orders(spark, SF_SMALL))
    a = audit_counts(dep, deposit_rules()).collect()[0]
    assert a.processed == a.valid + a.rejected == dep.count()
    valid = validate(dep, deposit_rules())
    assert a.written == dedupe_any(valid, ["account_id"]).count()
    assert row_count(dep).collect()[0][0] == dep.count()


def test_pinned_stamp_exact_in_repeated_clock_hour(spark, tmp_dir):
    from stratum.operators import batch_at, pin_latest_stamp

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # two instants one hour apart that read the same on a New York wall clock
        df = spark.createDataFrame([(1793511000, "early"), (1793514600, "late")], "s long, tag string")
        df.select(F.timestamp_seconds("s").alias("ingestion_timestamp"), "tag").write.parquet(tmp_dir + "/dst")
        raw = spark.read.parquet(tmp_dir + "/dst")
        stamp = pin_latest_stamp(raw)
        assert [r.tag for r in batch_at(raw, stamp).collect()] == ["late"]
        assert [r.tag for r in latest_batch(raw).collect()] == ["late"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pinned_stamp_ntz_and_pushdown(spark, tmp_dir):
    from stratum.operators import batch_at, pin_latest_stamp

    df = spark.createDataFrame([("a", "2026-01-05 00:00:00.000001"), ("b", "2026-01-05 00:00:00.000002")],
                               "k string, t string")
    df.select("k", F.col("t").cast("timestamp_ntz").alias("ingestion_timestamp")).write.parquet(tmp_dir + "/ntz")
    raw = spark.read.parquet(tmp_dir + "/ntz")
    batch = batch_at(raw, pin_latest_stamp(raw))
    assert [r.k for r in batch.collect()] == ["b"]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ingestion_timestamp,2026-01-05T00:00:00.000002)" in plan


def test_pinned_stamp_none_on_empty(spark):
    from stratum.operators import pin_latest_stamp

    assert pin_latest_stamp(spark.createDataFrame([], "ingestion_timestamp timestamp")) is None
