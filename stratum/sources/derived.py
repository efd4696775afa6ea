"""Deposit-shaped rows derived from the ``orders`` table.

The pipelines work on monthly deposit drops; the test tables hold orders. This
view turns every order into one deposit row with deterministic defects (NULL,
blank and ``NaN`` ids, bad phones and e-mails, blank branches, dates, amounts and
customer numbers that do not parse) and exact repeats, stamped into three monthly batches. It is a projection plus a union
with a filtered second scan: no shuffle, so it scales with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.values import DATE_DAY_FIRST, DATE_ISO

# Fixed values of the derived view: defect moduli and batch stamps.
REPEAT_MOD, REPEAT_BELOW = 101, 2
DEPOSIT_ID_MOD = 97  # 0 -> NULL, 1 -> '', 2 -> 'NaN'
ACCOUNT_ID_MOD = 89  # 0 -> NULL
PHONE_MOD = 83  # 0 -> '+1 555 0100'
EMAIL_MOD = 79  # 0 -> 'not-an-email', 1 -> NULL
BRANCH_MOD = 73  # 0 -> two spaces
DATE_MOD = 71  # 0 -> text that is no date
AMOUNT_MOD = 67  # 1 -> text that is no number
CUSTOMER_MOD = 59  # 0 -> a letter before the number
BATCH_STAMPS = ["2026-01-05 00:00:00", "2026-02-05 00:00:00", "2026-03-05 00:00:00"]
BATCH_PERIODS = ["jan_2026", "feb_2026", "mar_2026"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )


def _batch_of(k) -> F.Column:
    return k % F.lit(len(BATCH_STAMPS))


def deposits_from_orders(
    spark: SparkSession,
    sf_dir: str,
    date_format: str = DATE_DAY_FIRST,
    period: bool = False,
    with_key: bool = False,
) -> DataFrame:
    """The deposit-shaped view (``customer_id`` and ``ingestion_timestamp`` included).

    ``date_format`` is the text layout of ``deposit_timestamp``; ``period``
    adds the ``mon_yyyy`` folder name of each row's batch; ``with_key`` puts
    the source ``order_key`` first.
    """
    orders = _orders(spark, sf_dir)
    base = orders.unionByName(orders.where(F.col("o_orderkey") % REPEAT_MOD < REPEAT_BELOW))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    stamp = F.lit(BATCH_STAMPS[-1]).cast("timestamp_ntz")
    mon = F.lit(BATCH_PERIODS[-1])
    for i in range(len(BATCH_STAMPS) - 2, -1, -1):
        stamp = F.when(_batch_of(k) == i, F.lit(BATCH_STAMPS[i]).cast("timestamp_ntz")).otherwise(stamp)
        mon = F.when(_batch_of(k) == i, F.lit(BATCH_PERIODS[i])).otherwise(mon)
    cols = [
        F.when(k % DEPOSIT_ID_MOD == 0, F.lit(None).cast("string"))
        .when(k % DEPOSIT_ID_MOD == 1, F.lit(""))
        .when(k % DEPOSIT_ID_MOD == 2, F.lit("NaN"))
        .otherwise(F.concat(F.lit("D"), k.cast("string")))
        .alias("deposit_id"),
        F.when(k % ACCOUNT_ID_MOD == 0, F.lit(None).cast("string")).otherwise(c.cast("string")).alias("account_id"),
        (F.lit(1000000) + c).cast("string").alias("account_number"),
        F.when(k % PHONE_MOD == 0, F.lit("+1 555 0100"))
        .otherwise(F.concat(F.lit("555-"), (F.lit(1000) + k % 9000).cast("string")))
        .alias("phone_number"),
        F.when(k % EMAIL_MOD == 0, F.lit("not-an-email"))
        .when(k % EMAIL_MOD == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user"), c.cast("string"), F.lit("@example.com")))
        .alias("email_address"),
        F.when(k % BRANCH_MOD == 0, F.lit("  ")).otherwise((c % 50).cast("string")).alias("branch_id"),
        F.when(k % DATE_MOD == 0, F.lit("unknown"))
        .otherwise(F.date_format("o_orderdate", date_format))
        .alias("deposit_timestamp"),
        F.when(k % AMOUNT_MOD == 1, F.lit("n/a"))
        .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
        .alias("amount"),
        F.when(k % CUSTOMER_MOD == 0, F.concat(F.lit("C"), c.cast("string")))
        .otherwise(c.cast("string"))
        .alias("customer_id"),
        stamp.alias("ingestion_timestamp"),
    ]
    if period:
        cols.append(mon.alias("mon_yyyy"))
    if with_key:
        cols.insert(0, k.alias("order_key"))
    return base.select(*cols)


def deposits_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view with ISO date text, as the validated staging table holds it."""
    return deposits_from_orders(spark, sf_dir, DATE_ISO)


def qa_structure_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QA-structure rows (the declared landing schema's nine text columns)
    derived from the ``part`` table, one per part: integer and text arithmetic
    only, so any engine derives the same text."""
    p = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("F"), k.cast("string")).alias("feature_id"),
        F.col("p_name").alias("feature_name"),
        F.col("p_type").alias("test_type"),
        F.col("p_brand").alias("framework"),
        F.concat(F.lit("src-"), (F.col("p_size") % 5).cast("string")).alias("input_source"),
        F.col("p_size").cast("string").alias("coverage_metric"),
        (F.col("p_size") * 2).cast("string").alias("test_quality_metric"),
        F.concat(F.lit("2026-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("generation_date"),
        F.when(k % 2 == 0, F.lit("done")).otherwise(F.lit("open")).alias("status"),
    )
