"""Target contracts and in-place cleaning (PRJ-3..PRJ-8).

A contract is an ordered list of ``(source, type, target)``: one ``select``
with a cast and alias per column; anything not listed is dropped (PRJ-8). A
type of ``None`` keeps the column's type. Catalyst collapses the chained
``withColumn`` calls and the contract into one Project and removes
string-to-string casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType

from stratum.functions.values import DATE_DAY_FIRST, parse_date, parse_int, parse_money

Contract = list[tuple[str, "DataType | None", str]]

# The silver target contracts, in output order.
SILVER_8: Contract = [
    ("deposit_id", StringType(), "deposit_id"),
    ("account_id", StringType(), "account_id"),
    ("account_number", StringType(), "account_number"),
    ("phone_number", StringType(), "phone_number"),
    ("email_address", StringType(), "email"),
    ("branch_id", StringType(), "branch_id"),
    ("deposit_date", DateType(), "deposit_date"),
    ("amount", None, "amount"),
]

SILVER_8_CAPS: Contract = [
    ("deposit_id", StringType(), "Deposit_id"),
    ("account_id", StringType(), "Account_id"),
    ("account_number", StringType(), "Account_number"),
    ("phone_number", StringType(), "Phone_number"),
    ("email_address", StringType(), "Email"),
    ("branch_id", StringType(), "Branch_id"),
    ("deposit_date", DateType(), "Deposit_date"),
    ("amount", None, "Amount"),
]

SILVER_9: Contract = [
    ("deposit_id", StringType(), "deposit_id"),
    ("account_id", StringType(), "account_id"),
    ("account_number", StringType(), "account_number"),
    ("phone_number", StringType(), "phone_number"),
    ("email_address", StringType(), "email"),
    ("branch_id", StringType(), "branch_id"),
    ("deposit_date", DateType(), "deposit_date"),
    ("amount", None, "amount"),
    ("CUSTOMER_ID", None, "CUSTOMER_ID"),
]


class EmptyContractError(ValueError):
    """No target columns were supplied."""


def project_to(df: DataFrame, contract: Contract) -> DataFrame:
    """PRJ-3/4/5/8: ordered select with cast and alias per column."""
    if not contract:
        raise EmptyContractError("no source-to-target mapping supplied: the contract is empty")
    cols = []
    for source, dtype, target in contract:
        c = F.col(source)
        if dtype is not None:
            c = c.cast(dtype)
        cols.append(c.alias(target))
    return df.select(*cols)


def clean_deposits(
    df: DataFrame,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 15,
    strict: bool = False,
    customer_id: bool = False,
) -> DataFrame:
    """PRJ-6/PRJ-7 for deposits.

    Adds ``deposit_date`` parsed from ``deposit_timestamp`` (FN-1/FN-2),
    replaces ``amount`` with its decimal value (FN-4) and, when asked, replaces
    ``customer_id`` with an integer named ``CUSTOMER_ID`` (FN-5, PRJ-4).
    """
    out = (
        df.withColumn("deposit_date", parse_date("deposit_timestamp", date_format, strict))
        .withColumn("amount", parse_money("amount", precision, 2, strict))
    )
    if customer_id:
        out = out.withColumn("customer_id", parse_int("customer_id", strict)).withColumnRenamed(
            "customer_id", "CUSTOMER_ID"
        )
    return out


__all__ = [
    "Contract", "EmptyContractError", "SILVER_8", "SILVER_8_CAPS", "SILVER_9",
    "clean_deposits", "project_to",
]
