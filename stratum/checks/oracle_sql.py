"""SQL building blocks for the independent DuckDB oracle.

The deposit view is re-derived from ``orders`` in plain SQL (the same rules
as ``stratum.sources.derived``) and each check appends its own CTEs.
"""

from __future__ import annotations

DMY = "%d-%m-%Y %H:%M"
ISO = "%Y-%m-%d %H:%M:%S"

TEXT_COLS = [
    "deposit_id",
    "account_id",
    "account_number",
    "phone_number",
    "email_address",
    "branch_id",
    "deposit_timestamp",
    "amount",
]
# The same patterns as the predicates.
PHONE_RE = r"^[0-9\-]+$"
EMAIL_RE = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"


def dep_ctes(date_fmt: str = DMY, key: bool = False) -> str:
    """``WITH base AS (...), dep AS (...), batch AS (...)`` over ``orders``."""
    key_col = "k AS order_key," if key else ""
    return f"""
WITH base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice, o_orderdate FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 101 < 2
),
dep AS (
  SELECT {key_col}
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 97 = 1 THEN '' WHEN k % 97 = 2 THEN 'NaN'
         ELSE 'D' || CAST(k AS VARCHAR) END AS deposit_id,
    CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(c AS VARCHAR) END AS account_id,
    CAST(1000000 + c AS VARCHAR) AS account_number,
    CASE WHEN k % 83 = 0 THEN '+1 555 0100' ELSE '555-' || CAST(1000 + k % 9000 AS VARCHAR) END AS phone_number,
    CASE WHEN k % 79 = 0 THEN 'not-an-email' WHEN k % 79 = 1 THEN NULL
         ELSE 'user' || CAST(c AS VARCHAR) || '@example.com' END AS email_address,
    CASE WHEN k % 73 = 0 THEN '  ' ELSE CAST(c % 50 AS VARCHAR) END AS branch_id,
    CASE WHEN k % 71 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '{date_fmt}') END AS deposit_timestamp,
    CASE WHEN k % 67 = 1 THEN 'n/a' ELSE '$' || format('{{:,.2f}}', o_totalprice) END AS amount,
    CASE WHEN k % 59 = 0 THEN 'C' || CAST(c AS VARCHAR) ELSE CAST(c AS VARCHAR) END AS customer_id,
    CASE k % 3 WHEN 0 THEN TIMESTAMP '2026-01-05 00:00:00'
               WHEN 1 THEN TIMESTAMP '2026-02-05 00:00:00'
               ELSE TIMESTAMP '2026-03-05 00:00:00' END AS ingestion_timestamp
  FROM base
),
batch AS (
  SELECT * FROM dep WHERE ingestion_timestamp = (SELECT max(ingestion_timestamp) FROM dep)
)"""


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}) <> '' AND trim({c}) <> 'NaN')"


def rules_ok() -> str:
    """Conjunction of the seven deposit rules (may be NULL)."""
    return (
        f"({present('deposit_id')} AND {present('account_id')} AND {present('account_number')} AND "
        f"{present('phone_number')} AND regexp_matches(phone_number, '{PHONE_RE}') AND "
        f"regexp_matches(email_address, '{EMAIL_RE}') AND {present('branch_id')})"
    )


def parse_date(c: str, fmt: str) -> str:
    return f"CAST(try_strptime({c}, '{fmt}') AS DATE)"


def parse_money(c: str, precision: int) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[$,]', '', 'g') AS DECIMAL({precision},2))"


def cleaned(src: str, fmt: str, precision: int, customer: bool = False) -> str:
    """The cleaning step as a SELECT over ``src``: raw columns, deposit_date, decimal amount."""
    cust = "TRY_CAST(customer_id AS INTEGER) AS CUSTOMER_ID" if customer else "customer_id"
    return (
        "SELECT deposit_id, account_id, account_number, phone_number, email_address, branch_id, "
        f"deposit_timestamp, {parse_money('amount', precision)} AS amount, {cust}, ingestion_timestamp, "
        f"{parse_date('deposit_timestamp', fmt)} AS deposit_date FROM {src}"
    )


SILVER_8 = (
    "deposit_id, account_id, account_number, phone_number, email_address AS email, branch_id, "
    "deposit_date, amount"
)
SILVER_8_CAPS = (
    "deposit_id AS Deposit_id, account_id AS Account_id, account_number AS Account_number, "
    "phone_number AS Phone_number, email_address AS Email, branch_id AS Branch_id, "
    "deposit_date AS Deposit_date, amount AS Amount"
)
SILVER_9 = SILVER_8 + ", CUSTOMER_ID"


def nulled_text(cols: list[str] | None = None) -> str:
    """Text columns after a CSV round trip: '' reads back as NULL."""
    return ", ".join(f"NULLIF({c}, '') AS {c}" for c in (cols or TEXT_COLS))


def order_by(cols: list[str], first_desc: bool = False) -> str:
    parts = []
    for i, c in enumerate(cols):
        d = "DESC" if (first_desc and i == 0) else "ASC"
        parts.append(f"{c} {d} NULLS LAST")
    return ", ".join(parts)
