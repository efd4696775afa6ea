"""Registered checks: one Spark query per inventory item, each with its SQL oracle.

Every query reads the ``orders`` table of the given scale-factor folder --
directly through the derived deposit view, or through tables and CSV drops
that Spark writes from it below the shared checkpoint folder -- so its work
grows with the data. The oracle re-derives the same rows from ``orders`` in
DuckDB SQL. Column names match between the two sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.checks import oracle_sql as q
from stratum.functions.predicates import email_ok, not_blank, not_null, not_sentinel, phone_ok, present
from stratum.functions.values import DATE_ISO, parse_date, parse_int, parse_money, strip_chars
from stratum.operators.audit import audit_counts, row_count
from stratum.operators.batches import batch_at, batch_max, latest_batch, pin_latest_stamp
from stratum.operators.contract import SILVER_8, SILVER_8_CAPS, SILVER_9, clean_deposits, project_to
from stratum.operators.dedupe import dedupe_any
from stratum.operators.rules import deposit_rules, reject_all, reject_distinct, split, validate
from stratum.operators.sets import except_rows
from stratum.operators.stamps import stamp_ingestion, stamp_source_file
from stratum.plans.flows import (
    dedupe_by_account,
    ingest_declared,
    ingest_strings,
    pinned_batch,
    refine_append,
    refine_append_plan,
    refine_replace,
    refine_replace_plan,
    refine_validated,
)
from stratum.scratch import scratch_path, scratch_table_name
from stratum.sinks.files import write_csv, write_text
from stratum.sinks.ledger import Ledger
from stratum.sinks.tables import TargetMismatchError, append_table, check_target, overwrite_table, write_split
from stratum.sources.derived import (
    BATCH_PERIODS,
    BATCH_STAMPS,
    deposits_from_orders,
    deposits_iso,
    qa_structure_from_parts,
)
from stratum.sources.files import (
    CORRUPT_COL,
    DEPOSIT_COLUMNS,
    QA_STRUCTURE_COLUMNS,
    period_path,
    qa_structure_schema,
    read_csv_declared,
    read_csv_strings,
    string_schema,
)
from stratum.sources.guards import EmptyBatchError, EmptySourceError, MissingSourceError, require_batch, require_rows
from stratum.sources.tables import read_table
from stratum.streaming.landing import land_new_drops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the checks.
FIXED_STAMP = "2026-04-05 00:00:00"  # stamp given to landing flows so the oracle can know it
SHORT_MOD, LONG_MOD = 61, 67  # malformed drop: rows cut to 6 fields / given a 9th field


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _fixed_stamp() -> F.Column:
    return F.lit(FIXED_STAMP).cast("timestamp_ntz")


def _land(spark: SparkSession, df: DataFrame, tag: str, **kw) -> str:
    """Write ``df`` as an external table below the shared folder; return its name."""
    name = scratch_table_name(tag)
    append_table(df, name, path=scratch_path(spark, tag), **kw)
    return name


def _drop_csv(spark: SparkSession, df: DataFrame, tag: str, **kw) -> str:
    path = scratch_path(spark, tag)
    write_csv(df, path, **kw)
    return path


def _tasks(spark: SparkSession) -> int:
    """Writers of the checks' many small dates: as many as the cluster has cores."""
    return spark.sparkContext.defaultParallelism


def _batches(df: DataFrame):
    """The monthly batches of the derived view, oldest first (the load schedule)."""
    for ts in BATCH_STAMPS:
        yield df.where(F.col("ingestion_timestamp") == F.lit(ts).cast("timestamp_ntz"))


_LAST_BATCH = f"ingestion_timestamp = TIMESTAMP '{BATCH_STAMPS[-1]}'"


# ---------------------------------------------------------------- sources
@register("table_scan", f"{q.dep_ctes()} SELECT * FROM dep")
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5 (+ SNK-1 landing it)."""
    return read_table(spark, _land(spark, deposits_from_orders(spark, sf), "raw"))


@register("csv_declared", f"{q.dep_ctes()} SELECT {q.nulled_text()} FROM dep")
def csv_declared(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1: declared schema, header line skipped, columns bound by position."""
    path = _drop_csv(spark, deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), "drop")
    return read_csv_declared(spark, path, string_schema(DEPOSIT_COLUMNS, corrupt_column=None))


def _field_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN '' ELSE '"' || {c} || '"' END"""


_MALFORMED_SQL = f"""{q.dep_ctes(key=True)},
f AS (SELECT *, {", ".join(f"{_field_sql(c)} AS f_{c}" for c in DEPOSIT_COLUMNS)} FROM dep),
l AS (
  SELECT *, CASE
    WHEN order_key % {SHORT_MOD} = 0 THEN concat_ws(',', {", ".join(f"f_{c}" for c in DEPOSIT_COLUMNS[:6])})
    WHEN order_key % {LONG_MOD} = 0 THEN concat_ws(',', {", ".join(f"f_{c}" for c in DEPOSIT_COLUMNS)}, '"X"')
    ELSE concat_ws(',', {", ".join(f"f_{c}" for c in DEPOSIT_COLUMNS)}) END AS line
  FROM f)
SELECT {q.nulled_text(DEPOSIT_COLUMNS[:6])},
  CASE WHEN order_key % {SHORT_MOD} = 0 THEN NULL ELSE NULLIF(deposit_timestamp, '') END AS deposit_timestamp,
  CASE WHEN order_key % {SHORT_MOD} = 0 THEN NULL ELSE NULLIF(amount, '') END AS amount,
  CASE WHEN order_key % {SHORT_MOD} = 0 OR order_key % {LONG_MOD} = 0 THEN line END AS {CORRUPT_COL}
FROM l"""


def malformed_drop(spark: SparkSession, sf: str) -> str:
    """Write a header-less CSV drop where some rows have too few / too many fields."""
    dep = deposits_from_orders(spark, sf, with_key=True)
    fields = [
        F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit('"'), F.col(c), F.lit('"')))
        for c in DEPOSIT_COLUMNS
    ]
    k = F.col("order_key")
    line = (
        F.when(k % SHORT_MOD == 0, F.concat_ws(",", *fields[:6]))
        .when(k % LONG_MOD == 0, F.concat_ws(",", *fields, F.lit('"X"')))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = scratch_path(spark, "malformed")
    write_text(dep.select(line.alias("value")), path)
    return path


@register("csv_malformed", _MALFORMED_SQL)
def csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2: PERMISSIVE read keeps every row; malformed ones carry their text."""
    path = malformed_drop(spark, sf)
    return read_csv_declared(spark, path, string_schema(DEPOSIT_COLUMNS), header=False)


@register("csv_strings", f"{q.dep_ctes()} SELECT {q.nulled_text()} FROM dep")
def csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-3: header names, every column a string."""
    path = _drop_csv(spark, deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), "drop")
    return read_csv_strings(spark, path)


@register("csv_period", f"{q.dep_ctes()} SELECT {q.nulled_text()} FROM dep WHERE {_LAST_BATCH}")
def csv_period(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: monthly folders; the template picks one month's drop."""
    dep = deposits_from_orders(spark, sf, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    root = _drop_csv(spark, dep, "monthly", partition_by="mon_yyyy")
    return read_csv_strings(spark, period_path(root + "/mon_yyyy={mon_yyyy}", mon_yyyy=BATCH_PERIODS[-1]))


@register("guards", f"{q.dep_ctes()} SELECT * FROM batch")
def guards(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-7 + SRC-8: both emptiness guards pass on real data and hand it on."""
    return require_batch(latest_batch(require_rows(deposits_from_orders(spark, sf))))


@register(
    "guards_raised",
    f"""{q.dep_ctes()},
n AS (SELECT (SELECT count(*) FROM dep) AS landed, (SELECT count(*) FROM (SELECT DISTINCT account_id FROM batch)) AS silver)
SELECT 'missing_source' AS guard, TRUE AS raised, landed AS rows_kept FROM n
UNION ALL SELECT 'empty_source', TRUE, landed FROM n
UNION ALL SELECT 'empty_batch_stop', TRUE, silver FROM n
UNION ALL SELECT 'empty_batch_pass', FALSE, 0 FROM n""",
)
def guards_raised(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6, SRC-7, SRC-8 firing: after a good load the same flow meets a missing
    drop, an empty drop and a table without a stamped row; whether it raised, and
    the rows its target holds afterwards."""
    dep = deposits_from_orders(spark, sf)
    texts, schema = dep.select(*DEPOSIT_COLUMNS), string_schema(DEPOSIT_COLUMNS)
    landed, landed_path = scratch_table_name("landed"), scratch_path(spark, "landed")
    silver, silver_path = scratch_table_name("silver"), scratch_path(spark, "silver")
    ingest_declared(spark, _drop_csv(spark, texts, "drop"), landed, schema, path=landed_path)
    refine_replace(spark, _land(spark, dep, "raw"), silver, dedupe="first", path=silver_path)
    no_rows = _drop_csv(spark, texts.where(F.lit(False)), "no-rows")
    no_stamp = _land(spark, dep.withColumn("ingestion_timestamp", F.lit(None).cast("timestamp_ntz")), "unstamped")

    def land(source: str) -> None:
        ingest_declared(spark, source, landed, schema, path=landed_path)

    def refine(policy: str) -> None:
        refine_replace(spark, no_stamp, silver, dedupe="first", path=silver_path, writers=_tasks(spark), empty_batch=policy)

    rows = []
    for guard, step, given, target in (
        ("missing_source", land, scratch_path(spark, "missing"), landed),
        ("empty_source", land, no_rows, landed),
        ("empty_batch_stop", refine, "stop", silver),
        ("empty_batch_pass", refine, "pass", silver),
    ):
        try:
            step(given)
            raised = False
        except (MissingSourceError, EmptySourceError, EmptyBatchError):
            raised = True
        rows.append((guard, raised, read_table(spark, target).count()))
    return spark.createDataFrame(rows, "guard string, raised boolean, rows_kept long")


# ---------------------------------------------------------------- stamps
@register(
    "stamp_time",
    f"{q.dep_ctes()} SELECT {', '.join(q.TEXT_COLS)}, customer_id, "
    f"TIMESTAMP '{FIXED_STAMP}' AS ingestion_timestamp FROM dep",
)
def stamp_time(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-1 / FN-10 with a given stamp."""
    return stamp_ingestion(deposits_from_orders(spark, sf).drop("ingestion_timestamp"), _fixed_stamp())


@register("stamp_file", f"{q.dep_ctes()} SELECT {q.nulled_text()}, TRUE AS from_csv_file FROM dep")
def stamp_file(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-2 / FN-11: every row knows the CSV file it came from."""
    path = _drop_csv(spark, deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), "drop")
    df = stamp_source_file(read_csv_strings(spark, path))
    return df.select(
        *DEPOSIT_COLUMNS,
        (F.col("source_file_name").endswith(".csv") & F.col("source_file_name").contains(path.split("/")[-1]))
        .alias("from_csv_file"),
    )


# ---------------------------------------------------------------- batch, aggregates
@register("latest_batch", f"{q.dep_ctes()} SELECT * FROM batch")
def latest_batch_q(spark: SparkSession, sf: str) -> DataFrame:
    """BAT-1 over a landed table (the subquery filter reaches the Parquet scan)."""
    return latest_batch(read_table(spark, _land(spark, deposits_from_orders(spark, sf), "raw")))


@register("latest_batch_pinned", f"{q.dep_ctes()} SELECT * FROM batch")
def latest_batch_pinned(spark: SparkSession, sf: str) -> DataFrame:
    """BAT-1 as the flows run it: the stamp pinned once, then a literal filter."""
    raw = read_table(spark, _land(spark, deposits_from_orders(spark, sf), "raw"))
    return batch_at(raw, pin_latest_stamp(raw))


@register("batch_max", f"{q.dep_ctes()} SELECT max(ingestion_timestamp) AS latest_ts FROM dep")
def batch_max_q(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1."""
    return batch_max(deposits_from_orders(spark, sf))


@register("row_count", f"{q.dep_ctes()} SELECT count(*) AS row_count FROM dep")
def row_count_q(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-2."""
    return row_count(deposits_from_orders(spark, sf))


@register(
    "audit_counts",
    f"""{q.dep_ctes()}, t AS (SELECT *, coalesce({q.rules_ok()}, FALSE) AS ok FROM batch)
SELECT count(*) AS processed, count(*) FILTER (WHERE ok) AS valid,
       count(*) FILTER (WHERE NOT ok) AS rejected,
       count(DISTINCT CASE WHEN ok THEN account_id END) AS written FROM t""",
)
def audit_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    """AUD-1 as one aggregate."""
    return audit_counts(latest_batch(deposits_from_orders(spark, sf)), deposit_rules())


# ---------------------------------------------------------------- predicates
_P = ["deposit_id", "account_id", "account_number", "phone_number", "branch_id"]


@register(
    "present_checks",
    f"{q.dep_ctes()} SELECT deposit_id, branch_id, "
    "deposit_id IS NOT NULL AS not_null_deposit_id, trim(deposit_id) <> '' AS not_blank_deposit_id, "
    "trim(deposit_id) <> 'NaN' AS not_sentinel_deposit_id, "
    + ", ".join(f"{q.present(c)} AS present_{c}" for c in _P)
    + " FROM dep",
)
def present_checks(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-1..FLT-4, FN-8."""
    return deposits_from_orders(spark, sf).select(
        "deposit_id",
        "branch_id",
        not_null("deposit_id").alias("not_null_deposit_id"),
        not_blank("deposit_id").alias("not_blank_deposit_id"),
        not_sentinel("deposit_id").alias("not_sentinel_deposit_id"),
        *[present(c).alias(f"present_{c}") for c in _P],
    )


@register(
    "phone_ok",
    f"{q.dep_ctes()} SELECT phone_number, regexp_matches(phone_number, '{q.PHONE_RE}') AS phone_ok FROM dep",
)
def phone_ok_q(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-5 / FN-9."""
    return deposits_from_orders(spark, sf).select("phone_number", phone_ok().alias("phone_ok"))


@register(
    "email_ok",
    f"{q.dep_ctes()} SELECT email_address, regexp_matches(email_address, '{q.EMAIL_RE}') AS email_ok FROM dep",
)
def email_ok_q(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-6 / FN-9."""
    return deposits_from_orders(spark, sf).select("email_address", email_ok().alias("email_ok"))


@register("valid_rows", f"{q.dep_ctes()} SELECT * FROM batch WHERE {q.rules_ok()}")
def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-7."""
    return validate(latest_batch(deposits_from_orders(spark, sf)), deposit_rules())


@register("rejects_all", f"{q.dep_ctes()} SELECT * FROM batch WHERE NOT coalesce({q.rules_ok()}, FALSE)")
def rejects_all(spark: SparkSession, sf: str) -> DataFrame:
    """SET-2 / FLT-8: every rejected row."""
    return reject_all(latest_batch(deposits_from_orders(spark, sf)), deposit_rules())


@register(
    "rejects_distinct",
    f"{q.dep_ctes()} SELECT * FROM batch EXCEPT SELECT * FROM batch WHERE {q.rules_ok()}",
)
def rejects_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """SET-1 / AGG-4: EXCEPT DISTINCT."""
    return reject_distinct(latest_batch(deposits_from_orders(spark, sf)), deposit_rules())


# ---------------------------------------------------------------- dedupe
_DEP_ORDER = ["deposit_id", "deposit_timestamp", "amount", "phone_number"]
_DEP_TIE = [
    "deposit_id",
    "account_number",
    "phone_number",
    "email_address",
    "branch_id",
    "deposit_timestamp",
    "amount",
    "customer_id",
    "ingestion_timestamp",
]


@register("dedupe_any", f"{q.dep_ctes()} SELECT DISTINCT account_id FROM batch")
def dedupe_any_q(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-3: survivors are arbitrary, so only the key set is compared."""
    return dedupe_any(latest_batch(deposits_from_orders(spark, sf)), ["account_id"]).select("account_id")


@register(
    "dedupe_first",
    f"""{q.dep_ctes()} SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
    ORDER BY {q.order_by(_DEP_ORDER + _DEP_TIE)}) AS rn FROM batch) WHERE rn = 1""",
)
def dedupe_first_q(spark: SparkSession, sf: str) -> DataFrame:
    """DED-1: keep the first row per account by deposit_id (NULL key is one group)."""
    return dedupe_by_account(latest_batch(deposits_from_orders(spark, sf)), "first")


_CLEAN_TIE = _DEP_TIE + ["deposit_date"]


@register(
    "dedupe_latest",
    f"""{q.dep_ctes()}, c AS ({q.cleaned('dep', q.DMY, 15)})
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
    ORDER BY deposit_date DESC NULLS LAST, {q.order_by(_DEP_ORDER + _CLEAN_TIE)}) AS rn FROM c) WHERE rn = 1""",
)
def dedupe_latest_q(spark: SparkSession, sf: str) -> DataFrame:
    """DED-2: keep the latest deposit_date per account, over every batch."""
    return dedupe_by_account(clean_deposits(deposits_from_orders(spark, sf)), "latest")


# ---------------------------------------------------------------- value functions
@register(
    "parse_date_dmy",
    f"{q.dep_ctes()} SELECT deposit_timestamp, {q.parse_date('deposit_timestamp', q.DMY)} AS deposit_date FROM dep",
)
def parse_date_dmy(spark: SparkSession, sf: str) -> DataFrame:
    """FN-1."""
    return deposits_from_orders(spark, sf).select(
        "deposit_timestamp", parse_date("deposit_timestamp").alias("deposit_date")
    )


@register(
    "parse_date_iso",
    f"{q.dep_ctes(q.ISO)} SELECT deposit_timestamp, {q.parse_date('deposit_timestamp', q.ISO)} AS deposit_date "
    "FROM dep",
)
def parse_date_iso(spark: SparkSession, sf: str) -> DataFrame:
    """FN-2."""
    return deposits_iso(spark, sf).select(
        "deposit_timestamp", parse_date("deposit_timestamp", DATE_ISO).alias("deposit_date")
    )


@register(
    "strip_money",
    f"{q.dep_ctes()} SELECT amount, regexp_replace(amount, '[$,]', '', 'g') AS amount_digits FROM dep",
)
def strip_money(spark: SparkSession, sf: str) -> DataFrame:
    """FN-3."""
    return deposits_from_orders(spark, sf).select("amount", strip_chars("amount").alias("amount_digits"))


@register(
    "parse_money_15",
    f"{q.dep_ctes()} SELECT amount AS amount_text, {q.parse_money('amount', 15)} AS amount FROM dep",
)
def parse_money_15(spark: SparkSession, sf: str) -> DataFrame:
    """FN-4 into DECIMAL(15,2)."""
    return deposits_from_orders(spark, sf).select(
        F.col("amount").alias("amount_text"), parse_money("amount", 15).alias("amount")
    )


@register(
    "parse_money_18",
    f"{q.dep_ctes()} SELECT amount AS amount_text, {q.parse_money('amount', 18)} AS amount FROM dep",
)
def parse_money_18(spark: SparkSession, sf: str) -> DataFrame:
    """FN-4 into DECIMAL(18,2)."""
    return deposits_from_orders(spark, sf).select(
        F.col("amount").alias("amount_text"), parse_money("amount", 18).alias("amount")
    )


@register(
    "parse_int",
    f"{q.dep_ctes()} SELECT customer_id AS customer_text, TRY_CAST(customer_id AS INTEGER) AS customer_id FROM dep",
)
def parse_int_q(spark: SparkSession, sf: str) -> DataFrame:
    """FN-5."""
    return deposits_from_orders(spark, sf).select(
        F.col("customer_id").alias("customer_text"), parse_int("customer_id").alias("customer_id")
    )


# ---------------------------------------------------------------- projections
@register("project_silver8", f"{q.dep_ctes()}, c AS ({q.cleaned('dep', q.DMY, 15)}) SELECT {q.SILVER_8} FROM c")
def project_silver8(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3/4/6/7/8, FN-6/7: the 8-column silver contract."""
    return project_to(clean_deposits(deposits_from_orders(spark, sf)), SILVER_8)


@register("project_caps", f"{q.dep_ctes()}, c AS ({q.cleaned('dep', q.DMY, 18)}) SELECT {q.SILVER_8_CAPS} FROM c")
def project_caps(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-5: capitalised output names, DECIMAL(18,2)."""
    return project_to(clean_deposits(deposits_from_orders(spark, sf), precision=18), SILVER_8_CAPS)


@register(
    "project_silver9",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('dep', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def project_silver9(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3/4: the 9-column contract with the integer CUSTOMER_ID."""
    cleaned = clean_deposits(deposits_iso(spark, sf), DATE_ISO, 18, customer_id=True)
    return project_to(cleaned, SILVER_9)


# ---------------------------------------------------------------- sinks
@register("append_plain", f"{q.dep_ctes()} SELECT * FROM dep")
def append_plain(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1: three monthly appends accumulate."""
    name, path = scratch_table_name("append"), scratch_path(spark, "append")
    for part in _batches(deposits_from_orders(spark, sf)):
        append_table(part, name, path=path)
    return read_table(spark, name)


@register("append_format", f"{q.dep_ctes()} SELECT * FROM dep")
def append_format(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: appends in a named table format (ORC here; Delta where its jars are present)."""
    name, path = scratch_table_name("append_orc"), scratch_path(spark, "append_orc")
    for part in _batches(deposits_from_orders(spark, sf)):
        append_table(part, name, fmt="orc", path=path)
    return read_table(spark, name)


@register("overwrite_plain", f"{q.dep_ctes()} SELECT * FROM dep WHERE {_LAST_BATCH}")
def overwrite_plain(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: each monthly overwrite replaces the table; the last one remains."""
    name, path = scratch_table_name("overwrite"), scratch_path(spark, "overwrite")
    for part in _batches(deposits_from_orders(spark, sf)):
        overwrite_table(part, name, path=path)
    return read_table(spark, name)


@register(
    "overwrite_partitioned",
    f"{q.dep_ctes()}, c AS ({q.cleaned('dep', q.DMY, 15)}) SELECT {q.SILVER_8} FROM c WHERE {_LAST_BATCH}",
)
def overwrite_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: static overwrite of a date-partitioned table drops every old date."""
    name, path = scratch_table_name("silver"), scratch_path(spark, "silver")
    for part in _batches(deposits_from_orders(spark, sf)):
        overwrite_table(
            project_to(clean_deposits(part), SILVER_8), name, partition_by="deposit_date", path=path,
            writers=_tasks(spark),
        )
    return read_table(spark, name).select(*[t for _, _, t in SILVER_8])


@register(
    "append_partitioned",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('dep', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def append_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5: monthly appends to a date-partitioned table keep every month."""
    name, path = scratch_table_name("silver9"), scratch_path(spark, "silver9")
    for part in _batches(deposits_iso(spark, sf)):
        cleaned = clean_deposits(part, DATE_ISO, 18, customer_id=True)
        append_table(
            project_to(cleaned, SILVER_9), name, partition_by="deposit_date", path=path,
            writers=_tasks(spark),
        )
    return read_table(spark, name).select(*[t for _, _, t in SILVER_9])


@register(
    "fan_out",
    f"""{q.dep_ctes()}
SELECT *, 'valid' AS target FROM batch WHERE {q.rules_ok()}
UNION ALL
SELECT *, 'rejected' AS target FROM batch WHERE NOT coalesce({q.rules_ok()}, FALSE)""",
)
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6: one split, two tables (rejects appended, valid overwritten)."""
    valid, rejected = split(latest_batch(deposits_from_orders(spark, sf)), deposit_rules(), "all")
    vname, rname = scratch_table_name("valid"), scratch_table_name("rejected")
    write_split(valid, rejected, vname, rname, scratch_path(spark, "valid"), scratch_path(spark, "rejected"))
    return (
        read_table(spark, vname).withColumn("target", F.lit("valid"))
        .unionByName(read_table(spark, rname).withColumn("target", F.lit("rejected")))
    )


# ---------------------------------------------------------------- flows
@register(
    "flow_ingest_declared",
    f"{q.dep_ctes()} SELECT {q.nulled_text()}, CAST(NULL AS VARCHAR) AS {CORRUPT_COL}, "
    f"TIMESTAMP '{FIXED_STAMP}' AS ingestion_timestamp, TRUE AS from_csv_file FROM dep",
)
def flow_ingest_declared(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-1: declared-schema drop -> stamps -> append."""
    src = _drop_csv(spark, deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), "drop")
    name = scratch_table_name("landed")
    ingest_declared(
        spark, src, name, string_schema(DEPOSIT_COLUMNS), ingestion_ts=_fixed_stamp(),
        path=scratch_path(spark, "landed"),
    )
    t = read_table(spark, name)
    return t.select(
        *DEPOSIT_COLUMNS, CORRUPT_COL, "ingestion_timestamp",
        F.col("source_file_name").endswith(".csv").alias("from_csv_file"),
    )


_QA_SQL = f"""
SELECT 'F' || CAST(p_partkey AS VARCHAR) AS feature_id, p_name AS feature_name, p_type AS test_type,
       p_brand AS framework, 'src-' || CAST(p_size % 5 AS VARCHAR) AS input_source,
       CAST(p_size AS VARCHAR) AS coverage_metric, CAST(p_size * 2 AS VARCHAR) AS test_quality_metric,
       '2026-01-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS generation_date,
       CASE WHEN p_partkey % 2 = 0 THEN 'done' ELSE 'open' END AS status,
       CAST(NULL AS VARCHAR) AS {CORRUPT_COL}, TIMESTAMP '{FIXED_STAMP}' AS ingestion_timestamp,
       TRUE AS from_csv_file
FROM part"""


@register("flow_ingest_qa", _QA_SQL)
def flow_ingest_qa(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-1 with its own declared schema: the QA-structure drop (nine text
    columns + ``_corrupt_record``), derived from ``part``."""
    src = scratch_path(spark, "qa-drop")
    write_csv(qa_structure_from_parts(spark, sf), f"{src}/jan_2026/project_structure.csv")
    name = scratch_table_name("qa_raw")
    ingest_declared(
        spark, period_path(src + "/{mon_yyyy}/project_structure.csv", mon_yyyy="jan_2026"), name,
        qa_structure_schema(), ingestion_ts=_fixed_stamp(), path=scratch_path(spark, "qa_raw"),
    )
    return read_table(spark, name).select(
        *QA_STRUCTURE_COLUMNS, CORRUPT_COL, "ingestion_timestamp",
        F.col("source_file_name").endswith(".csv").alias("from_csv_file"),
    )


@register(
    "flow_ingest_strings",
    f"{q.dep_ctes()} SELECT {q.nulled_text()}, TIMESTAMP '{FIXED_STAMP}' AS ingestion_timestamp FROM dep",
)
def flow_ingest_strings(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-2: all-string drop -> stamp -> append."""
    src = _drop_csv(spark, deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), "drop")
    name = scratch_table_name("landed")
    ingest_strings(spark, src, name, ingestion_ts=_fixed_stamp(), path=scratch_path(spark, "landed"))
    return read_table(spark, name)


_FLOW3_SQL = f"""{q.dep_ctes()},
d AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
    ORDER BY {q.order_by(_DEP_ORDER + _DEP_TIE)}) AS rn FROM batch) WHERE rn = 1),
c AS ({q.cleaned('d', q.DMY, 15)})
SELECT {q.SILVER_8} FROM c"""


@register("flow_refine_replace", _FLOW3_SQL)
def flow_refine_replace(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-3 with keep-first dedupe (exact, unlike the arbitrary survivor)."""
    raw = _land(spark, deposits_from_orders(spark, sf), "raw")
    name = scratch_table_name("silver")
    refine_replace(spark, raw, name, dedupe="first", path=scratch_path(spark, "silver"), writers=_tasks(spark))
    return read_table(spark, name).select(*[t for _, _, t in SILVER_8])


_CAPS = ["Deposit_id", "Account_id", "Account_number", "Phone_number", "Email", "Branch_id", "Deposit_date", "Amount"]
_CAPS_TIE = [c for c in _CAPS if c != "Account_id"]
_FLOW4_SQL = f"""{q.dep_ctes()},
v AS (SELECT * FROM batch WHERE {q.rules_ok()}),
p AS (SELECT {q.SILVER_8_CAPS} FROM ({q.cleaned('v', q.DMY, 18)}))
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY Account_id
    ORDER BY Deposit_date DESC NULLS LAST, {q.order_by(["Deposit_id", "Amount", "Phone_number"] + _CAPS_TIE)}) AS rn
  FROM p) WHERE rn = 1"""


@register("flow_refine_validated", _FLOW4_SQL)
def flow_refine_validated(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-4 with keep-latest dedupe: validate, quarantine, refine, dedupe."""
    raw = _land(spark, deposits_from_orders(spark, sf), "raw")
    names = {t: scratch_table_name(t) for t in ("valid", "rejected", "silver")}
    refine_validated(
        spark, raw, names["valid"], names["rejected"], names["silver"], dedupe="latest",
        paths={t: scratch_path(spark, t) for t in names}, writers=_tasks(spark),
    )
    return read_table(spark, names["silver"]).select(*_CAPS)


def _validated(spark: SparkSession, sf: str, rejects: str = "distinct") -> tuple[dict[str, str], dict[str, int]]:
    """FLOW-4 over the derived raw table: its three tables' names, and its audit."""
    raw = _land(spark, deposits_from_orders(spark, sf), "raw")
    names = {t: scratch_table_name(t) for t in ("valid", "rejected", "silver")}
    audit = refine_validated(
        spark, raw, names["valid"], names["rejected"], names["silver"], rejects=rejects, dedupe="latest",
        paths={t: scratch_path(spark, t) for t in names}, writers=_tasks(spark),
    )
    return names, audit


@register("flow_validated_valid", f"{q.dep_ctes()} SELECT * FROM batch WHERE {q.rules_ok()}")
def flow_validated_valid(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-4's validated table."""
    return read_table(spark, _validated(spark, sf)[0]["valid"])


@register(
    "flow_validated_rejects",
    f"{q.dep_ctes()} SELECT * FROM batch EXCEPT SELECT * FROM batch WHERE {q.rules_ok()}",
)
def flow_validated_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-4's quarantine table under the as-coded distinct reading."""
    return read_table(spark, _validated(spark, sf)[0]["rejected"])


@register(
    "flow_validated_rejects_all",
    f"{q.dep_ctes()} SELECT * FROM batch WHERE NOT coalesce({q.rules_ok()}, FALSE)",
)
def flow_validated_rejects_all(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-4's quarantine table keeping every rejected row."""
    return read_table(spark, _validated(spark, sf, rejects="all")[0]["rejected"])


@register(
    "flow_validated_audit",
    f"""{q.dep_ctes()}, t AS (SELECT *, coalesce({q.rules_ok()}, FALSE) AS ok FROM batch)
SELECT count(*) AS processed, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS rejected,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM t WHERE NOT ok)) AS rejected_written,
       count(DISTINCT CASE WHEN ok THEN account_id END) AS written FROM t""",
)
def flow_validated_audit(spark: SparkSession, sf: str) -> DataFrame:
    """AUD-1 as FLOW-4 returns it, observed on its writes."""
    audit = _validated(spark, sf)[1]
    return spark.createDataFrame([tuple(audit.values())], ", ".join(f"{k} long" for k in audit))


@register(
    "flow_refine_append_months",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('dep', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def flow_refine_append_months(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-5 once a month, the validated table laid out by batch: every earlier
    month stays in the silver table."""
    validated, validated_path = scratch_table_name("validated"), scratch_path(spark, "validated")
    name, path = scratch_table_name("silver9"), scratch_path(spark, "silver9")
    for part in _batches(deposits_iso(spark, sf)):
        append_table(part, validated, partition_by="ingestion_timestamp", path=validated_path)
        refine_append(spark, validated, name, path=path, writers=_tasks(spark))
    return read_table(spark, name).select(*[t for _, _, t in SILVER_9])


@register(
    "flow_refine_append",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('batch', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def flow_refine_append(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-5: latest validated batch appended to the history-keeping silver table."""
    validated = _land(spark, deposits_iso(spark, sf), "validated")
    name = scratch_table_name("silver9")
    refine_append(spark, validated, name, path=scratch_path(spark, "silver9"), writers=_tasks(spark))
    return read_table(spark, name).select(*[t for _, _, t in SILVER_9])


_BRONZE_SQL = f"""{q.dep_ctes()},
b AS (SELECT {q.nulled_text()}, customer_id, ingestion_timestamp FROM dep WHERE {_LAST_BATCH}),
v AS (SELECT * FROM b WHERE {q.rules_ok()}),
p AS (SELECT {q.SILVER_8_CAPS} FROM ({q.cleaned('v', q.DMY, 18)}))
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY Account_id
    ORDER BY Deposit_date DESC NULLS LAST, {q.order_by(["Deposit_id", "Amount", "Phone_number"] + _CAPS_TIE)}) AS rn
  FROM p) WHERE rn = 1"""


@register("bronze_to_silver", _BRONZE_SQL)
def bronze_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-2 three times (one monthly drop each, real clock stamps), then FLOW-4:
    the latest landed month is validated, quarantined, refined and deduped."""
    dep = deposits_from_orders(spark, sf, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    root = _drop_csv(spark, dep, "monthly", partition_by="mon_yyyy")
    bronze, bronze_path = scratch_table_name("bronze"), scratch_path(spark, "bronze")
    for mon in BATCH_PERIODS:  # monthly runs, oldest first
        ingest_strings(spark, period_path(root + "/mon_yyyy={mon_yyyy}", mon_yyyy=mon), bronze, path=bronze_path)
    names = {t: scratch_table_name(t) for t in ("valid", "rejected", "silver")}
    refine_validated(
        spark, bronze, names["valid"], names["rejected"], names["silver"], dedupe="latest",
        paths={t: scratch_path(spark, t) for t in names}, writers=_tasks(spark),
    )
    return read_table(spark, names["silver"]).select(*_CAPS)


# ---------------------------------------------------------------- streaming
@register(
    "stream_land",
    f"{q.dep_ctes()} SELECT {q.nulled_text()}, CAST(NULL AS VARCHAR) AS {CORRUPT_COL}, "
    "TRUE AS from_csv_file, TRUE AS stamped FROM dep",
)
def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental landing of every monthly drop folder with an availableNow stream."""
    dep = deposits_from_orders(spark, sf, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    root = _drop_csv(spark, dep, "monthly", partition_by="mon_yyyy")
    name = scratch_table_name("stream_raw")
    land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), name, scratch_path(spark, "stream_ckpt"),
                   path=scratch_path(spark, "stream_raw"))
    return read_table(spark, name).select(
        *DEPOSIT_COLUMNS, CORRUPT_COL,
        F.col("source_file_name").endswith(".csv").alias("from_csv_file"),
        F.col("ingestion_timestamp").isNotNull().alias("stamped"),
    )


# ---------------------------------------------------------------- runs that fail or come again
_FIRST_BATCH = f"ingestion_timestamp = TIMESTAMP '{BATCH_STAMPS[0]}'"
_FIRST_TWO = f"ingestion_timestamp <= TIMESTAMP '{BATCH_STAMPS[1]}'"


@register(
    "overwrite_survives_failure",
    f"{q.dep_ctes()}, c AS ({q.cleaned('dep', q.DMY, 15)}) SELECT {q.SILVER_8} FROM c WHERE {_FIRST_BATCH}",
)
def overwrite_survives_failure(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4 / FLOW-3: the first month is written; the second month's overwrite fails
    at rows it meets midway, so the table still holds the first month."""
    name, path = scratch_table_name("silver"), scratch_path(spark, "silver")
    first, second, _ = _batches(deposits_from_orders(spark, sf))
    overwrite_table(project_to(clean_deposits(first), SILVER_8), name, partition_by="deposit_date", path=path, writers=_tasks(spark))
    fails = F.when(F.col("branch_id") == "7", F.raise_error(F.lit("fails midway"))).otherwise(F.col("branch_id"))
    broken = project_to(clean_deposits(second.withColumn("branch_id", fails)), SILVER_8)
    try:
        overwrite_table(broken, name, partition_by="deposit_date", path=path, writers=_tasks(spark))
    except Exception as e:
        if "fails midway" not in str(e):
            raise
    return read_table(spark, name).select(*[t for _, _, t in SILVER_8])


@register(
    "quarantine_rerun",
    f"{q.dep_ctes()} SELECT *, CAST(ingestion_timestamp AS VARCHAR) AS batch_key FROM dep "
    f"WHERE NOT coalesce({q.rules_ok()}, FALSE)",
)
def quarantine_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6 / FLOW-4 with its quarantine by batch: every month is refined twice, each
    rejected row is there once."""
    raw, raw_path = scratch_table_name("raw"), scratch_path(spark, "raw")
    names = {t: scratch_table_name(t) for t in ("valid", "rejected", "silver")}
    paths = {t: scratch_path(spark, t) for t in names}
    for part in _batches(deposits_from_orders(spark, sf)):
        append_table(part, raw, path=raw_path)
        for _ in range(2):
            refine_validated(spark, raw, names["valid"], names["rejected"], names["silver"], rejects="all",
                             dedupe="latest", paths=paths, quarantine="batch", writers=_tasks(spark))
    return read_table(spark, names["rejected"])


@register(
    "append_once",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('dep', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def append_once(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5 / FLOW-5 under a run ledger: every month is run twice, each row is there once."""
    validated, validated_path = scratch_table_name("validated"), scratch_path(spark, "validated")
    name, path = scratch_table_name("silver9"), scratch_path(spark, "silver9")
    ledger = Ledger(spark, scratch_table_name("ledger"), scratch_path(spark, "ledger"))
    for part in _batches(deposits_iso(spark, sf)):
        append_table(part, validated, partition_by="ingestion_timestamp", path=validated_path)
        for _ in range(2):
            refine_append(spark, validated, name, path=path, ledger=ledger, check=True, writers=_tasks(spark))
    return read_table(spark, name).select(*[t for _, _, t in SILVER_9])


@register("land_once", f"{q.dep_ctes()} SELECT {q.nulled_text()} FROM dep WHERE {_FIRST_TWO}")
def land_once(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1 / FLOW-2 under a file ledger: two monthly drops, the first handed in twice."""
    dep = deposits_from_orders(spark, sf, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    root = _drop_csv(spark, dep, "monthly", partition_by="mon_yyyy")
    name, path = scratch_table_name("landed"), scratch_path(spark, "landed")
    ledger = Ledger(spark, scratch_table_name("ledger"), scratch_path(spark, "ledger"))
    for mon in (BATCH_PERIODS[0], BATCH_PERIODS[0], BATCH_PERIODS[1]):
        ingest_strings(spark, period_path(root + "/mon_yyyy={mon_yyyy}", mon_yyyy=mon), name, path=path, ledger=ledger)
    return read_table(spark, name).select(*DEPOSIT_COLUMNS)


@register("latest_partition", f"{q.dep_ctes()} SELECT * FROM batch")
def latest_partition(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1 / BAT-1 from the catalog's partition names, over a raw table by batch."""
    name = _land(spark, deposits_from_orders(spark, sf), "raw", partition_by="ingestion_timestamp")
    return pinned_batch(read_table(spark, name), table=name)


@register(
    "except_tables",
    f"{q.dep_ctes()} SELECT * FROM dep EXCEPT SELECT * FROM batch WHERE {q.rules_ok()}",
)
def except_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SET-1 of two tables: the raw table (NULLs and repeats in it) minus the validated
    table as FLOW-4 wrote it."""
    raw = _land(spark, deposits_from_orders(spark, sf), "raw")
    names = {t: scratch_table_name(t) for t in ("valid", "rejected", "silver")}
    refine_validated(spark, raw, names["valid"], names["rejected"], names["silver"], dedupe="latest",
                     paths={t: scratch_path(spark, t) for t in names}, writers=_tasks(spark))
    return except_rows(read_table(spark, raw), read_table(spark, names["valid"]))


@register(
    "contract_refused",
    f"""{q.dep_ctes()}, n AS (SELECT count(*) AS rows_kept FROM batch)
SELECT unnest(['as_written', 'letter_case', 'no_column', 'other_type', 'other_order', 'more_columns', 'not_partitioned']) AS "case",
       unnest([FALSE, FALSE, TRUE, TRUE, TRUE, TRUE, TRUE]) AS refused, rows_kept FROM n""",
)
def contract_refused(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3 against the catalog: whether rows are refused before an append, and how many
    the table holds after all of it."""
    batch = latest_batch(deposits_from_orders(spark, sf))
    silver = project_to(clean_deposits(batch), SILVER_8)
    name = _land(spark, silver, "silver", partition_by="deposit_date", writers=_tasks(spark))
    cases = {
        "as_written": (silver, "deposit_date"),
        "letter_case": (project_to(clean_deposits(batch), [(s, t, n.upper()) for s, t, n in SILVER_8]), "Deposit_Date"),
        "no_column": (silver.drop("branch_id"), "deposit_date"),
        "other_type": (project_to(clean_deposits(batch, precision=18), SILVER_8), "deposit_date"),
        "other_order": (silver.select(*reversed(silver.columns)), "deposit_date"),
        "more_columns": (silver.withColumn("note", F.lit("x")), "deposit_date"),
        "not_partitioned": (silver, None),
    }
    rows = []
    for case, (df, by) in cases.items():
        try:
            check_target(df, name, by)
            rows.append((case, False))
        except TargetMismatchError:
            rows.append((case, True))
    kept = read_table(spark, name).agg(F.count(F.lit(1)).alias("rows_kept"))
    return spark.createDataFrame(rows, "case string, refused boolean").join(kept)


@register(
    "land_spread",
    f"{q.dep_ctes()} SELECT {q.nulled_text()}, CAST(NULL AS VARCHAR) AS {CORRUPT_COL}, TRUE AS from_gzip FROM dep",
)
def land_spread(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1: drops that cannot be split (gzip), dealt over 8 tasks before they are
    written; every row keeps the file it came from."""
    src, name = scratch_path(spark, "gzip-drop"), scratch_table_name("landed")
    write_csv(deposits_from_orders(spark, sf).select(*DEPOSIT_COLUMNS), src, compression="gzip")
    ingest_declared(spark, src, name, string_schema(DEPOSIT_COLUMNS), path=scratch_path(spark, "landed"), spread=8)
    return read_table(spark, name).select(
        *DEPOSIT_COLUMNS, CORRUPT_COL, F.col("source_file_name").endswith(".csv.gz").alias("from_gzip"))


@register(
    "stream_counts",
    f"""{q.dep_ctes()}
SELECT 'first' AS run, count(*) FILTER (WHERE {_FIRST_TWO}) AS landed_rows FROM dep
UNION ALL SELECT 'second', count(*) FILTER (WHERE NOT {_FIRST_TWO}) FROM dep
UNION ALL SELECT 'third', 0""",
)
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """AUD-1 of a stream: what each landing reports, file by file, as observed in its
    micro-batches: two months, the third one, nothing new."""
    dep = deposits_from_orders(spark, sf, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    drops, name = scratch_path(spark, "drops"), scratch_table_name("stream_raw")
    checkpoint, path, rows = scratch_path(spark, "stream_ckpt"), scratch_path(spark, "stream_raw"), []
    for run, months in (("first", BATCH_PERIODS[:2]), ("second", BATCH_PERIODS[2:]), ("third", [])):
        if months:
            write_csv(dep.where(F.col("mon_yyyy").isin(months)), drops, partition_by="mon_yyyy", mode="append")
        landed = land_new_drops(spark, drops, string_schema(DEPOSIT_COLUMNS), name, checkpoint, path=path, maxFilesPerTrigger="2")
        rows.append((run, landed["rows"]))
    return spark.createDataFrame(rows, "run string, landed_rows long")


# ---------------------------------------------------------------- flagship (no sink)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-3's plan on the derived view: latest batch -> keep-first -> clean -> silver."""
    return refine_replace_plan(deposits_from_orders(spark, sf), dedupe="first")


@register("refine_plan", _FLOW3_SQL)
def refine_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship plan itself (no table written)."""
    return flagship(spark, sf)


@register(
    "refine_append_plan",
    f"{q.dep_ctes(q.ISO)}, c AS ({q.cleaned('batch', q.ISO, 18, customer=True)}) SELECT {q.SILVER_9} FROM c",
)
def refine_append_plan_q(spark: SparkSession, sf: str) -> DataFrame:
    """FLOW-5's plan on the derived view (no table written)."""
    return refine_append_plan(deposits_iso(spark, sf))


__all__ = ["ORACLE", "QUERIES", "flagship", "malformed_drop"]
