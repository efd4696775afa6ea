"""Benchmark the medallion flows and headline operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (untimed): the deposit view derived from ``orders`` is staged as a CSV
drop and landed as raw / validated tables. Timed: the five flows end to end
(including their writes) and the headline operators, drained. Beside them, outside the
total: the refining flows on a month of 31 dates, and the same flows as plain steps
(BENCH_BEFORE=0 leaves those out). Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def session(cpus: int) -> SparkSession:
    s = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stratum-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="stratum-bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


def drain(df: DataFrame) -> None:
    """Run the whole plan, every column of every row."""
    df.write.format("noop").mode("overwrite").save()


# ---------------------------------------------------------------- the same work in plain steps
# What a script would do without this library: every count is an action of its own, the
# latest stamp is collected, and each write and count starts again from its source.
def cleaned(df: DataFrame, layout: str, precision: int) -> DataFrame:
    return df.selectExpr(
        "deposit_id", "account_id", "account_number", "phone_number", "email_address AS email", "branch_id",
        f"try_to_date(deposit_timestamp, '{layout}') AS deposit_date",
        f"try_cast(regexp_replace(amount, '[$,]', '') AS decimal({precision},2)) AS amount",
        "try_cast(customer_id AS int) AS CUSTOMER_ID",
    )


def newest(spark: SparkSession, table: str) -> DataFrame:
    stamp = spark.table(table).selectExpr("max(ingestion_timestamp) AS m").collect()[0].m
    return spark.table(table).where(f"ingestion_timestamp = TIMESTAMP_NTZ '{stamp}'")


PLAIN_VALID = " AND ".join(
    [f"trim({c}) NOT IN ('', 'NaN')" for c in ("deposit_id", "account_id", "account_number", "phone_number", "branch_id")]
    + ["phone_number RLIKE '^[0-9-]+$'", "email_address RLIKE '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$'"])


def plain_landing(spark: SparkSession, drop: str, schema, table: str, path: str) -> int:
    reader = spark.read.option("header", True)
    rows = (reader.schema(schema) if schema else reader).csv(drop).selectExpr("*", "current_timestamp() AS ingestion_timestamp")
    if schema:
        rows.head(1)
    rows.write.mode("append").option("path", path).saveAsTable(table)
    return rows.count()


def plain_silver(df: DataFrame, mode: str, table: str, path: str) -> int:
    df.write.mode(mode).partitionBy("deposit_date").option("path", path).saveAsTable(table)
    return df.count()


def plain_validated(spark: SparkSession, raw: str, names: dict, paths: dict) -> list[int]:
    batch = newest(spark, raw)
    valid = batch.where(PLAIN_VALID)
    rejected = batch.subtract(valid)
    rejected.write.mode("append").option("path", paths["rejected"]).saveAsTable(names["rejected"])
    valid.write.mode("overwrite").option("path", paths["valid"]).saveAsTable(names["valid"])
    silver = cleaned(valid, "dd-MM-yyyy HH:mm", 18).drop("CUSTOMER_ID").dropDuplicates(["account_id"])
    silver.write.mode("overwrite").partitionBy("deposit_date").option("path", paths["silver"]).saveAsTable(names["silver"])
    return [d.count() for d in (batch, valid, rejected, silver)]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)

    from stratum.operators import audit_counts, deposit_rules, latest_batch, reject_distinct
    from stratum.plans import (
        dedupe_by_account,
        ingest_declared,
        ingest_strings,
        refine_append,
        refine_replace,
        refine_validated,
    )
    from stratum.scratch import scratch_path, scratch_table_name
    from stratum.sinks import append_table, write_csv
    from stratum.sources import DEPOSIT_COLUMNS, deposits_from_orders, deposits_iso, string_schema

    # ---- setup (untimed)
    dep = deposits_from_orders(spark, sf_dir)
    drop = scratch_path(spark, "bench-drop")
    write_csv(dep.select(*DEPOSIT_COLUMNS), drop)
    raw, raw_path = scratch_table_name("bench_raw"), scratch_path(spark, "bench-raw")
    append_table(dep, raw, path=raw_path)
    validated, validated_path = scratch_table_name("bench_validated"), scratch_path(spark, "bench-validated")
    append_table(deposits_iso(spark, sf_dir), validated, path=validated_path)
    raw_df = spark.table(raw)
    drain(raw_df)  # warm the JVM and file listing cache

    def t_ingest_declared():
        return ingest_declared(spark, drop, scratch_table_name("b"), string_schema(DEPOSIT_COLUMNS),
                               path=scratch_path(spark, "b"))

    def t_ingest_strings():
        return ingest_strings(spark, drop, scratch_table_name("b"), path=scratch_path(spark, "b"))

    def t_refine_replace():
        return refine_replace(spark, raw, scratch_table_name("b"), dedupe="first", path=scratch_path(spark, "b"),
                              writers=cpus)

    def t_refine_validated():
        names = {k: scratch_table_name(k) for k in ("valid", "rejected", "silver")}
        return refine_validated(spark, raw, names["valid"], names["rejected"], names["silver"], dedupe="latest", writers=cpus,
                                paths={k: scratch_path(spark, k) for k in names})

    def t_refine_append():
        return refine_append(spark, validated, scratch_table_name("b"), path=scratch_path(spark, "b"), writers=cpus)

    # a month of about 31 dates, as a monthly drop has; the derived view spreads a batch over 2,400
    def monthly(df: DataFrame, layout: str) -> DataFrame:
        day = F.date_add(F.lit("2026-01-01").cast("date"), F.pmod(F.xxhash64("account_number", "amount"), F.lit(31)).cast("int"))
        return df.withColumn("deposit_timestamp", F.date_format(day, layout))

    raw31, validated31 = scratch_table_name("bench_raw31"), scratch_table_name("bench_validated31")
    append_table(monthly(dep, "dd-MM-yyyy HH:mm"), raw31, path=scratch_path(spark, "bench-raw31"))
    append_table(monthly(deposits_iso(spark, sf_dir), "yyyy-MM-dd HH:mm:ss"), validated31, path=scratch_path(spark, "bench-validated31"))

    def fresh() -> tuple[str, str]:
        return scratch_table_name("b"), scratch_path(spark, "b")

    def three() -> tuple[dict, dict]:
        kinds = ("valid", "rejected", "silver")
        return {k: scratch_table_name(k) for k in kinds}, {k: scratch_path(spark, k) for k in kinds}

    def replaced(source: str) -> None:
        silver = cleaned(newest(spark, source).dropDuplicates(["account_id"]), "dd-MM-yyyy HH:mm", 15).drop("CUSTOMER_ID")
        plain_silver(silver, "overwrite", *fresh())

    months = {
        "flow_refine_replace_31": lambda: refine_replace(spark, raw31, (x := fresh())[0], path=x[1]),
        "flow_refine_validated_31": lambda: refine_validated(spark, raw31, *(x := three())[0].values(), paths=x[1]),
        "flow_refine_append_31": lambda: refine_append(spark, validated31, (x := fresh())[0], path=x[1]),
    }
    plain = {
        "flow_ingest_declared": lambda: plain_landing(spark, drop, string_schema(DEPOSIT_COLUMNS, None), *fresh()),
        "flow_ingest_strings": lambda: plain_landing(spark, drop, None, *fresh()),
        "flow_refine_replace": lambda: replaced(raw),
        "flow_refine_validated": lambda: plain_validated(spark, raw, *three()),
        "flow_refine_append": lambda: plain_silver(cleaned(newest(spark, validated), "yyyy-MM-dd HH:mm:ss", 18), "append", *fresh()),
        "flow_refine_replace_31": lambda: replaced(raw31),
        "flow_refine_validated_31": lambda: plain_validated(spark, raw31, *three()),
        "flow_refine_append_31": lambda: plain_silver(cleaned(newest(spark, validated31), "yyyy-MM-dd HH:mm:ss", 18), "append", *fresh()),
    }

    rules = deposit_rules()
    cases = [
        ("flow_ingest_declared", t_ingest_declared),
        ("flow_ingest_strings", t_ingest_strings),
        ("flow_refine_replace", t_refine_replace),
        ("flow_refine_validated", t_refine_validated),
        ("flow_refine_append", t_refine_append),
        ("latest_batch", lambda: drain(latest_batch(raw_df))),
        ("audit_counts", lambda: audit_counts(latest_batch(raw_df), rules).collect()),
        ("rejects_distinct", lambda: drain(reject_distinct(latest_batch(raw_df), rules))),
        ("dedupe_first", lambda: drain(dedupe_by_account(latest_batch(raw_df), "first"))),
        ("dedupe_latest_all", lambda: drain(dedupe_by_account(raw_df, "latest"))),
    ]
    times: dict[str, float] = {}
    counts: dict[str, dict] = {}
    for name, fn in cases:
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        if isinstance(out, dict):
            counts[name] = out

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return round(time.perf_counter() - t0, 3)

    month_times = {name: timed(fn) for name, fn in months.items()}
    before = {} if os.environ.get("BENCH_BEFORE") == "0" else {name: timed(fn) for name, fn in plain.items()}

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "medallion_flows_and_operators_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "rows_raw": raw_df.count(),
        "months_of_31_dates": month_times,
        "plain_steps": before,
        "flow_counts": counts,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
