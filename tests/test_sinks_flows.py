"""Sinks, flows and streaming landing."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stratum.operators import deposit_rules, latest_batch, split
from stratum.plans import ingest_declared, ingest_strings, refine_append, refine_replace, refine_validated
from stratum.sinks import append_table, overwrite_table, write_csv, write_split
from stratum.sinks.staged import described
from stratum.sources import (
    DEPOSIT_COLUMNS,
    EmptyBatchError,
    MissingSourceError,
    deposits_from_orders,
    deposits_iso,
    qa_structure_schema,
    string_schema,
)
from stratum.streaming import land_new_drops

from conftest import SF_SMALL


def name(tag):
    return f"t_{tag}_{uuid.uuid4().hex[:8]}"


def folder(spark, table):
    """Where the table's current version lies."""
    return described(spark, table)["Location"].removeprefix("file:")


def test_append_twice_doubles_overwrite_does_not(spark, tmp_dir):
    df = spark.range(10).withColumn("d", F.lit(dt.date(2026, 1, 1)))
    a = name("a")
    assert append_table(df, a, path=tmp_dir + "/a", count=True) == 10
    append_table(df, a, path=tmp_dir + "/a")
    assert spark.table(a).count() == 20
    o = name("o")
    overwrite_table(df, o, path=tmp_dir + "/o")
    assert overwrite_table(df, o, path=tmp_dir + "/o", count=True) == 10
    assert spark.table(o).count() == 10


def test_partitioned_overwrite_is_static(spark, tmp_dir):
    t = name("p")
    rows = [(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2)), (3, dt.date(2026, 1, 3))]
    overwrite_table(spark.createDataFrame(rows, "v int, d date"), t, partition_by="d", path=tmp_dir + "/p")
    overwrite_table(spark.createDataFrame(rows[:1], "v int, d date"), t, partition_by="d", path=tmp_dir + "/p")
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, dt.date(2026, 1, 1))]


def test_partitioned_append_keeps_history_and_null_dates(spark, tmp_dir):
    t = name("pa")
    append_table(spark.createDataFrame([(1, dt.date(2026, 1, 1))], "v int, d date"), t, partition_by="d",
                 path=tmp_dir + "/pa")
    append_table(spark.createDataFrame([(2, None)], "v int, d date"), t, partition_by="d", path=tmp_dir + "/pa")
    assert sorted(r.v for r in spark.table(t).collect()) == [1, 2]
    assert any("__HIVE_DEFAULT_PARTITION__" in p for p in os.listdir(tmp_dir + "/pa"))


def test_partitioned_write_plans_rebalance(spark, tmp_dir):
    df = spark.range(100).withColumn("d", (F.col("id") % 3).cast("string"))
    plan = df.hint("rebalance", "d")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_write_split_counts(spark, tmp_dir):
    batch = latest_batch(deposits_from_orders(spark, SF_SMALL))
    valid, rejected = split(batch, deposit_rules(), "all")
    counts = write_split(valid, rejected, name("v"), name("r"), tmp_dir + "/v", tmp_dir + "/r")
    assert counts["valid"] + counts["rejected"] == batch.count()


def land_raw(spark, df, tmp_dir):
    t = name("raw")
    append_table(df, t, path=f"{tmp_dir}/{t}")
    return t


def test_refine_validated_audit(spark, tmp_dir):
    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    n = {k: name(k) for k in ("valid", "rejected", "silver")}
    audit = refine_validated(spark, raw, n["valid"], n["rejected"], n["silver"],
                             paths={k: f"{tmp_dir}/{k}" for k in n})
    assert audit["processed"] == audit["valid"] + audit["rejected"] == 510
    assert audit["rejected_written"] == spark.table(n["rejected"]).count() <= audit["rejected"]
    assert audit["valid"] == spark.table(n["valid"]).count()
    silver = spark.table(n["silver"])
    assert audit["written"] == silver.count() == silver.select("Account_id").distinct().count()
    assert "Deposit_date" in silver.columns and dict(silver.dtypes)["Amount"] == "decimal(18,2)"


def test_refine_validated_keep_all_rejects(spark, tmp_dir):
    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    n = {k: name(k) for k in ("valid", "rejected", "silver")}
    audit = refine_validated(spark, raw, n["valid"], n["rejected"], n["silver"], rejects="all",
                             paths={k: f"{tmp_dir}/{k}" for k in n})
    assert audit["rejected_written"] == audit["rejected"]


def test_refine_replace_written(spark, tmp_dir):
    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    out = name("silver")
    res = refine_replace(spark, raw, out, dedupe="any", path=f"{tmp_dir}/s")
    t = spark.table(out)
    assert res["written"] == t.count() == t.select("account_id").distinct().count()


def test_refine_append_accumulates_and_stops_on_empty(spark, tmp_dir):
    validated = land_raw(spark, deposits_iso(spark, SF_SMALL), tmp_dir)
    out = name("silver9")
    first = refine_append(spark, validated, out, path=f"{tmp_dir}/s9")["written"]
    refine_append(spark, validated, out, path=f"{tmp_dir}/s9")
    assert spark.table(out).count() == 2 * first
    assert dict(spark.table(out).dtypes)["CUSTOMER_ID"] == "int"
    empty = land_raw(spark, deposits_iso(spark, SF_SMALL).limit(0), tmp_dir)
    with pytest.raises(EmptyBatchError):
        refine_append(spark, empty, name("never"))


def test_ingest_declared_qa_drop(spark, tmp_dir):
    cols = qa_structure_schema().fieldNames()[:-1]
    body = ",".join(cols) + "\nF1,Unit,unit,pytest,repo,80,0.9,2026-01-08,done\nF2,short\n"
    os.makedirs(tmp_dir + "/jan_2026")
    with open(tmp_dir + "/jan_2026/project_structure.csv", "w") as f:
        f.write(body)
    t = name("qa")
    res = ingest_declared(spark, tmp_dir + "/jan_2026/project_structure.csv", t, qa_structure_schema(),
                          path=tmp_dir + "/qa")
    df = spark.table(t)
    assert res["rows"] == df.count() == 2
    assert df.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert df.select("ingestion_timestamp").distinct().count() == 1
    assert all(r[0].endswith("project_structure.csv") for r in df.select("source_file_name").collect())
    with pytest.raises(MissingSourceError):
        ingest_declared(spark, tmp_dir + "/feb_2026/project_structure.csv", t, qa_structure_schema())


def test_ingest_strings_counts(spark, tmp_dir):
    src = tmp_dir + "/drop"
    write_csv(deposits_from_orders(spark, SF_SMALL).select(*DEPOSIT_COLUMNS), src)
    t = name("landed")
    assert ingest_strings(spark, src, t, path=tmp_dir + "/l")["rows"] == 1530
    assert spark.table(t).columns == DEPOSIT_COLUMNS + ["ingestion_timestamp"]


def test_stream_landing_is_incremental(spark, tmp_dir):
    dep = deposits_from_orders(spark, SF_SMALL, period=True).select(*DEPOSIT_COLUMNS, "mon_yyyy")
    root, ckpt, t = tmp_dir + "/drops", tmp_dir + "/ckpt", name("stream")
    write_csv(dep.where("mon_yyyy = 'jan_2026'"), root + "/mon_yyyy=jan_2026", partition_by=None)
    first = land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), t, checkpoint=ckpt, path=tmp_dir + "/s")
    write_csv(dep.where("mon_yyyy = 'feb_2026'"), root + "/mon_yyyy=feb_2026", partition_by=None)
    second = land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), t, checkpoint=ckpt)
    again = land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), t, checkpoint=ckpt)
    total = spark.table(t)
    assert first["rows"] == dep.where("mon_yyyy = 'jan_2026'").count()
    assert second["rows"] == dep.where("mon_yyyy = 'feb_2026'").count()
    assert again["rows"] == 0
    assert total.count() == first["rows"] + second["rows"]
    assert total.select("ingestion_timestamp").distinct().count() == 2
    assert latest_batch(total).count() == second["rows"]


def test_refine_replace_capitalised_contract(spark, tmp_dir):
    from stratum.operators import SILVER_8_CAPS

    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    out = name("silver_caps")
    res = refine_replace(spark, raw, out, dedupe="first", contract=SILVER_8_CAPS, precision=15,
                         path=f"{tmp_dir}/caps")
    t = spark.table(out)
    assert t.columns[0] == "Deposit_id" and "Deposit_date" in t.columns
    assert res["written"] == t.count() == t.select("Account_id").distinct().count()
    assert any(p.startswith("Deposit_date=") for p in os.listdir(folder(spark, out)))


def test_refine_validated_formats_per_table(spark, tmp_dir):
    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    n = {k: name(k) for k in ("valid", "rejected", "silver")}
    refine_validated(spark, raw, n["valid"], n["rejected"], n["silver"], formats={"silver": "orc"},
                     paths={k: f"{tmp_dir}/{k}" for k in n})
    assert spark.sql(f"DESCRIBE EXTENDED {n['silver']}").where("col_name = 'Provider'").first()[1] == "orc"
    assert spark.sql(f"DESCRIBE EXTENDED {n['valid']}").where("col_name = 'Provider'").first()[1] == "parquet"


def test_partitioned_overwrite_static_even_in_dynamic_session(spark, tmp_dir):
    t = name("pd")
    rows = [(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2))]
    overwrite_table(spark.createDataFrame(rows, "v int, d date"), t, partition_by="d", path=tmp_dir + "/pd")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        overwrite_table(spark.createDataFrame(rows[:1], "v int, d date"), t, partition_by="d", path=tmp_dir + "/pd")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, dt.date(2026, 1, 1))]


def test_partitioned_overwrite_replaces_schema(spark, tmp_dir):
    t = name("ps")
    overwrite_table(spark.createDataFrame([(1, dt.date(2026, 1, 1))], "v int, d date"), t, partition_by="d",
                    path=tmp_dir + "/ps")
    overwrite_table(spark.createDataFrame([("x", 2, dt.date(2026, 1, 2))], "w string, v int, d date"), t,
                    partition_by="d", path=tmp_dir + "/ps")
    assert spark.table(t).columns == ["w", "v", "d"]
    assert [tuple(r) for r in spark.table(t).collect()] == [("x", 2, dt.date(2026, 1, 2))]


def test_partitioned_overwrite_from_itself_keeps_what_it_selects(spark, tmp_dir):
    t = name("self")
    rows = [(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2))]
    overwrite_table(spark.createDataFrame(rows, "v int, d date"), t, partition_by="d", path=tmp_dir + "/self")
    overwrite_table(spark.table(t).where("v = 1"), t, partition_by="d", path=tmp_dir + "/self")
    assert [r.v for r in spark.table(t).collect()] == [1]


def test_small_bounded_write_uses_fixed_writers(spark, tmp_dir):
    df = spark.range(300).withColumn("d", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")))
    t = name("small")
    assert overwrite_table(df, t, partition_by="d", path=tmp_dir + "/small", count=True, writers=8) == 300
    at = folder(spark, t)
    writers = {f.split("-")[1] for p in os.listdir(at) if p.startswith("d=")
               for f in os.listdir(f"{at}/{p}") if f.endswith(".parquet")}
    assert len(writers) > 1  # hash-partitioned by date over several writer tasks
    assert spark.table(t).count() == 300


def test_every_silver_row_traces_to_a_batch_row(spark, tmp_dir):
    from stratum.operators import SILVER_8, SILVER_8_CAPS, clean_deposits, project_to

    dep = deposits_from_orders(spark, SF_SMALL)
    raw = land_raw(spark, dep, tmp_dir)
    batch = latest_batch(spark.table(raw))
    out = name("trace3")
    refine_replace(spark, raw, out, dedupe="any", path=f"{tmp_dir}/trace3")
    assert spark.table(out).select(*[t for _, _, t in SILVER_8]).exceptAll(
        project_to(clean_deposits(batch), SILVER_8)).isEmpty()
    n = {k: name(k) for k in ("valid", "rejected", "silver")}
    refine_validated(spark, raw, n["valid"], n["rejected"], n["silver"], paths={k: f"{tmp_dir}/t4{k}" for k in n})
    cleaned = project_to(clean_deposits(batch, precision=18), SILVER_8_CAPS)
    assert spark.table(n["silver"]).select(*[t for _, _, t in SILVER_8_CAPS]).exceptAll(cleaned).isEmpty()


def test_stream_landing_archives_landed_drops(spark, tmp_dir):
    dep = deposits_from_orders(spark, SF_SMALL).select(*DEPOSIT_COLUMNS)
    root, archive, t = tmp_dir + "/drops2", tmp_dir + "/archive", name("stream2")
    write_csv(dep, root + "/jan_2026")
    res = land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), t, checkpoint=tmp_dir + "/ckpt2",
                         path=tmp_dir + "/s2", cleanSource="archive", sourceArchiveDir=archive)
    assert res["rows"] == 1530 == spark.table(t).count()


def test_empty_batch_erases_silver_only_on_request(spark, tmp_dir):
    raw = land_raw(spark, deposits_from_orders(spark, SF_SMALL), tmp_dir)
    out = name("erase")
    refine_replace(spark, raw, out, path=f"{tmp_dir}/erase")
    assert spark.table(out).count() > 0
    empty = land_raw(spark, deposits_from_orders(spark, SF_SMALL).limit(0), tmp_dir)
    with pytest.raises(EmptyBatchError):
        refine_replace(spark, empty, out, path=f"{tmp_dir}/erase")
    assert spark.table(out).count() > 0  # stop: silver untouched
    res = refine_replace(spark, empty, out, path=f"{tmp_dir}/erase", empty_batch="pass")
    assert res["written"] == 0 and spark.table(out).count() == 0  # pass: the overwrite erases


def test_two_step_creation_only_for_file_formats(spark, tmp_dir):
    from stratum.sinks.tables import _file_format

    t = name("fmt")
    append_table(spark.range(3), t, fmt="orc", path=tmp_dir + "/fmt")
    assert _file_format(spark, t, None, True)  # existing ORC table
    assert _file_format(spark, name("new"), None, False)  # session default (parquet)
    assert not _file_format(spark, name("new"), "delta", False)  # transactional: one atomic overwrite


def test_strict_flow_fails_on_bad_amount_lenient_gives_null(spark, tmp_dir):
    from stratum.plans import dedupe_by_account

    dep = deposits_from_orders(spark, SF_SMALL)
    # a row of the latest batch that keep-first dedupe keeps
    target = dedupe_by_account(latest_batch(dep), "first").where("deposit_id LIKE 'D%'").first().deposit_id
    bad = dep.withColumn("amount", F.when(F.col("deposit_id") == target, F.lit("($5.00)")).otherwise(F.col("amount")))
    raw = land_raw(spark, bad, tmp_dir)
    with pytest.raises(Exception):
        refine_replace(spark, raw, name("strict"), dedupe="first", strict=True, path=f"{tmp_dir}/strict")
    out = name("lenient")
    refine_replace(spark, raw, out, dedupe="first", path=f"{tmp_dir}/lenient")
    row = spark.table(out).where(F.col("deposit_id") == target).collect()
    assert len(row) == 1 and row[0].amount is None


def test_append_creating_a_table_at_a_used_path_matches_save_as_table(spark, tmp_dir):
    """Creating a table at a folder that already holds files behaves as a plain
    ``saveAsTable`` does (Spark writes a new table's location afresh)."""
    new = spark.createDataFrame([(2, dt.date(2026, 1, 2))], "v int, d date")
    seen = []
    for how in ("plain", "sink"):
        spark.createDataFrame([(1, dt.date(2026, 1, 1))], "v int, d date").write.partitionBy("d").parquet(
            f"{tmp_dir}/{how}")
        t = name(how)
        if how == "plain":
            new.write.mode("append").partitionBy("d").option("path", f"{tmp_dir}/{how}").saveAsTable(t)
        else:
            append_table(new, t, partition_by="d", path=f"{tmp_dir}/{how}")
        seen.append(sorted(r.v for r in spark.table(t).collect()))
    assert seen[0] == seen[1]


def test_pinned_ntz_stamp_on_a_spring_gap_keeps_silver(spark, tmp_dir):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        dep = deposits_from_orders(spark, SF_SMALL)
        one = dep.limit(20).drop("ingestion_timestamp").withColumn(
            "ingestion_timestamp", F.lit("2026-03-08 02:30:00").cast("timestamp_ntz"))
        raw = land_raw(spark, one, tmp_dir)
        out = name("gap")
        assert refine_replace(spark, raw, out, path=f"{tmp_dir}/gap")["written"] > 0
        assert spark.table(out).count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_streams_land_any_file_name_and_every_trigger(spark, tmp_dir):
    import gzip

    root, t = tmp_dir + "/any", name("any")
    os.makedirs(root)
    head = ",".join(DEPOSIT_COLUMNS)
    line = ",".join("x" for _ in DEPOSIT_COLUMNS)
    open(f"{root}/x.csv", "w").write(f"{head}\n{line}\n{line}\n")
    open(f"{root}/z.CSV", "w").write(f"{head}\n{line}\n")
    with gzip.open(f"{root}/y.csv.gz", "wt") as f:
        f.write(f"{head}\n{line}\n")
    land = lambda: land_new_drops(spark, root, string_schema(DEPOSIT_COLUMNS), t, tmp_dir + "/anyckpt", path=tmp_dir + "/anyt",
                                  maxFilesPerTrigger="1")
    assert land()["rows"] == 4
    open(f"{root}/n.csv", "w").write(f"{head}\n{line}\n")
    assert land()["rows"] == 1 and spark.table(t).count() == 5


def test_a_hot_date_is_split_through_the_flow(spark, tmp_dir):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keys}
    dep = deposits_iso(spark, SF_SMALL).withColumn("deposit_timestamp", F.lit("2026-01-01 10:00:00"))
    stamped = dep.withColumn("ingestion_timestamp", F.lit("2026-03-01 00:00:00").cast("timestamp_ntz"))
    raw = land_raw(spark, stamped.unionAll(stamped).unionAll(stamped), tmp_dir)
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        refine_append(spark, raw, name("hotflow"), path=f"{tmp_dir}/hotflow")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    dates = [p for p in os.listdir(f"{tmp_dir}/hotflow") if "=" in p]
    files = [f for f in os.listdir(f"{tmp_dir}/hotflow/{dates[0]}") if f.endswith(".parquet")]
    assert len(dates) == 1 and len(files) > 1


def test_raw_table_by_batch_prunes_earlier_batches(spark, tmp_dir):
    from stratum.operators import batch_at, pin_latest_stamp

    src, t = tmp_dir + "/bybatch", name("bybatch")
    write_csv(deposits_from_orders(spark, SF_SMALL).select(*DEPOSIT_COLUMNS), src)
    for stamp in ("2026-01-05 00:00:00", "2026-02-05 00:00:00"):
        n = ingest_strings(spark, src, t, ingestion_ts=F.lit(stamp).cast("timestamp_ntz"), path=tmp_dir + "/bybatch_t",
                           partition_by="ingestion_timestamp")["rows"]
    raw = spark.table(t)
    batch = batch_at(raw, pin_latest_stamp(raw))
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_timestamp" in plan
    assert batch.count() == n == raw.count() // 2
    assert len(batch.inputFiles()) and {r[0] for r in batch.select("ingestion_timestamp").distinct().collect()} == {
        dt.datetime(2026, 2, 5)}
