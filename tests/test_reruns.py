"""Writes that may fail, be read meanwhile or run again: staged overwrites, ledgers,
quarantine by batch, contract checks, and what the flows do with them."""

from __future__ import annotations

import datetime as dt
import gzip
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.operators import except_rows, latest_batch, latest_key, partition_keys
from stratum.plans import ingest_declared, ingest_strings, pinned_batch, refine_append, refine_replace, refine_validated
from stratum.sinks import (
    InterruptedRunError,
    Ledger,
    TargetMismatchError,
    append_table,
    check_target,
    overwrite_table,
    replace_batch,
    stage,
    write_csv,
)
from stratum.sinks.staged import described
from stratum.sources import DEPOSIT_COLUMNS, deposits_from_orders, deposits_iso, string_schema

ROWS = [(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2)), (3, None)]
SCHEMA = "v int, d date"


def name(tag):
    return f"t_{tag}_{uuid.uuid4().hex[:8]}"


def values(spark, table):
    return sorted(r.v for r in spark.table(table).collect())


def versions(path):
    return sorted(p for p in os.listdir(path) if p.startswith("v-"))


# ------------------------------------------------------------------ staged overwrites
@pytest.mark.parametrize("by", ["d", None])
def test_a_failing_overwrite_and_a_reader_in_between_see_the_old_rows(spark, tmp_dir, by):
    t, path = name("staged"), f"{tmp_dir}/s"
    overwrite_table(spark.createDataFrame(ROWS, SCHEMA), t, partition_by=by, path=path)
    bad = spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("int").alias("v"),
        F.lit(dt.date(2026, 2, 1)).alias("d"))
    with pytest.raises(Exception, match="midway"):
        overwrite_table(bad, t, partition_by=by, path=path)
    assert values(spark, t) == [1, 2, 3] and len(versions(path)) == 1

    begun = spark.table(t)
    staged = stage(spark.createDataFrame([(9, dt.date(2026, 3, 1))], SCHEMA), t, "parquet", [by] if by else [], path)
    assert values(spark, t) == [1, 2, 3]
    staged.commit()
    assert values(spark, t) == [9]
    assert sorted(r.v for r in begun.collect()) == [1, 2, 3]  # planned before: its files are still there


def test_only_the_version_before_the_current_one_is_kept(spark, tmp_dir):
    t, path = name("versions"), f"{tmp_dir}/v"
    pending = None
    for k in range(4):
        overwrite_table(spark.createDataFrame([(k, dt.date(2026, 1, 1))], SCHEMA), t, partition_by="d", path=path)
        if k == 1:
            pending = stage(spark.createDataFrame([(7, None)], SCHEMA), t, "parquet", ["d"], path)
    assert values(spark, t) == [3] and len(versions(path)) == 2
    later = stage(spark.createDataFrame([(8, None)], SCHEMA), t, "parquet", ["d"], path)
    overwrite_table(spark.createDataFrame([(4, None)], SCHEMA), t, partition_by="d", path=path)
    later.abort()
    assert values(spark, t) == [4] and pending.location.rsplit("/", 1)[-1] not in versions(path)


def test_appends_after_a_staged_overwrite_add_rows_and_prune(spark, tmp_dir):
    t, path = name("then"), f"{tmp_dir}/t"
    overwrite_table(spark.createDataFrame(ROWS, SCHEMA), t, partition_by="d", path=path)
    append_table(spark.createDataFrame([(4, dt.date(2026, 5, 1)), (5, None)], SCHEMA), t, partition_by="d", path=path)
    assert values(spark, t) == [1, 2, 3, 4, 5]
    one = spark.table(t).where("d = date'2026-05-01'")
    assert [r.v for r in one.collect()] == [4]
    assert "PartitionFilters: [isnotnull(d" in one._jdf.queryExecution().executedPlan().toString()


def test_managed_tables_stay_managed_and_tracked_ones_are_taken_over(spark):
    t = name("managed")
    overwrite_table(spark.createDataFrame(ROWS, SCHEMA), t, partition_by="d")
    overwrite_table(spark.createDataFrame(ROWS[:1], SCHEMA), t, partition_by="d")
    assert values(spark, t) == [1] and described(spark, t)["Type"] == "MANAGED"
    at = described(spark, t)["Location"].removeprefix("file:")
    spark.sql(f"DROP TABLE {t}")
    assert not os.path.exists(at)

    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("d").saveAsTable(t)  # partitions in the catalog
    assert described(spark, t)["Partition Provider"] == "Catalog"
    overwrite_table(spark.createDataFrame(ROWS[1:], SCHEMA), t, partition_by="d")
    assert values(spark, t) == [2, 3] and "Partition Provider" not in described(spark, t)


def test_a_qualified_name_and_the_callers_settings(spark, tmp_dir):
    db = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    for path in (None, f"{tmp_dir}/q"):
        t = f"{db}.{name('q')}"
        for rows in (ROWS, ROWS[:2]):
            assert overwrite_table(spark.createDataFrame(rows, SCHEMA), t, partition_by="d", path=path, count=True) == len(rows)
        assert values(spark, t) == [1, 2]
    assert spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"


# ------------------------------------------------------------------ quarantine by batch
def test_a_batch_replaces_its_own_rows_only(spark, tmp_dir):
    t = name("q")

    def put(rows, batch):
        return replace_batch(spark.createDataFrame(rows, "v int"), t, batch, path=f"{tmp_dir}/q")

    assert put([(1,), (2,)], "2026-01-05 00:00:00") == 2
    assert put([(3,)], "it's\\x") == 1
    assert put([(4,)], "2026-01-05 00:00:00") == 1
    assert values(spark, t) == [3, 4]
    assert put([], "2026-01-05 00:00:00") == 0 and values(spark, t) == [3]
    assert put([], "it's\\x") == 0 and values(spark, t) == []


@pytest.mark.parametrize("stamp", ["timestamp", "timestamp_ntz"])
def test_refining_a_batch_twice_leaves_each_reject_once(spark, tmp_dir, stamp):
    dep = deposits_from_orders(spark, SF_SMALL).withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast(stamp))
    raw = name("raw")
    n = {k: name(k) for k in ("valid", "rejected", "silver")}
    kept = []
    for month in ("2026-01-05", "2026-02-05", "2026-02-05"):
        if len(kept) < 2:
            append_table(dep.where(F.to_date("ingestion_timestamp") == month), raw, path=f"{tmp_dir}/raw")
        audit = refine_validated(spark, raw, n["valid"], n["rejected"], n["silver"], rejects="all", quarantine="batch",
                                 paths={k: f"{tmp_dir}/{k}" for k in n})
        kept.append((audit, spark.table(n["rejected"]).count()))
    (first, one), (second, two), (third, again) = kept
    assert one == first["rejected_written"] and two == one + second["rejected_written"] == again and second == third
    assert spark.table(n["rejected"]).select("batch_key").distinct().count() == 2


# ------------------------------------------------------------------ ledgers
def test_a_landed_batch_is_not_appended_again(spark, tmp_dir):
    source, target = name("validated"), name("silver9")
    ledger = Ledger(spark, name("ledger"), f"{tmp_dir}/ledger")
    iso = deposits_iso(spark, SF_SMALL)
    total = 0
    for stamp in sorted(r[0] for r in iso.select("ingestion_timestamp").distinct().collect()):
        append_table(iso.where(F.col("ingestion_timestamp") == F.lit(stamp)), source, path=f"{tmp_dir}/v")
        wrote = refine_append(spark, source, target, path=f"{tmp_dir}/s", ledger=ledger, check=True)["written"]
        total += wrote
        assert wrote and refine_append(spark, source, target, path=f"{tmp_dir}/s", ledger=ledger) == {"written": 0, "already_landed": wrote}
    assert spark.table(target).count() == total == iso.count()


@pytest.mark.parametrize("landed", [True, False])
def test_a_run_cut_off_between_append_and_ledger_is_detected(spark, tmp_dir, monkeypatch, landed):
    from stratum.plans import flows

    source, target = name("validated"), name("silver9")
    ledger = Ledger(spark, name("ledger"), f"{tmp_dir}/ledger")
    append_table(latest_batch(deposits_iso(spark, SF_SMALL)), source, path=f"{tmp_dir}/v")

    def dies(*args, **kw):
        if landed:
            append_table(*args, **kw)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(flows, "append_table", dies)
        with pytest.raises(KeyboardInterrupt):
            refine_append(spark, source, target, path=f"{tmp_dir}/s", ledger=ledger)
    with pytest.raises(InterruptedRunError) as stopped:
        refine_append(spark, source, target, path=f"{tmp_dir}/s", ledger=ledger)
    n = spark.table(target).count() if landed else 0
    ledger.settle(target, stopped.value.runs[0], landed, n)
    again = refine_append(spark, source, target, path=f"{tmp_dir}/s", ledger=ledger)
    assert again == ({"written": 0, "already_landed": n} if landed else {"written": 510})
    assert spark.table(target).count() == 510


def test_a_drop_lands_once_file_by_file(spark, tmp_dir):
    drop, t = f"{tmp_dir}/drop", name("landed")
    ledger = Ledger(spark, name("ledger"), f"{tmp_dir}/ledger")
    texts = deposits_from_orders(spark, SF_SMALL).select(*DEPOSIT_COLUMNS)
    write_csv(texts.limit(30).repartition(3), drop)

    def land():
        return ingest_declared(spark, drop, t, string_schema(DEPOSIT_COLUMNS), path=f"{tmp_dir}/t", ledger=ledger)

    assert land() == {"rows": 30, "files": 3} and land() == {"rows": 0, "files": 0}
    write_csv(texts.limit(7).coalesce(1), drop, mode="append")
    assert land() == {"rows": 7, "files": 1} and land() == {"rows": 0, "files": 0}
    assert spark.table(t).count() == 37
    assert spark.table(t).select("source_file_name").distinct().count() == 4
    # the same drop lands in another table, and without a ledger it lands again
    assert ingest_strings(spark, drop, name("other"), path=f"{tmp_dir}/o", ledger=ledger)["rows"] == 37
    assert ingest_strings(spark, drop, name("plain"), path=f"{tmp_dir}/p") == {"rows": 37}


# ------------------------------------------------------------------ the latest stamp from the catalog
def test_partition_names_give_the_latest_stamp_without_reading_rows(spark, tmp_dir):
    dep = deposits_from_orders(spark, SF_SMALL)
    t, plain = name("by_batch"), name("plain")
    append_table(dep, t, partition_by="ingestion_timestamp", path=f"{tmp_dir}/b")
    append_table(dep.limit(5), plain, path=f"{tmp_dir}/p")
    keys = partition_keys(spark, t)
    assert keys == sorted(keys, reverse=True) and len(keys) == 3
    assert keys[0] == latest_key(spark.table(t)) and partition_keys(spark, plain) is None
    batch = pinned_batch(spark.table(t), table=t)
    assert sorted(map(str, batch.collect())) == sorted(map(str, latest_batch(spark.table(t)).collect()))
    assert "FileScan" not in spark.sql(f"SHOW PARTITIONS {t}")._jdf.queryExecution().executedPlan().toString()
    # a partition without rows is passed over
    spark.sql(f"ALTER TABLE {t} ADD PARTITION (ingestion_timestamp = '2027-01-01 00:00:00.5')")
    assert partition_keys(spark, t)[0] == "2027-01-01 00:00:00.5"
    assert pinned_batch(spark.table(t), table=t).count() == batch.count()
    zoned = name("zoned")
    append_table(dep.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp")), zoned,
                 partition_by="ingestion_timestamp", path=f"{tmp_dir}/z")
    assert partition_keys(spark, zoned) is None and pinned_batch(spark.table(zoned), table=zoned).count() == batch.count()
    assert refine_replace(spark, t, name("silver"), path=f"{tmp_dir}/silver")["written"] > 0


# ------------------------------------------------------------------ EXCEPT of two tables
def test_except_rows_equals_subtract_with_nulls_repeats_and_a_hot_row(spark):
    left = [(1, "a"), (1, "a"), (None, None), (None, "b"), (2, None), (3, "c"), (4, "d")]
    right = [(2, None), (None, None), (3, "C"), (4, "d"), (4, "d"), (9, "z")]
    a = spark.createDataFrame(left, "Id int, t string")
    b = spark.createDataFrame(right, "other int, name string")
    got = except_rows(a, b)
    assert got.columns == ["Id", "t"]
    assert sorted(map(str, got.collect())) == sorted(map(str, a.subtract(b).collect()))
    assert except_rows(a, b.limit(0)).count() == 6 and except_rows(a.limit(0), b).count() == 0
    hot = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("Id"), F.lit("x").alias("t"))
    done = except_rows(hot, b)
    assert done.count() == hot.distinct().count()
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and ("partial_bool_or" in plan or "partial_max" in plan)
    with pytest.raises(ValueError):
        except_rows(a, b.select("other"))


# ------------------------------------------------------------------ contract against the target
def test_rows_that_do_not_fit_are_refused_before_a_file_is_written(spark, tmp_dir):
    t = name("target")
    fits = spark.createDataFrame([(1, dt.date(2026, 1, 1), "x")], "v int, d date, w string")
    assert check_target(fits, t, "d") is fits
    append_table(fits, t, partition_by="d", path=f"{tmp_dir}/t")
    check_target(fits, t, "d")
    check_target(fits.toDF("V", "D", "W"), t, ["D"])
    files = sorted(os.listdir(f"{tmp_dir}/t"))
    for odd, by in ((fits, None), (fits.drop("w"), "d"), (fits.withColumn("v", F.col("v").cast("long")), "d"),
                    (fits.select("w", "v", "d"), "d"), (fits.withColumn("n", F.lit(1)), "d"), (fits.withColumnRenamed("w", "u"), "d")):
        with pytest.raises(TargetMismatchError):
            check_target(odd, t, by)
    assert sorted(os.listdir(f"{tmp_dir}/t")) == files
    source, silver = name("validated"), name("silver9")
    append_table(deposits_iso(spark, SF_SMALL), source, path=f"{tmp_dir}/v")
    append_table(spark.createDataFrame([(1, dt.date(2026, 1, 1))], "amount int, deposit_date date"), silver, partition_by="deposit_date", path=f"{tmp_dir}/s")
    with pytest.raises(TargetMismatchError):
        refine_append(spark, source, silver, check=True)
    assert spark.table(silver).count() == 1


# ------------------------------------------------------------------ drops that cannot be split
def test_a_gzip_drop_is_written_by_several_tasks(spark, tmp_dir):
    lines = ["a,b"] + [f"{i},x" for i in range(500)] + ["501", "502,y,z"]
    drop = f"{tmp_dir}/month.csv.gz"
    with gzip.open(drop, "wt") as f:
        f.write("\n".join(lines))
    schema = string_schema(["a", "b"])
    seen = []
    for spread in (None, 4):
        t = name("gz")
        assert ingest_declared(spark, drop, t, schema, path=f"{tmp_dir}/{t}", spread=spread) == {"rows": 502}
        rows = spark.table(t).select("a", "b", "_corrupt_record", "source_file_name").collect()
        seen.append((sorted(map(str, rows)), sum(f.endswith(".parquet") for f in os.listdir(f"{tmp_dir}/{t}"))))
    (plain, one), (dealt, several) = seen
    assert plain == dealt and one == 1 and several > 1
    assert "month.csv.gz" in plain[0] and sum("502,y,z" in r or "='501'" in r for r in plain) == 2


# ------------------------------------------------------------------ counts of a stream
def test_stream_counts_are_exact_over_many_triggers_and_beside_other_writers(spark, tmp_dir):
    import threading

    from stratum.streaming import land_new_drops

    texts = deposits_from_orders(spark, SF_SMALL).select(*DEPOSIT_COLUMNS)
    write_csv(texts.limit(120).repartition(12), f"{tmp_dir}/drop")
    t, stop = name("stream"), threading.Event()
    schema = string_schema(DEPOSIT_COLUMNS)

    def land():
        return land_new_drops(spark, f"{tmp_dir}/drop", schema, t, f"{tmp_dir}/ckpt", path=f"{tmp_dir}/t", maxFilesPerTrigger="1")

    def others():  # another writer of the same table, and another stream
        while not stop.is_set():
            texts.limit(5).write.mode("append").csv(f"{tmp_dir}/t/../elsewhere")

    beside = threading.Thread(target=others)
    beside.start()
    try:
        assert land() == {"rows": 120} and land() == {"rows": 0}
        write_csv(texts.limit(9).repartition(3), f"{tmp_dir}/drop", mode="append")
        assert land() == {"rows": 9}
    finally:
        stop.set()
        beside.join()
    assert spark.table(t).count() == 129
    batches = [f for f in os.listdir(f"{tmp_dir}/ckpt/commits") if f.isdigit()]
    assert len(batches) >= 15
