"""CSV sources, period paths and guards (SRC-1..SRC-8)."""

from __future__ import annotations

import os

import pytest

from stratum.operators import latest_batch
from stratum.sources import (
    CORRUPT_COL,
    EmptyBatchError,
    EmptySourceError,
    MissingSourceError,
    open_source,
    period_path,
    qa_structure_schema,
    read_csv_declared,
    read_csv_strings,
    require_batch,
    require_rows,
    string_schema,
)

MALFORMED = 'id,name,amt\n1,a,"$1,000.50"\n2,b\n3,c,d,e\n4,,\n"5,x\n'


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_malformed_rows_kept_with_text(spark, tmp_dir):
    p = write(tmp_dir, "drop.csv", MALFORMED)
    df = read_csv_declared(spark, p, string_schema(["id", "name", "amt"]))
    got = sorted((tuple(r) for r in df.collect()), key=lambda t: t[0])
    assert got == [
        ("1", "a", "$1,000.50", None),
        ("2", "b", None, "2,b"),
        ("3", "c", "d", "3,c,d,e"),
        ("4", None, None, None),
        ("5,x\n", None, None, '"5,x'),
    ] or got == [
        ("1", "a", "$1,000.50", None),
        ("2", "b", None, "2,b"),
        ("3", "c", "d", "3,c,d,e"),
        ("4", None, None, None),
        ("5,x", None, None, '"5,x'),
    ]


def test_declared_binds_by_position(spark, tmp_dir):
    p = write(tmp_dir, "d.csv", "b,a\n1,2\n")
    df = read_csv_declared(spark, p, string_schema(["a", "b"], corrupt_column=None))
    assert [tuple(r) for r in df.collect()] == [("1", "2")]


def test_strings_short_padded_extra_dropped(spark, tmp_dir):
    p = write(tmp_dir, "s.csv", "x,y,z\n1,2\n1,2,3,4\n")
    df = read_csv_strings(spark, p)
    assert df.columns == ["x", "y", "z"]
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert sorted((tuple(r) for r in df.collect()), key=repr) == [("1", "2", "3"), ("1", "2", None)]


def test_header_only_file_is_empty(spark, tmp_dir):
    p = write(tmp_dir, "h.csv", ",".join(qa_structure_schema().fieldNames()[:-1]) + "\n")
    df = read_csv_declared(spark, p, qa_structure_schema())
    assert df.isEmpty()
    with pytest.raises(EmptySourceError):
        require_rows(df)


def test_missing_source_raises(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nope", "drop.csv")
    with pytest.raises(MissingSourceError):
        open_source(lambda: read_csv_strings(spark, path), path)


def test_period_path():
    t = "s3a://landing/deposits/monthly/{mon_yyyy}/deposits.csv"
    assert period_path(t, mon_yyyy="jan_2026").endswith("/monthly/jan_2026/deposits.csv")


def test_require_batch_on_empty_table(spark):
    empty = spark.createDataFrame([], "a string, ingestion_timestamp timestamp")
    batch = latest_batch(empty)
    assert batch.isEmpty()
    with pytest.raises(EmptyBatchError):
        require_batch(batch)
    assert require_batch(batch, "pass") is batch


def test_corrupt_column_name(spark):
    assert qa_structure_schema().fieldNames()[-1] == CORRUPT_COL
    assert len(qa_structure_schema().fieldNames()) == 10


def test_period_path_extra_parameters():
    t = "s3a://{account}/qa/project_structure/{mon_yyyy}/project_structure.csv"
    assert period_path(t, mon_yyyy="feb_2026", account="lake") == (
        "s3a://lake/qa/project_structure/feb_2026/project_structure.csv")
    with pytest.raises(KeyError):
        period_path(t, mon_yyyy="feb_2026")
