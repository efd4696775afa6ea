"""File sources (SRC-1..SRC-4).

CSV is read with Spark's own reader: plain (uncompressed, single-line) CSV
files are split across tasks, so one large monthly drop is read in parallel.
A declared schema means no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COL = "_corrupt_record"

# The declared all-string schemas of the two monthly drops.
QA_STRUCTURE_COLUMNS = [
    "feature_id",
    "feature_name",
    "test_type",
    "framework",
    "input_source",
    "coverage_metric",
    "test_quality_metric",
    "generation_date",
    "status",
]
DEPOSIT_COLUMNS = [
    "deposit_id",
    "account_id",
    "account_number",
    "phone_number",
    "email_address",
    "branch_id",
    "deposit_timestamp",
    "amount",
]


def string_schema(columns: list[str], corrupt_column: str | None = CORRUPT_COL) -> StructType:
    """All-nullable string schema, optionally ending with the corrupt-row column."""
    names = list(columns) + ([corrupt_column] if corrupt_column else [])
    return StructType([StructField(n, StringType(), True) for n in names])


def qa_structure_schema() -> StructType:
    return string_schema(QA_STRUCTURE_COLUMNS)


def read_csv_declared(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    corrupt_column: str = CORRUPT_COL,
    **options: str,
) -> DataFrame:
    """SRC-1 + SRC-2: CSV with a declared schema, PERMISSIVE.

    Columns bind by position (the header line is skipped, not matched). When
    the schema holds ``corrupt_column``, the raw text of a row with too few or
    too many fields lands there; its parsed fields are kept, so the row count
    does not change.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if corrupt_column in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.schema(schema).csv(path)


def read_csv_strings(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """SRC-3: CSV with header names, every column a string, no inference.

    Short rows are padded with NULL, extra fields are dropped.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def period_path(template: str, **params: str) -> str:
    """SRC-4: fill a path template, e.g. ``.../monthly/{mon_yyyy}/deposits.csv``.

    Any Hadoop filesystem URI works (``abfss://``, ``s3a://``, ``hdfs://``,
    local paths in tests).
    """
    return template.format(**params)


def drop_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files a read of ``path`` would take: file_path and item, a name that changes
    with the file's modification time and size. No file is opened."""
    files = spark.read.format("binaryFile").load(path)
    meta = files.select(*(F.col(f"_metadata.{c}") for c in ("file_path", "file_modification_time", "file_size")))
    item = F.concat_ws("|", "file_path", F.unix_micros("file_modification_time").cast("string"), F.col("file_size").cast("string"))
    return meta.select("file_path", item.alias("item"))


def only_files(df: DataFrame, paths: list[str]) -> DataFrame:
    """The rows of ``df`` (a file read) from these files; the others are not opened."""
    return df.where(F.col("_metadata.file_path").isin(paths))
