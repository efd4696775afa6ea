"""Corpus pipeline: toxicity, language ID, near duplicates, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``. The
runner writes every stage as Parquet and reads it back as the next one's docs.

* toxicity drops documents with a score of 0.7 or more;
* language drops documents that no learned language explains by its phrase rate (no
  letter and null text among them), none if there is no labelled text;
* near_duplicates keeps one document of each class, the least doc_id;
* pii replaces detected entities by surrogates;
* packing returns the pieces of the packed sequences.

Models are fitted on the labelled rows of ``sf_dir`` (bounded samples, as the
operators state); everything else covers the stage's own input. SQL can express
none of the trained stages, so there is no oracle; a test compares a run without toxicity
labels with brute-force forms of the other stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import langid, neardup, packing, pii, toxicity
from stratum.llm.common import materialise, read_table
from stratum.llm.queries import vocabulary

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), F.lit(True))
    return model.keep_clean(docs)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(read_table(spark, sf_dir, "documents"), F.lit(True)))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replaced(docs, pii.session_key(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_identified),
    ("near_duplicates", keep_one_copy),
    ("pii", replace_private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
