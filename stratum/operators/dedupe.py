"""Removing repeats by key (AGG-3, DED-1, DED-2).

Skew: one key may hold a large share of a batch (NULL or a busy account).
Both forms reduce before the shuffle -- ``dropDuplicates`` by a partial
aggregate, ``row_number() = 1`` by a partial ``WindowGroupLimit`` -- so a hot
key sends at most one row per map task to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

_RN = "__stratum_rn"


def dedupe_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-3: one row per key, survivor unspecified; NULL keys form one group."""
    return df.dropDuplicates(keys)


def _orderable(df: DataFrame, exclude: set[str]) -> list[str]:
    unorderable = (MapType, VariantType)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and not isinstance(f.dataType, unorderable)
        and not (isinstance(f.dataType, (ArrayType, StructType)) and "map" in f.dataType.simpleString())
    ]


def dedupe_first(
    df: DataFrame, keys: list[str], order: list[Column], tiebreak: bool = True
) -> DataFrame:
    """DED-1 / DED-2: per key, keep the first row under ``order``.

    With ``tiebreak`` every remaining column is appended (ascending, NULLs
    last) so rows that tie on ``order`` still resolve the same way on every
    run; only fully identical rows remain tied, and they are interchangeable.
    """
    if not keys:
        raise ValueError("dedupe needs at least one key column")
    full = list(order)
    if tiebreak:
        named = {k.lower() for k in keys}
        full += [F.col(c).asc_nulls_last() for c in _orderable(df, named)]
    w = Window.partitionBy(*keys).orderBy(*full)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedupe_latest(
    df: DataFrame, keys: list[str], date_col: str, then: list[Column] | None = None
) -> DataFrame:
    """DED-2: per key, keep the row with the latest ``date_col`` (NULL dates last)."""
    return dedupe_first(df, keys, [F.col(date_col).desc_nulls_last(), *(then or [])])
