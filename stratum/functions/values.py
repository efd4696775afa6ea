"""Text-to-typed-value functions (FN-1..FN-7), ``Column -> Column``.

Each parser has a strict and a lenient form. Strict is the plain Spark call the
pipelines use: under the session's ANSI mode (on by default in Spark 4) a bad
value fails the job. Lenient uses the ``try_*`` variants and yields NULL, so a
single malformed amount in a month of deposits does not stop the load.
All are JVM expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegerType, StringType

# Fixed values the results depend on.
# Date text as it arrives in the day-first drops, e.g. "08-01-2026 14:00".
DATE_DAY_FIRST = "dd-MM-yyyy HH:mm"
# Date text of the validated staging table read by the append step.
DATE_ISO = "yyyy-MM-dd HH:mm:ss"
# Characters stripped from money text before the decimal cast ("$44,196.98").
MONEY_STRIP = "[$,]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, fmt: str = DATE_DAY_FIRST, strict: bool = False) -> Column:
    """FN-1 / FN-2: date text -> DATE, time-of-day discarded."""
    if strict:
        return F.to_date(_col(c), fmt)
    return F.try_to_date(_col(c), fmt)


def strip_chars(c: str | Column, pattern: str = MONEY_STRIP) -> Column:
    """FN-3: remove every character matched by ``pattern`` (global replace)."""
    return F.regexp_replace(_col(c), pattern, "")


def cast_to(c: str | Column, dtype: DataType | str, strict: bool = False) -> Column:
    """Cast, raising (strict) or giving NULL (lenient) on a bad value."""
    return _col(c).cast(dtype) if strict else _col(c).try_cast(dtype)


def parse_money(c: str | Column, precision: int = 15, scale: int = 2, strict: bool = False) -> Column:
    """FN-4: money text -> DECIMAL(precision, scale), half-up rounding."""
    return cast_to(strip_chars(c), DecimalType(precision, scale), strict)


def parse_int(c: str | Column, strict: bool = False) -> Column:
    """FN-5: integer text -> INT (outer spaces ignored)."""
    return cast_to(c, IntegerType(), strict)


def as_string(c: str | Column) -> Column:
    """FN-6: cast to STRING (Catalyst drops it when already a string)."""
    return _col(c).cast(StringType())


def as_date(c: str | Column) -> Column:
    """FN-7: cast to DATE."""
    return _col(c).cast(DateType())
