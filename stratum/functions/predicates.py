"""Row predicates (FLT-1..FLT-6, FN-8, FN-9, FN-12), ``Column -> Column``.

Predicates follow SQL three-valued logic: a pattern tested on NULL is NULL.
``split`` treats NULL as a failed rule, so no row is lost between the valid and
rejected sides.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
# Text standing for "missing" besides NULL and blank; compared case-sensitively
# after trimming spaces, so "nan" counts as present.
SENTINEL = "NaN"
# Phone numbers: digits and hyphens only, one or more characters.
PHONE_PATTERN = r"^[0-9\-]+$"
# E-mail: local part, "@", domain, dot, top-level domain of 2+ letters.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_null(c: str | Column) -> Column:
    """FLT-1."""
    return _col(c).isNotNull()


def not_blank(c: str | Column) -> Column:
    """FLT-2: something left after trimming spaces (a tab counts as present)."""
    return F.trim(_col(c)) != ""


def not_sentinel(c: str | Column, sentinel: str = SENTINEL) -> Column:
    """FLT-3: trimmed value is not the missing-value sentinel."""
    return F.trim(_col(c)) != sentinel


def present(c: str | Column) -> Column:
    """FLT-4: not NULL, not blank, not the sentinel. Never NULL itself."""
    return not_null(c) & not_blank(c) & not_sentinel(c)


def matches(c: str | Column, pattern: str) -> Column:
    """FN-9: regular-expression find (anchors come from the pattern)."""
    return _col(c).rlike(pattern)


def phone_ok(c: str | Column = "phone_number") -> Column:
    """FLT-5."""
    return matches(c, PHONE_PATTERN)


def email_ok(c: str | Column = "email_address") -> Column:
    """FLT-6."""
    return matches(c, EMAIL_PATTERN)


def all_of(preds: list[Column]) -> Column:
    """FN-12: conjunction of predicates (``True`` for an empty list)."""
    return reduce(and_, preds) if preds else F.lit(True)
