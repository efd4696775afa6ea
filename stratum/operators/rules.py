"""Validation rules, valid / rejected split and the two reject readings.

FLT-7 (rule conjunction), FLT-8 (split), SET-1 (rejects as EXCEPT DISTINCT, as
coded), SET-2 (every rejected row, so valid + rejected = batch).

A rule is a ``(name, Column)`` pair. A rule that evaluates to NULL counts as
failed: the valid side keeps rows where the conjunction is TRUE, the rejected
side keeps all others. Both sides are plain filters of the same input (no
join); the distinct reading adds one aggregate (map-side partial, so repeated
rows collapse before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.predicates import all_of, email_ok, phone_ok, present

Rule = tuple[str, Column]

# Columns that must be present (not NULL, not blank, not "NaN") in a deposit.
DEPOSIT_PRESENT = ["deposit_id", "account_id", "account_number", "phone_number", "branch_id"]


def deposit_rules() -> list[Rule]:
    """The seven deposit rules, in the order the validation step states them."""
    return [
        ("deposit_id_present", present("deposit_id")),
        ("account_id_present", present("account_id")),
        ("account_number_present", present("account_number")),
        ("phone_number_present", present("phone_number")),
        ("phone_number_pattern", phone_ok("phone_number")),
        ("email_address_pattern", email_ok("email_address")),
        ("branch_id_present", present("branch_id")),
    ]


def rule_check(rules: list[Rule]) -> Column:
    """Conjunction of all rules (TRUE, FALSE or NULL)."""
    return all_of([pred for _, pred in rules])


def passes(rules: list[Rule]) -> Column:
    """TRUE when every rule holds; FALSE otherwise, never NULL."""
    return F.coalesce(rule_check(rules), F.lit(False))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """FLT-7: rows for which every rule is TRUE."""
    return df.where(rule_check(rules))


def reject_all(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """SET-2: every row that is not valid, repeats kept (conserves rows)."""
    return df.where(~passes(rules))


def reject_distinct(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """SET-1: ``df EXCEPT DISTINCT validate(df)``.

    Written as the negated filter plus ``distinct`` -- the same single-scan plan
    Catalyst makes of ``df.subtract(valid)``, without relying on that rewrite.
    NULLs compare equal, identical rejected rows collapse to one.
    """
    return reject_all(df, rules).distinct()


def split(df: DataFrame, rules: list[Rule], rejects: str = "all") -> tuple[DataFrame, DataFrame]:
    """FLT-8: ``(valid, rejected)`` over one input.

    ``rejects="all"`` keeps every rejected row (SET-2); ``"distinct"`` is the
    EXCEPT reading (SET-1).
    """
    if rejects not in ("all", "distinct"):
        raise ValueError(f"rejects must be 'all' or 'distinct', not {rejects!r}")
    rejected = reject_all(df, rules) if rejects == "all" else reject_distinct(df, rules)
    return validate(df, rules), rejected
