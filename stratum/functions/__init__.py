"""Scalar ``Column -> Column`` functions: parsing, predicates, lineage."""

from stratum.functions.lineage import ingestion_time, source_file
from stratum.functions.predicates import (
    EMAIL_PATTERN,
    PHONE_PATTERN,
    SENTINEL,
    all_of,
    email_ok,
    matches,
    not_blank,
    not_null,
    not_sentinel,
    phone_ok,
    present,
)
from stratum.functions.values import (
    DATE_DAY_FIRST,
    DATE_ISO,
    MONEY_STRIP,
    as_date,
    as_string,
    cast_to,
    parse_date,
    parse_int,
    parse_money,
    strip_chars,
)

__all__ = [
    "DATE_DAY_FIRST", "DATE_ISO", "EMAIL_PATTERN", "MONEY_STRIP", "PHONE_PATTERN", "SENTINEL",
    "all_of", "as_date", "as_string", "cast_to", "email_ok", "ingestion_time", "matches",
    "not_blank", "not_null", "not_sentinel", "parse_date", "parse_int", "parse_money",
    "phone_ok", "present", "source_file", "strip_chars",
]
