"""Command-line runner for the flows (one monthly run per call).

    spark-submit stratum/run.py ingest-strings --source ".../monthly/{mon_yyyy}/deposits.csv" \\
        --period jan_2026 --table raw.deposits
    spark-submit stratum/run.py refine-validated --source raw.deposits \\
        --valid staging.deposits --rejected quarantine.deposits_rejected --silver silver.deposits

Uses the session the platform provides (``getOrCreate``) and prints the
flow's counts as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from stratum.functions.values import DATE_DAY_FIRST, DATE_ISO  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratum")
    sub = p.add_subparsers(dest="flow", required=True)

    for name in ("ingest-declared", "ingest-strings"):
        s = sub.add_parser(name)
        s.add_argument("--source", required=True, help="path template with {mon_yyyy} (and any --param)")
        s.add_argument("--period", required=True, help="mon_yyyy, e.g. jan_2026")
        s.add_argument("--param", action="append", default=[], help="extra template value key=value")
        s.add_argument("--table", required=True)
        s.add_argument("--format", default=None)
        s.add_argument("--ledger", default=None, help="ledger table: land each file once")
        s.add_argument("--spread", type=int, default=None, help="tasks for files that cannot be split")
        if name == "ingest-declared":
            s.add_argument("--columns", default="qa", help="'qa' or a comma-separated column list")

    s = sub.add_parser("refine-replace")
    s.add_argument("--source", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--dedupe", default="any", choices=["any", "first", "latest"])
    s.add_argument("--caps", action="store_true", help="capitalised output names")
    s.add_argument("--precision", type=int, default=15)
    s.add_argument("--date-format", default=DATE_DAY_FIRST)
    s.add_argument("--format", default=None, help="table format of the target, e.g. delta")

    s = sub.add_parser("refine-validated")
    for a in ("--source", "--valid", "--rejected", "--silver"):
        s.add_argument(a, required=True)
    s.add_argument("--rejects", default="distinct", choices=["distinct", "all"])
    s.add_argument("--dedupe", default="any", choices=["any", "first", "latest"])
    s.add_argument("--precision", type=int, default=18)
    s.add_argument("--date-format", default=DATE_DAY_FIRST)
    s.add_argument("--quarantine", default="append", choices=["append", "batch"],
                   help="append the rejects, or replace what the table holds of the batch")
    s.add_argument("--silver-format", default=None, help="table format of the silver table, e.g. delta")
    s.add_argument("--valid-format", default=None)
    s.add_argument("--rejected-format", default=None)

    s = sub.add_parser("refine-append")
    s.add_argument("--source", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--precision", type=int, default=18)
    s.add_argument("--date-format", default=DATE_ISO)
    s.add_argument("--format", default=None)
    s.add_argument("--ledger", default=None, help="ledger table: append each batch once")
    s.add_argument("--check", action="store_true", help="refuse rows that do not fit the target")

    for name, s in sub.choices.items():
        s.add_argument("--strict", action="store_true", help="fail on unparseable values instead of NULL")
        if name.startswith("refine"):
            s.add_argument("--writers", type=int, default=None, help="tasks of the date-partitioned write")
            s.add_argument("--empty-batch", default="stop", choices=["stop", "pass"],
                           help="stop on an empty latest batch, or pass it on (an overwrite then erases)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from stratum import plans
    from stratum.operators.contract import SILVER_8, SILVER_8_CAPS
    from stratum.sinks.ledger import Ledger
    from stratum.sources.files import QA_STRUCTURE_COLUMNS, period_path, string_schema

    spark = SparkSession.builder.appName(f"stratum-{args.flow}").getOrCreate()
    if args.flow.startswith("ingest"):
        params = dict(kv.split("=", 1) for kv in args.param)
        source = period_path(args.source, mon_yyyy=args.period, **params)
        land = {"ledger": Ledger(spark, args.ledger) if args.ledger else None, "spread": args.spread}
        if args.flow == "ingest-declared":
            cols = QA_STRUCTURE_COLUMNS if args.columns == "qa" else args.columns.split(",")
            out = plans.ingest_declared(spark, source, args.table, string_schema(cols), fmt=args.format, **land)
        else:
            out = plans.ingest_strings(spark, source, args.table, fmt=args.format, **land)
    elif args.flow == "refine-replace":
        out = plans.refine_replace(
            spark, args.source, args.target, dedupe=args.dedupe,
            contract=SILVER_8_CAPS if args.caps else SILVER_8, date_format=args.date_format,
            precision=args.precision, strict=args.strict, empty_batch=args.empty_batch, fmt=args.format, writers=args.writers,
        )
    elif args.flow == "refine-validated":
        out = plans.refine_validated(
            spark, args.source, args.valid, args.rejected, args.silver, rejects=args.rejects,
            dedupe=args.dedupe, date_format=args.date_format, precision=args.precision, strict=args.strict,
            empty_batch=args.empty_batch, writers=args.writers, quarantine=args.quarantine,
            formats={k: v for k, v in (("silver", args.silver_format), ("valid", args.valid_format),
                                         ("rejected", args.rejected_format)) if v} or None,
        )
    else:
        out = plans.refine_append(
            spark, args.source, args.target, date_format=args.date_format, precision=args.precision,
            strict=args.strict, empty_batch=args.empty_batch, fmt=args.format, writers=args.writers,
            ledger=Ledger(spark, args.ledger) if args.ledger else None, check=args.check,
        )
    print(json.dumps({"flow": args.flow, **out}))
    return out


if __name__ == "__main__":
    main()
