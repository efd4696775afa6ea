"""The command-line runner drives the flows end to end."""

from __future__ import annotations

import uuid

from stratum import run
from stratum.sinks import write_csv
from stratum.sources import DEPOSIT_COLUMNS, deposits_from_orders

from conftest import SF_SMALL


def test_run_ingest_then_refine(spark, tmp_dir):
    dep = deposits_from_orders(spark, SF_SMALL).where("ingestion_timestamp = timestamp_ntz'2026-03-05 00:00:00'")
    write_csv(dep.select(*DEPOSIT_COLUMNS), f"{tmp_dir}/monthly/mar_2026/deposits.csv")
    tag = uuid.uuid4().hex[:8]
    raw, valid, rej, silver = (f"{n}_{tag}" for n in ("raw", "valid", "rej", "silver"))
    landed = run.main(["ingest-strings", "--source", tmp_dir + "/monthly/{mon_yyyy}/deposits.csv",
                       "--period", "mar_2026", "--table", raw])
    assert landed["rows"] == dep.count() == spark.table(raw).count()
    audit = run.main(["refine-validated", "--source", raw, "--valid", valid, "--rejected", rej,
                      "--silver", silver])
    assert audit["processed"] == landed["rows"]
    assert audit["written"] == spark.table(silver).count() > 0


def test_run_declared_replace_and_append(spark, tmp_dir):
    import os

    from stratum.sources import QA_STRUCTURE_COLUMNS, deposits_iso

    os.makedirs(f"{tmp_dir}/qa/jan_2026")
    with open(f"{tmp_dir}/qa/jan_2026/project_structure.csv", "w") as f:
        f.write(",".join(QA_STRUCTURE_COLUMNS) + "\nF1,a,b,c,d,1,2,2026-01-01,ok\nF2,bad\n")
    tag = uuid.uuid4().hex[:8]
    qa = run.main(["ingest-declared", "--source", tmp_dir + "/qa/{mon_yyyy}/project_structure.csv",
                   "--period", "jan_2026", "--table", f"qa_{tag}"])
    assert qa["rows"] == 2 and spark.table(f"qa_{tag}").where("_corrupt_record IS NOT NULL").count() == 1

    raw = f"raw2_{tag}"
    deposits_from_orders(spark, SF_SMALL).write.saveAsTable(raw)
    out = run.main(["refine-replace", "--source", raw, "--target", f"caps_{tag}", "--caps"])
    assert out["written"] == spark.table(f"caps_{tag}").count()
    assert spark.table(f"caps_{tag}").columns[0] == "Deposit_id"

    validated = f"val_{tag}"
    deposits_iso(spark, SF_SMALL).write.saveAsTable(validated)
    app = run.main(["refine-append", "--source", validated, "--target", f"hist_{tag}"])
    assert app["written"] == 510 and "CUSTOMER_ID" in spark.table(f"hist_{tag}").columns
