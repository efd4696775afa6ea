"""The README's inventory table names every registered check, and only those."""

from __future__ import annotations

import os
import re

from stratum.checks.catalog import QUERIES

from conftest import ROOT


def test_readme_inventory_lists_every_check():
    text = open(os.path.join(ROOT, "README.md")).read()
    table = text[text.index("## Inventory coverage"):text.index("Conflicts inside the reference")]
    check_cells = [line.rsplit("|", 2)[-2] for line in table.splitlines() if line.startswith("| ")]
    named = set(re.findall(r"`([a-z_0-9]+)`", " ".join(check_cells)))
    registered = set(QUERIES)
    assert registered <= named, sorted(registered - named)
