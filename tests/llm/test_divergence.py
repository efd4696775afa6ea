"""Divergence audit against a plain count of the same definitions."""

from __future__ import annotations

import collections
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import spark  # noqa: E402, F401
from stratum.llm import divergence  # noqa: E402
from stratum.llm.common import ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, shard int, part string, value long, rank int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=3, top=200):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(UPPER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        count = {s: collections.Counter(t for d in mine if d[1] == s for t in d[2] if seen[t] >= min_docs) for s in {d[1] for d in mine}}
        whole = sum(count.values(), collections.Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(p, q):
            return (p - q) ** 2 // q

        for s, c in count.items():
            pairs = [(o, sum(f(share(c, t), share(count[o], t)) for t in kept)) for o in count if o != s]
            terms = [(t, f(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(items[:limit])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def fixture():
    random.seed(3)
    words = ["the", "The", "né", "Né", "ÉTÉ", "x1y", "a_b", "漢字", "z" * 300, "don't", "\U0001f600", "ﬁ", "q"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 30))), random.choice(["en", "fr", None]),
             random.choice(["s1", "s2", "s3", "Ä", None, "s1"])) for i in range(200)]
    rows += [(1, None, "en", "s1"), (1, "", "en", "empty"), (2, None, None, None), (None, "the the", "en", "s2")] * 2
    rows += [(3, "the q né " * 20_000, "fr", "s2"), (4, "alone", "de", "only"), (5, "x", "xx", "a"), (6, "\x00 12 ", "xx", "b")]
    return [(*r, "t", 1, 2, "p", 3, 4) for r in rows]


def test_audit_equals_a_plain_count(spark):  # noqa: F811
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(divergence.audit(docs)) == plain(rows)
    assert got(divergence.audit(docs, min_docs=1, top=2)) == plain(rows, 1, 2)


def test_many_shards_and_parts_give_the_same_rows(spark, monkeypatch):  # noqa: F811
    rows = fixture()
    monkeypatch.setattr(divergence, "SHARD_ROWS", 1)
    monkeypatch.setattr(divergence, "PART_SOURCES", 2)
    rows += [(i, f"w{i % 40} w{i % 7} w{i % 11} wa wb " + "".join(chr(97 + i % k) for k in (2, 3, 5, 7)), "en", "s1", "t", 1, 2, "p", 3, 4)
             for i in range(300)]
    assert got(divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=1)) == plain(rows, 1)


def test_empty_table_and_groups_without_terms(spark):  # noqa: F811
    assert got(divergence.audit(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, None, "en", s, "t", 1, 1, "p", 1, 1) for s in ("a", "b", "c")]
    assert got(divergence.audit(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert len(plain(rows)) == 6


def test_partial_counts_merge_to_the_whole(spark):  # noqa: F811
    ship_package(spark)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "source": ["a", "a", "b"], "text": ["One one, TWO", "two", ""]})
    rows = sorted((r["lang"], r["source"], r["term"] or "", r["n"], r["docs"]) for r in divergence.count_terms(batch).to_pylist())
    assert rows == [("en", "a", "", 0, 0), ("en", "a", "one", 2, 1), ("en", "a", "two", 2, 2), ("en", "b", "", 0, 0)]
    merged = divergence._merged([divergence.count_terms(batch)] * 2)
    assert {(r["source"], r["term"]): (r["n"], r["docs"]) for r in merged.to_pylist() if r["term"]} == {("a", "one"): (4, 2), ("a", "two"): (4, 4)}


def test_shares_are_exact_for_very_large_counts():
    rng = random.Random(1)
    for _ in range(2_000):
        whole = rng.randint(1, 9 * 10**15)
        c = rng.choice([0, whole - 1, rng.randint(0, whole - 1)])
        assert int(divergence.scaled(np.array([c]), np.array([whole]))[0]) == 1 + 10**9 * (c + 1) // whole


@pytest.mark.parametrize("cells", [3, 64, 1 << 20])
def test_pair_sums_equal_all_terms_visited(cells, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rng = np.random.default_rng(2)
    p0 = rng.integers(1, 50, 7)
    dense = np.where(rng.random((40, 7)) < 0.3, rng.integers(1, 10**9, (40, 7)), 0)
    dense[5] = 0  # cells hold no such term
    t, s = np.nonzero(dense)
    full = np.where(dense > 0, dense, p0)
    mine = np.array([0, 3, 6])
    want = [[sum((int(full[k, a]) - int(full[k, b])) ** 2 // int(full[k, b]) for k in range(40)) for b in range(7)] for a in mine]
    assert divergence._pairs(t, s, dense[t, s], p0, mine).tolist() == want
