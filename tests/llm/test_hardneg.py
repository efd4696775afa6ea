"""Hard negatives against a plain search over all pairs."""

from __future__ import annotations

import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import spark  # noqa: E402, F401
from stratum.llm import hardneg  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, g int, score long, rank int, anchors string"


def plain(rows, modulus, k=5):
    v = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, lab, *_ in rows
         if i is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for at, (i, lab, w) in enumerate(v):
        if i % modulus:
            continue
        others = [(-sum(a * b for a, b in zip(w, u)), j, m) for n, (j, m, u) in enumerate(v) if n != at and len(u) == len(w)]
        for ps, pid, _ in sorted((s, j, m) for s, j, m in others if m == lab)[:k]:
            low = [(s, j) for s, j, m in others if m != lab and 80 * -ps <= 100 * -s <= 100 * -ps]
            out += [(i, pid, r + 1, j, -ps, -s) for r, (s, j) in enumerate(sorted(low)[:k])]
    return sorted(out)


def got(spark, rows, modulus, k=5):  # noqa: F811
    frame = hardneg.weighted(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("label"), F.col("vec_id") % modulus == 0)
    return sorted(tuple(r) for r in hardneg.mine(frame, k).collect())


def fixture(n=200, dims=21):
    random.seed(7)
    rows = [(i, [random.choice([-1.0, 0.0, 0.25, 1.0, random.random()]) for _ in range(dims)], random.choice([0, 1, 1, 2])) for i in range(n)]
    rows += [(5, rows[5][1], rows[5][2])] * 3 + [(10, rows[3][1], 0), (10, rows[3][1], 1)] * 2  # repeated rows and ids, ties
    rows += [(20, [1.0, 2.0], 0), (21, [1.0, 1.9], 0), (22, [0.9, 2.0], 1), (23, [], 0), (30, [], 0), (31, [], 1)]
    rows += [(None, rows[0][1], 1), (40, None, 1), (50, rows[0][1], None), (60, [float("nan")] * dims, 1), (70, [None] * dims, 1), (80, [float("inf")] * dims, 1)]
    return [(*r, 1, 2, 3, "a") for r in rows]


def test_negatives_equal_all_pairs(spark, monkeypatch):  # noqa: F811
    rows = fixture()
    want = plain(rows, 5)
    assert got(spark, rows, 5) == want and len(want) > 300
    assert got(spark, rows, 3, 2) == plain(rows, 3, 2)
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hardneg, "ANCHOR_ROWS", 7)
    assert got(spark, rows, 5) == want


def test_tables_without_answers(spark):  # noqa: F811
    assert got(spark, [], 5) == []
    assert got(spark, [(1, [0.5, 0.5], 0, 1, 1, 1, "a"), (2, [0.5, 0.4], 0, 1, 1, 1, "a")], 7) == []  # no anchor
    assert got(spark, [(7, [0.5, 0.5], 0, 1, 1, 1, "a"), (8, [0.5, 0.4], 1, 1, 1, 1, "a")], 7) == []  # no positive
    negative = [(7, [1.0], 0), (8, [-1.0], 0), (9, [-0.9], 1)]  # a negative positive score has no range
    assert got(spark, [(*r, 1, 1, 1, "a") for r in negative], 7) == plain(negative, 7) == []


@pytest.mark.parametrize("dims", [1, 4, 15, 16, 17, 64, 70])
def test_bounds_hold_and_tighten(dims):
    rng = np.random.default_rng(dims)
    q, r = (np.floor(256 * rng.normal(size=(n, dims)) + rng.normal(size=(n, 1)) * 500) for n in (30, 40))
    exact, widths = q @ r.T, []
    for a, b, size in zip(hardneg.summaries(q), hardneg.summaries(r), hardneg.segment_lengths(dims)):
        low, high = hardneg.bounds(a, b, size, np.full(exact.shape, 1e-6))
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True)


def test_clustered_rows_are_mostly_not_scored():
    rng = np.random.default_rng(5)
    centres = np.repeat(rng.normal(size=(20, 8)) * 300, 8, axis=1)  # steady within segments
    member = rng.integers(0, 20, 4_000)
    w = np.floor(centres[member] + rng.normal(size=(4_000, 64)) * 5)
    rows, asked = hardneg.Block.of(np.arange(4_000), np.zeros(4_000, np.int64), w), hardneg.Block.of(np.arange(20), np.zeros(20, np.int64), w[:20])
    every = np.ones((20, 1), np.int64)
    best, ids, taken = hardneg.search(rows, asked, True, every * (2**63 - 1), every * hardneg.NONE, np.arange(20), 5)
    exact = (w[:20] @ w.T).astype(np.int64)
    exact[np.arange(20), np.arange(20)] = hardneg.NONE
    assert (best[:, 0] == -np.sort(-exact, axis=1)[:, :5]).all() and taken < 0.3 * exact.size


def test_large_weights_are_exact_or_refused():
    for size, exact in ((2.0**26, True), (2.0**33, False)):
        w = np.array([[size, size - 1], [size - 3, -1.0]])
        rows = hardneg.Block.of(np.arange(2), np.zeros(2, np.int64), w)
        every = np.ones((2, 1), np.int64)
        ask = lambda: hardneg.search(rows, rows, True, every * (2**63 - 1), every * hardneg.NONE, np.arange(2), 1)  # noqa: B023, E731
        if exact:
            assert ask()[0][0, 0, 0] == sum(int(a) * int(b) for a, b in zip(*w))
        else:
            with pytest.raises(OverflowError):
                ask()
