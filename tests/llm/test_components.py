"""Connected components against a plain union-find."""

from __future__ import annotations

import random

from stratum.llm.components import components


def _least(pairs):
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def _labels(spark, pairs):
    return {r.node: r.label for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}


def test_components_equal_union_find(spark):
    rng = random.Random(7)
    path = [(i + 1, i) if i % 2 else (i, i + 1) for i in range(20)]
    ring = [(100 + i, 100 + (i + 1) % 6) for i in range(6)]
    star = [(200, 200 + i) for i in range(1, 8)]
    mixed = [(300 + rng.randrange(30), 300 + rng.randrange(30)) for _ in range(25)]
    pairs = path + ring + star + star + mixed
    expected = {n: least for n, least in _least(pairs).items() if n != least}
    assert _labels(spark, pairs) == expected


def test_settled_or_empty_edges(spark):
    assert _labels(spark, [(2, 1), (1, 3)]) == {2: 1, 3: 1}
    assert _labels(spark, [(5, 5)]) == {}
    assert _labels(spark, []) == {}
