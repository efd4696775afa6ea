"""The Kneser-Ney model against plain counts of the same formulas."""

from __future__ import annotations

import collections
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF_SMALL, spark  # noqa: E402, F401
from stratum.llm import kneserney as kn  # noqa: E402
from stratum.llm import queries  # noqa: E402

SCHEMA = "doc_id long, text string, score double, n_tokens long, shard int, block string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START, END = object(), None


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), END]


class Plain:
    def __init__(self, texts):
        docs = [tokens(t) for t in texts]
        self.words = collections.Counter(w for d in docs for w in d)
        self.pairs = collections.Counter(p for d in docs for p in zip([START, *d], d))
        self.n_first = collections.Counter()
        for (v, _), n in self.pairs.items():
            self.n_first[v] += n
        self.ends = collections.Counter(w for _, w in self.pairs)
        self.d2, self.d1 = self.discounts(self.pairs), self.discounts(self.ends)
        self.total, self.v = sum(self.words.values()), len(self.words)
        self.left = sum(self.d(self.d1, n) for n in self.ends.values()) / max(1, len(self.pairs))
        self.rest = collections.Counter()
        for (v, _), n in self.pairs.items():
            self.rest[v] += self.d(self.d2, n)

    @staticmethod
    def discounts(counts):
        t = collections.Counter(counts.values())
        return kn.discounts([t[k] for k in (1, 2, 3, 4)])

    @staticmethod
    def d(d, n):
        return 0.0 if n == 0 else d[min(n, 3) - 1]

    def p1(self, w):
        if not self.v:
            return 1.0
        return (self.ends[w] - self.d(self.d1, self.ends[w])) / len(self.pairs) + self.left / (self.v + 1)

    def p2(self, v, w):
        n = self.n_first[v]
        if not n:
            return self.p1(w)
        c = self.pairs[v, w]
        return (c - self.d(self.d2, c) + self.rest[v] * self.p1(w)) / n

    def row(self, text):
        d = tokens(text)
        base = sum(math.log10((self.words[w] + 0.1) / (self.total + 0.1 * (self.v + 1))) for w in d)
        return len(d), sum(self.words[w] > 0 for w in d), base, sum(math.log10(self.p2(v, w)) for v, w in zip([START, *d], d))


def fixture(n=300):
    random.seed(4)
    words = ["the", "The", "né", "NÉ", "a,b", "漢字", "x" * 200, "of", "of", "of", "\u00a0", "q", "\x1c", "<s>"] + [f"w{i}" for i in range(200)]
    rows = [(i, " \n\t ".join(random.choices(words, weights=[20] * 14 + [1] * 200, k=random.randint(0, 40)))) for i in range(n)]
    rows += [(1, "the of the of"), (1, "the of the of"), (None, "the q"), (2, None), (3, ""), (10, " \x0b "), (None, "of q " * 20_000), (31, "never seen words")]
    return [(*r, 0.5, 1, 2, "b") for r in rows]


def same(got, want):
    assert got[:2] == want[:2] and got[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9)


def scored(docs, model):
    return [tuple(r) for r in kn.score(docs, model).collect()]


def test_scores_equal_plain_counts(spark, monkeypatch):  # noqa: F811
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 != 0, F.lit(True))
    plain = Plain([r[1] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3])
    # the largest count is beyond one byte; few bytes a shard make several of them
    for size in (kn.SHARD_BYTES, 20_000):
        monkeypatch.setattr(kn, "SHARD_BYTES", size)
        model = kn.fit(docs, learn)
        assert (model.shards == 1 if size > 20_000 else model.shards > 4) and max(plain.pairs.values()) > kn.LARGE
        assert (model.n_words, model.n_tokens, model.n_types) == (plain.v, plain.total, len(plain.pairs))
        assert model.pair_discounts == plain.d2 and model.type_discounts == plain.d1
        asked = sorted(((r[0] is not None, r[0] or 0), *plain.row(r[1])) for r in rows)
        found = sorted(((r[0] is not None, r[0] or 0), *r[1:]) for r in scored(docs, model))
        assert len(found) == len(rows)
        for g, w in zip(found, asked):
            assert g[0] == w[0]
            same(g[1:], w[1:])


def test_probabilities_sum_to_one(spark):  # noqa: F811
    rows = fixture(100)
    model = kn.fit(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    plain = Plain([r[1] for r in rows])
    words = [w for w in plain.words if w is not END]
    scorer = kn.Scorer(model)
    for v in ["the", "q", "w7", "never"]:
        # v w, for each word, the end and a word that is unknown; the token after v counts
        t = kn.Tokens.of(pa.array([f"{v} {w}" for w in [*words, "unseen"]] + [v]))
        _, p = scorer.probabilities(t)
        heads = np.append(0, t.ends[:-1] + 1)
        assert p[heads + 1].sum() == pytest.approx(1, abs=1e-9)


def test_without_training_rows_and_without_rows(spark):  # noqa: F811
    docs = spark.createDataFrame(fixture(5), SCHEMA)
    model = kn.fit(docs, F.lit(False))
    assert all(r[2:] == (0, 0.0, 0.0) for r in scored(docs, model))
    none = spark.createDataFrame([], SCHEMA)
    assert scored(none, kn.fit(none, F.lit(True))) == []
    assert len(scored(docs, kn.fit(spark.createDataFrame([(1, None, 0.1, 1, 1, "b")], SCHEMA), F.lit(True)))) == docs.count()


def test_query_equals_plain_counts_and_beats_single_words_on_held_out_texts(spark):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in docs}
    plain = Plain([r.text for r in docs if not held[r.doc_id]])
    got = {r.doc_id: r for r in queries.op12_kneser_ney(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        g = got[r.doc_id]
        assert (g.held_out, g.train_tokens) == (held[r.doc_id], plain.total)
        same((g.n_tokens, g.n_known, g.base_score, g.score), plain.row(r.text))
    out = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in out) > sum(g.base_score for g in out)


def test_blocks_round_trip_and_counters_flush(monkeypatch):
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5_000).astype(kn.KEY) * 2)
    n = rng.integers(0, 1 << 40, len(keys)).astype(kn.KEY)
    assert all((a == b).all() for a, b in zip(kn.unpack(kn.pack(keys, n), len(keys)), (keys, n)))
    monkeypatch.setattr(kn, "HELD", 100)
    counter, sent = kn.Counter(), collections.Counter()
    for _ in range(50):
        k, c = np.unique(rng.integers(0, 300, 40).astype(kn.KEY), return_counts=True)
        sent.update(dict(zip(k.tolist(), (-c).tolist())))
        for a, b in [counter.add(k, c) or ((), ())]:
            sent.update(dict(zip(np.asarray(a).tolist(), np.asarray(b).tolist())))
    sent.update(dict(zip(*(x.tolist() for x in counter.take()))))
    assert set(sent.values()) == {0}


def test_a_frequent_first_word_is_dealt_over_shards():
    keys = (np.full(10_000, 7, kn.KEY) << kn.KEY(32)) | np.arange(10_000, dtype=kn.KEY)
    few = kn.pair_shard(keys, np.full(10_000, 10), 64)
    many = kn.pair_shard(keys, np.full(10_000, 100 * kn.SPLIT_TOKENS), 64)
    assert len(set(few.tolist())) == 1 and len(set(many.tolist())) > 40


def test_a_folder_that_is_not_mounted_is_refused():
    assert kn.mounted("file:///x/y") == "/x/y" == kn.mounted("/x/y")
    with pytest.raises(ValueError):
        kn.mounted("s3a://bucket/x")
