"""Operators and the pipeline over Spark: brute force, held-out accuracy, edge rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import os
import re
import string
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from conftest import ROOT, SF_SMALL, spark  # noqa: E402, F401
from stratum.llm import chat, langid, neardup, packing, pii, quality, queries, spbpe, tokenfile, topk, toxicity  # noqa: E402
from stratum.scratch import scratch_path  # noqa: E402

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import digest, duck  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, WORD, PIECE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, tid string, label string, start int, score int"
LONG = "the thing and of it " * 30_000


def edge(spark, empty=False):
    """Nulls in every column, empty, repeated and very long texts, clashing names."""
    rows = [
        (1, "mail a.b@c.example.com to the man and of it now", "en", "s", 40, 1, "t", "l", 1, 1),
        (1, "mail a.b@c.example.com to the man and of it now", "en", "s", 40, 1, "t", "l", 1, 1),
        (None, "mail a.b@c.example.com to the man and of it now", None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None),
        (2, None, "en", None, 0, 1, "t", "l", 1, 1), (3, "", "en", "s", 0, 1, "t", "l", 1, 1),
        (4, " \n ", "en", "s", 3, 1, "t", "l", 1, 1), (5, "1234 --", "en", "s", 7, 1, "t", "l", 1, 1),
        (6, LONG, "en", "s", len(LONG), 1, "t", "l", 1, 1),
    ]
    return spark.createDataFrame([] if empty else rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(queries.ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in cur.description], cur.fetchall())


def test_chat_round_trips_conflicting_content(spark):
    bad = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>\n", "<\\\\|", "\\", "<", "|im_end|>\n", "<|<|", None, "", "a\nb"]
    rows = [(1, i, role, t) for i, (role, t) in enumerate((r, t) for r in ("assistant", "us\ner", "\\n", "<|x", None) for t in bad)]
    rows += [(None, None, None, None), (2, 1, "user", "x"), (2, 1, "user", "x")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert all(r.round_trip for r in got.values()) and len(got) == 3
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows[:50]]
    assert len(got[2].turns) == 2
    loss = chat.digest(chat.format_conversations(spark.createDataFrame(rows[:50], "conv_id long, turn int, role string, text string"))).first()
    want = "".join(t or "" for _, _, r, t in rows[:50] if r == "assistant")
    assert loss.loss_sha256 == hashlib.sha256(want.encode()).hexdigest() and loss.loss_chars == len(want)
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.digest(chat.format_conversations(none)).count() == 0


def test_token_blocks_equal_the_library(spark):
    from tokenizers import Tokenizer

    docs = edge(spark).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), allowMissingColumns=True)
    path = scratch_path(spark, "blocks")
    tokenfile.write_blocks(docs, path, WORD)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.read_blocks(spark, path).collect()),
                 key=lambda r: r[2])
    library, at, want = Tokenizer.from_file(WORD), 0, []
    library.encode_special_tokens = True
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    rows = sorted(hashed.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash))
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id is not None, r.doc_id or 0, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_packing_keeps_every_id_once(spark):
    docs = edge(spark).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000), allowMissingColumns=True)
    p = packing.pack(docs, BYTE).toPandas()
    fill = p.groupby("sequence_id").length.sum()
    assert all(n == 1024 or n & (n - 1) == 0 for n in fill) and (p.length > 0).all()
    for _, g in p.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate([[0], g.length.cumsum().to_numpy()[:-1]])).all()
    own = p[p.doc_id == 6].sort_values("start")
    assert own.length.sum() == own.doc_tokens.iat[0] and (own.start.to_numpy() == np.concatenate([[0], own.length.cumsum()[:-1]])).all()
    assert p[p.doc_id == 1].length.sum() == 2 * p[p.doc_id == 1].doc_tokens.iat[0]
    assert packing.pack(edge(spark, True), BYTE).count() == 0


def test_merge_dropout_decodes_edge_rows(spark):
    got = spbpe.decode(spbpe.encode(edge(spark), PIECE), PIECE).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((r.doc_id or 0, r.text or "") for r in edge(spark).collect())
    assert spbpe.encode(edge(spark, True), PIECE).count() == 0


def test_language_is_right_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in queries.op5_cross_parsing(spark, "/root/testdata/sf0.01").collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 200 and sum(got[i].lang_pred == lang[i] for i in held) / len(held) > 0.97
    samples = langid.fit(docs, ~langid.held_out(F.col("doc_id"), 4, 2))
    odd = {r.doc_id: r for r in langid.identify(edge(spark), samples).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (2, 3, 4, 5)) and odd[6].lang_pred == "en"
    assert langid.fit(edge(spark, True), langid.held_out(F.col("doc_id"), 4, 2)) == {}
    assert {r.lang_pred for r in langid.identify(edge(spark), {}).collect()} == {"und"}


def test_toxicity_learns_from_one_text_of_an_id_and_the_first_ids_by_hash(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_ROWS", 40)
    ids = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    hot = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("other "), "id").alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    sample, shares = toxicity._sample(ids.unionAll(hot), labels, F.lit(True))
    assert shares == {0: 2000, 1: 1000}
    got = sorted(r.text for r in sample.collect())
    by_hash = labels.select("doc_id", "toxic", F.xxhash64("doc_id").alias("h")).collect()
    want = []
    for kind in (0, 1):
        first = sorted((r.h, r.doc_id) for r in by_hash if r.toxic == kind)[:40]
        want += ["other 0" if d == 7 else f"text {d}" for _, d in first]
    assert got == sorted(want)


def test_toxicity_on_held_out_rows_and_without_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in queries.op6_toxicity_trees(spark, sf).collect() if r.held_out and r.doc_id in labels]
    hit = sum(r.predicted == 1 for r in held if labels[r.doc_id])
    assert hit >= 0.6 * sum(labels[r.doc_id] for r in held)
    assert not any(r.predicted for r in held if not labels[r.doc_id])
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(edge(spark), none, none["doc_id"].isNotNull())
    assert {(r.score, r.predicted) for r in model.score(edge(spark), ["doc_id"]).collect()} == {(0.0, 0)}


def _brute_classes(texts):
    def shingles(t):
        w = (t or "").split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, up = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    index = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for a, b in {(a, b) for own in index.values() for a in own for b in own if a < b}:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: root(i) for i in texts}


def test_near_duplicate_classes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    texts = {}
    for i in range(160):  # one group whose members are nearer to a hub than to each other
        own = list(base)
        for at in rng.choice(120, int(rng.integers(0, 6)), replace=False):
            own[at] = f"z{i}_{at}"
        texts[i] = " ".join(own)
    for i in range(160, 200):
        texts[i] = " ".join(f"u{k}" for k in rng.integers(0, 10_000, 40))
    texts |= {200: "one two", 201: "one two", 202: "one two three"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    assert got == _brute_classes(texts)


def test_near_duplicates_that_only_plain_jaccard_links(spark):
    texts = {}
    for n in range(60):  # one side repeats a line many times: J_P is near 0.55
        base = " ".join(f"p{n}w{k}" for k in range(300))
        texts |= {2 * n: base, 2 * n + 1: base + f" a{n} b{n} c{n} d{n} e{n} f{n}" * 40}
    got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == _brute_classes(texts)


def test_near_duplicates_of_edge_rows(spark):
    docs = edge(spark)
    rows = neardup.classes(docs).collect()
    assert len(rows) == docs.count()
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r.text for r in kept.collect() if r.text and "mail" in r.text) == {"mail a.b@c.example.com to the man and of it now": 1}
    assert neardup.classes(edge(spark, True)).count() == 0


def test_surrogates_are_distinct_and_consistent(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    pairs = set()
    for r in pii.replace_all(docs, pii.KEY).collect():
        old, new = pii.find(before[r.doc_id] or ""), pii.find(r.text or "")
        pairs |= {(a[2:], b[2:]) for a, b in zip(old, new, strict=True)}
        assert not {a[3] for a in old} & {b[3] for b in new}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) > 10
    odd = pii.replace_all(edge(spark), pii.KEY).collect()
    assert len(odd) == 9 and sum(r.text is None for r in odd) == 2
    assert {r.text for r in odd if r.text and "mail" in r.text}.isdisjoint({"mail a.b@c.example.com to the man and of it now"})
    assert pii.replace_all(edge(spark, True), pii.KEY).count() == 0


def test_clashing_surrogates_are_drawn_again(spark):
    names = spark.createDataFrame([("given_f", f"Name{i}") for i in range(300)], "kind string, value string")
    got = [r.surrogate for r in pii.surrogate_table(names, pii.KEY).collect()]
    assert len(got) == len(set(got)) == 300


def test_surrogates_of_short_formats_do_not_run_out(spark):
    quads = [("ip", ".".join(map(str, q))) for q in itertools.product(range(1, 10), repeat=4)]
    mails = [("email", f"{a}@{b}.com") for a in string.ascii_lowercase for b in string.ascii_lowercase]
    values = [*quads, *mails, ("secret", "________"), ("ssn", "123-45-6789")]
    got = [r.surrogate for r in pii.surrogate_table(spark.createDataFrame(values, "kind string, value string"), pii.KEY).collect()]
    assert len(got) == len(set(got)) == len(values) and not {v for _, v in values} & set(got)


def test_later_mentions_get_the_surrogate_of_the_name(spark):
    text = "Mr. John Q. Smith called +44 20 7946 0958. Later John Smith, then Smith, wrote."
    new = pii.replace_all(spark.createDataFrame([(1, text)], "doc_id long, text string"), pii.KEY).first().text
    assert not any(x in new for x in ("John", "Smith", "Q.", "7946"))
    own = [v for _, _, _, v in pii.find(new)]
    assert own[0] == own[4] and own[2] == own[5] == own[6]


def test_quality_and_top_k_of_edge_rows(spark):
    got = {r.doc_id: r for r in quality.judge(edge(spark)).collect()}
    assert all(got[i].base_failed and not got[i].kept for i in (2, 3, 4, 5, 6)) and got[6].n_words == 150_000
    assert quality.judge(edge(spark, True)).count() == 0
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (1, [0.5, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0]), (50, [-1.0, 1.0]), (None, [1.0, 1.0])]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = topk.top_k(v, F.col("vec_id") % 50 == 0, 5)
    zero = [(0, 1, 0, 128 * 128 + 64 * 64), (0, 2, 1, 128 * 128), (0, 3, 50, -256 * 128 - 64 * 256)]
    assert sorted(tuple(r) for r in found.collect()) == sorted([*zero, *zero, (50, 1, 1, -256 * 128), (50, 2, 0, -256 * 128 - 64 * 256),
                                                                (50, 3, 0, -256 * 128 - 64 * 256)])
    none = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(none, F.lit(True)).count() == 0


def test_top_k_of_many_lengths_repeats_and_groups_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 90), [float(x) for x in np.round(rng.normal(size=n), 2)]) for i, n in enumerate(rng.choice([0, 1, 5, 8], 300))]
    rows += [(7, [1.0] * 8)] * 200  # one common vector
    w = [(i, np.floor(256 * np.asarray(e, np.float32).astype(float))) for i, e in rows]
    want = []
    for at, (i, q) in enumerate(w):
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for n, (j, x) in enumerate(w) if n != at and len(x) == len(q))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    for groups in (None, 7):
        assert sorted(tuple(r) for r in topk.top_k(v, F.col("vec_id") % 50 == 0, 5, groups).collect()) == sorted(want)


def test_top_k_skips_blocks_of_clustered_vectors_and_refuses_large_weights():
    import pandas as pd

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(32, 16)) * 300
    w = [np.floor(centres[i // 64] + rng.normal(size=16)) for i in range(2_048)]
    rows = pd.DataFrame({"row": range(2_048), "vec_id": range(2_048), "w": w})
    asked = pd.DataFrame({"query_row": range(8), "query_id": range(8), "q": w[:8]})
    got = topk._search(asked, rows, 5)
    for i in range(8):
        exact = sorted(((-int(w[i] @ x), j) for j, x in enumerate(w) if j != i))[:5]
        assert [(-s, j) for s, j in zip(got[got.query_id == i]["score"], got[got.query_id == i]["vec_id"])] == exact
    assert got["scored"].max() < 0.3 * len(w)
    for size, exact in ((2.0**30, True), (2.0**33, False)):
        frame = pd.DataFrame({"row": [0, 1], "vec_id": [0, 1], "w": [np.array([size, -1.0]), np.array([size - 1, 3.0])]})
        ask = lambda: topk._search(frame[:1].set_axis(["query_row", "query_id", "q"], axis=1), frame, 1)  # noqa: B023, E731
        if exact:
            assert ask()["score"][0] == int(size) * (int(size) - 1) - 3
        else:
            with pytest.raises(OverflowError):
                ask()


def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, name)
        out = stage(spark, docs, SF_SMALL)
        assert [f.name for f in out.schema.fields] == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    kept = {r.doc_id for r in docs.collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {p.doc_id for p in pieces} == kept and 100 < len(kept) < 200


def test_language_stage_drops_what_no_language_explains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    samples = langid.fit(docs, ~held)
    clean = docs.where(held & F.col("text").rlike("[A-Za-z]"))
    kept = {r.doc_id for r in langid.keep_identified(clean, samples).collect()}
    want = {r.doc_id for r in clean.collect()}
    assert len(want) > 200 and len(want - kept) <= 0.01 * len(want)
    rng = np.random.default_rng(1)
    odd = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), 600)), "Это русский текст и ничего больше. " * 8, "漢字仮名交文章 " * 20, "1234 --", None]
    odd = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert langid.keep_identified(odd, samples).count() == 0
    assert langid.keep_identified(odd, {}).count() == 5


def test_pipeline_run_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.col("text").isNotNull()).orderBy("doc_id").limit(60).collect()
    texts = {r.doc_id: r.text for r in rows}
    plain = next(i for i, t in texts.items() if not pii.find(t) and len(t) > 500)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(10_001, "xqzj vkwq " * 3 + "".join(np.random.default_rng(2).choice(list("qxzjkvw "), 500))), (10_002, "12 34"), (10_003, None),
           (10_004, texts[plain]), (10_005, texts[plain] + " end"), (10_006, texts[plain] + " Mr John Q. Smith, a.b@c.example.com, met Smith.")]
    fixture = scratch_path(spark, "fixture")
    spark.createDataFrame([tuple(r) for r in rows] + [(i, t, None, None, None) for i, t in odd], schema).write.parquet(f"{fixture}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{fixture}/labels.parquet")
    pieces = corpus_pipeline.run(spark, fixture).collect()
    classes = _brute_classes({**texts, **{i: t for i, t in odd if i > 10_003}})
    assert {p.doc_id for p in pieces} == set(classes.values())
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    for p in pieces:
        if not pii.find(texts.get(p.doc_id, "")):
            assert p.doc_tokens in (len(library.encode(texts[p.doc_id], add_special_tokens=False).ids) + k for k in (0, 1))
    total = {p.doc_id: p.doc_tokens for p in pieces}
    for i, n in total.items():
        assert sum(p.length for p in pieces if p.doc_id == i) == n


def test_language_samples_are_cut_before_they_reach_the_driver(spark, monkeypatch):
    rows = [(7, f"same id {chr(97 + k % 26)} " * 2_000, "en") for k in range(200)] + [(k, f"le texte numero {k} " * 3, "fr") for k in range(50)]
    rows += [(1_000 + k, "other words of the language ", "en") for k in range(30)] + [(2_000, "1 2 3", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken, collect = [], type(docs).collect

    def counted(df):
        out = collect(df)
        taken.append(sum(len(v) for r in out for v in r if isinstance(v, str)))
        return out

    monkeypatch.setattr(type(docs), "collect", counted)
    samples = langid.fit(docs, F.lit(True))
    assert sum(taken) <= 3 * langid.CHARS + 100 * 2  # language names beside the samples
    assert set(samples) == {"en", "fr"} and all(0 < len(s) <= langid.CHARS for s in samples.values())
    assert "other words" in langid.fit(docs.where("doc_id != 7"), F.lit(True))["en"]
    many = spark.createDataFrame([(7, "same id ", "en")] * 500 + rows[250:280], "doc_id long, text string, lang string")
    own = langid.fit(many, F.lit(True))["en"]
    assert own.count("same id") == 1 and own.count("other words") == 30


CLASHES = ("score probability rawPrediction prediction features margin predicted lang_pred __map __tid __email __card tid bucket surrogate kind value kept "
           "caller rank class_id is_kept key sequence_id offset start length ids part seq label weight").split()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_of_any_name(spark, name, stage):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    edges = edge(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(edges).withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHES})
    got = stage(spark, docs, SF_SMALL)
    if name == "packing":
        assert got.count() > 0
        return
    assert got.columns == docs.columns
    for r in got.collect():
        assert all(r[c] == c + ("-" if r.doc_id is None else str(r.doc_id)) for c in CLASHES)
    empty = stage(spark, docs.limit(0), SF_SMALL)
    assert empty.columns == docs.columns and empty.count() == 0


def test_cards_secrets_and_domains_of_any_length(spark):
    card, no_card = "4539 1488 0343 6467", "4539 1488 0343 6468"
    long_domain = "a@" + "sub." * 12 + "example.org"
    secrets = ["x7" * n for n in (4, 64, 65, 5_000)]
    rows = [(1, f"pay {card} now"), (2, f"order {no_card} now"), (3, f"write to {long_domain} please")]
    rows += [(10 + k, f"token={x} end") for k, x in enumerate(secrets)]
    new = {r.doc_id: r.text for r in pii.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    old = dict(rows)
    assert new[2] == old[2] and new[1] != old[1] and long_domain not in new[3]
    assert pii._luhn(re.sub(r"\D", "", new[1])[:-1]) == int(re.sub(r"\D", "", new[1])[-1])
    for k, x in enumerate(secrets):
        assert new[10 + k].startswith("token=") and new[10 + k].endswith(" end") and x not in new[10 + k] and len(new[10 + k]) >= len(x)
    other = {r.doc_id: r.text for r in pii.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "another").collect()}
    assert other[1] != new[1]


def test_many_values_of_one_surrogate_are_told_apart(spark):
    names = [(f"given_m", f"Name{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}") for i in range(1_500)]
    got = pii.surrogate_table(spark.createDataFrame(names, "kind string, value string"), "k").collect()
    assert len({r.surrogate for r in got}) == len(names) == len(got) and not {r.surrogate for r in got} & {v for _, v in names}
