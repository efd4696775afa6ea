"""Operators without SQL against plain loops over a small table."""

from __future__ import annotations

import collections
import functools
import math
import os
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF_SMALL, spark  # noqa: E402, F401
from stratum.llm import chat, langid, packing, pii, queries, spbpe, tokenfile, toxicity  # noqa: E402
from stratum.llm.textnum import mix  # noqa: E402
from stratum.scratch import scratch_path  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, WORD, PIECE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@functools.cache
def library(path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


def library_ids(path, text, end):
    return [*library(path).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def hot(spark):
    """A third of all rows have one id, most of these one text."""
    rows = [(i, f"row {i} of the table") for i in range(400)]
    rows += [(7, "one text of many rows")] * 150 + [(7, f"text {i} of one id") for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


def test_packed_pieces_hold_the_library_ids(spark):
    want = {r.doc_id: library_ids(BYTE, r.text, 0) for r in documents(spark).collect()}
    pieces = queries.QUERIES["op4_curve_packing"](spark, SF_SMALL).collect()
    got = collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        ids = want[p.doc_id]
        assert p.start == sum(got[p.doc_id]) and p.doc_tokens == len(ids)
        assert p.ids_crc32 == crc(ids[p.start:p.start + p.length])
        got[p.doc_id].append(p.length)
    assert {d: sum(n) for d, n in got.items()} == {d: len(ids) for d, ids in want.items()}


def test_curve_neighbours_share_more_words_than_random_ones():
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    bags = [set(t.split()) for t in texts]
    h, doc = packing.words([t.encode() for t in texts])
    order = np.argsort(packing.hilbert_key(packing.project(h, doc, len(texts))), kind="stable")

    def overlap(order):
        return np.mean([len(bags[a] & bags[b]) / max(1, len(bags[a] | bags[b])) for a, b in zip(order[:-1], order[1:])])

    assert overlap(order) > 3 * overlap(np.random.default_rng(1).permutation(len(texts)))


def test_hot_ids_and_rows_are_dealt_over_ranges(spark):
    docs = hot(spark)
    path = scratch_path(spark, "hot-blocks")
    tokenfile.write_blocks(docs, path, WORD, range_bytes=1_000)
    blocks = spark.read.parquet(path)
    of_part = dict(blocks.groupBy("part").sum("n_ids").collect())
    assert len(of_part) > 10 and max(of_part.values()) < sum(of_part.values()) / 5
    read = sorted(tokenfile.read_blocks(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == sorted(r.doc_id for r in docs.collect())
    at = 0
    for r in read:
        assert r.start == at
        at += r.n_tokens
    texts = collections.Counter((r.doc_id, crc(library_ids(WORD, r.text, 1))) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in read) == texts

    pieces = packing.pack(docs, BYTE, range_bytes=1_000).where("doc_id = 7").groupBy((F.col("sequence_id") / (1 << 32)).cast("int")).count().collect()
    assert len(pieces) > 5 and max(r["count"] for r in pieces) < 100


def test_chat_pieces_are_escaped_only_where_the_parse_differs(spark):
    texts = ["plain", "<|x|>", "<\\|x", "<|im_end|>\n", "a < b | c", "ends with <", "|", "\\n", "a\nb", ""]
    rows = [(k, 1, "assistant", t) for k, t in enumerate(texts)] + [(k + 50, 1, t, "x") for k, t in enumerate(texts)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    for r in got.collect():
        source = rows[r.conv_id if r.conv_id < 50 else r.conv_id - 50 + len(texts)]
        assert r.round_trip and [tuple(t) for t in r.turns] == [source[2:]]
        assert r.formatted.count("<|") == 2
        plain = f"<|im_start|>{source[2]}\n{source[3]}<|im_end|>\n"
        harmless = not re.search(r"<\\*\|", source[2] + "\0" + source[3]) and not re.search(r"[\n\\]", source[2])
        assert (r.formatted == plain) == harmless, source


def skipped(base, left, right, place, rate):
    key = np.uint64(base) ^ spbpe._candidate(*(np.array([x], np.uint64) for x in (left, right, place)))[0]
    return float(mix(np.array([key]))[0] >> np.uint64(11)) * 2.0**-53 < rate


def plain_agenda(pieces, segment, base, rate):
    """Best merge first, leftmost among equals, over a list of live symbols; a candidate
    (pair at a place) that was skipped is not offered again."""
    sym = [(i, int(pieces.char[ord(c)])) for i, c in enumerate(segment)]
    barred = set()
    while True:
        found = [(pieces.merge[a, b][0], i, k, a, b) for k, ((i, a), (_, b)) in enumerate(zip(sym, sym[1:]))
                 if (a, b) in pieces.merge and (i, a, b) not in barred]
        if not found:
            return [s for _, s in sym]
        _, i, k, a, b = min(found)
        if skipped(base, a, b, i, rate):
            barred.add((i, a, b))
        else:
            sym[k:k + 2] = [(i, pieces.merge[a, b][1])]


def test_merge_dropout_equals_a_plain_agenda(spark):
    pieces = spbpe.Pieces.get(PIECE, 0.3)
    docs = documents(spark).orderBy(F.length("text")).limit(90)
    keys = {r.doc_id: r.key for r in docs.select("doc_id", F.xxhash64(F.lit(spbpe.SEED), "doc_id").alias("key")).collect()}
    got = {r.doc_id: np.frombuffer(r.ids, spbpe.ID_TYPE).tolist() for r in spbpe.encode(docs, PIECE, rate=0.3).collect()}
    compared = 0
    for r in docs.collect():
        segments = re.findall(r" *[^ \n]+|\n| +", " " + r.text) if r.text else []
        if any(pieces.char[ord(c)] < 0 for s in segments for c in s):
            continue  # written as byte pieces
        salt = mix(np.array([keys[r.doc_id]], np.int64).view(np.uint64) ^ np.uint64(spbpe._base(spbpe.SEED, 0)))
        want = []
        for nth, s in enumerate(segments):
            want += plain_agenda(pieces, s, int(spbpe._at(salt, np.array([nth]))[0]), 0.3)
        assert got[r.doc_id] == want, r.doc_id
        compared += 1
    assert compared > 20


def test_language_equals_plain_longest_matches(spark):
    docs = documents(spark)
    samples = langid.fit(docs, ~langid.held_out(F.col("doc_id"), 4, 2))
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, samples).collect()}
    worth = {name: math.log(max(len(s), langid.LEAST)) for name, s in samples.items()}

    def phrases(text, sample):
        """Lanes of LANE characters, each cut greedily into longest parts of the sample."""
        n = 0
        for lane in range(0, len(text), langid.LANE):
            part, phrase, n = text[lane:lane + langid.LANE], "", n + 1
            for c in part:
                if phrase + c in sample:
                    phrase += c
                else:
                    phrase, n = c if c in sample else "", n + 1
        return n

    for r in docs.orderBy(F.crc32(F.col("doc_id").cast("string"))).limit(40).collect():
        codes, _ = langid.normalised([r.text])
        text = "".join(" " if c == 0 else chr(c) for c in codes.tolist())
        need = {name: phrases(text, s) * worth[name] for name, s in samples.items()}
        want = "und" if not len(text) else min(sorted(need), key=lambda name: need[name])
        assert got[r.doc_id] == want, (r.doc_id, need)


def test_a_language_with_a_short_sample_cuts_no_other_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    samples = langid.fit(docs, ~held)
    poor = sorted(samples)[1]
    short = dict(samples, **{poor: samples[poor][:1500]})
    labelled = docs.where(held & F.col("lang").isin(*samples) & (F.length("text") > 100))
    want = {r.doc_id: r.lang for r in labelled.select("doc_id", "lang").collect()}
    got = {r.doc_id: r.lang_pred for r in langid.identify(labelled, short).collect()}
    for lang in samples:
        own = [d for d in want if want[d] == lang]
        assert sum(got[d] == lang for d in own) >= 0.95 * len(own), lang
    few = docs.where(~held & (F.col("lang") == poor)).orderBy("doc_id").limit(1)
    fitted = langid.fit(docs.where(F.col("lang") != poor).unionAll(few), ~held)
    assert {k: v for k, v in fitted.items() if k != poor} == {k: v for k, v in samples.items() if k != poor}
    assert 0 < len(fitted[poor]) < len(samples[poor])


def test_toxicity_features_equal_a_plain_loop(spark):
    words, opens = [*toxicity.INSULTS, "was"], ["idio", "stup"]
    texts = [r.text or "" for r in documents(spark).collect()[:60]]
    texts += ["", "YOU idiotic l.o.s.e.r!!! soooo st*pid, you", "trash " * 300, "a you b c d e f moron", "\n\t "]
    got = toxicity.features(texts, (toxicity.term_hashes(words), toxicity.term_hashes(opens)))
    for t, row in zip(texts, got):
        tokens = re.findall(r"[^\W\d_]+", t)
        if "".join(tokens) != "".join(c for c in t if c.isalpha()):
            continue  # letters that the two classes of letters see differently
        low = [w.lower() for w in tokens]
        hit = [w in words for w in low]
        open_ = [x or any(len(w) > k and w[:k] in opens for k in toxicity.PREFIXES) for x, w in zip(hit, low)]
        near = [o and any(w in toxicity.YOU for w in low[max(0, k - toxicity.NEAR):k + toxicity.NEAR + 1]) for k, o in enumerate(open_)]
        sign = [not c.isalpha() and not c.isspace() for c in t]
        inside = sum(s and 0 < k < len(t) - 1 and t[k - 1].isalpha() and t[k + 1].isalpha() for k, s in enumerate(sign))
        triple = sum(t[k].isalpha() and t[k].lower() == t[k - 1].lower() == t[k - 2].lower() for k in range(2, len(t)))
        n, letters = max(1, len(low)), sum(c.isalpha() for c in t)
        want = [math.log1p(len(low)), sum(hit) / n, math.log1p(sum(hit)), sum(open_) / n, math.log1p(sum(open_)),
                len({w for w, o in zip(low, open_) if o}) / math.sqrt(n), sum(near) / n,
                sum(c.isupper() for c in t) / max(1, letters), sum(sign) / max(1, len(t)), t.count("!") / n, inside / n, triple / n,
                sum(map(len, low)) / n]
        assert np.allclose(row, want), (t[:80], dict(zip(toxicity.FEATURES, zip(row, want))))


def test_surrogates_equal_replacing_by_the_table(spark):
    docs = documents(spark)
    source = {r.doc_id: r.text or "" for r in docs.collect()}
    new = {r.doc_id: r.text for r in pii.replace_all(docs, pii.KEY).collect()}
    table = {}
    for d, old in source.items():
        spans, after, at, out = pii.find(old), pii.find(new[d] or ""), 0, []
        for (start, end, kind, value), (_, _, kind2, value2) in zip(spans, after, strict=True):
            assert kind == kind2 and table.setdefault((kind, value), value2) == value2
            out += [old[at:start], value2]
            at = end
        assert "".join([*out, old[at:]]) == (new[d] or "")
    assert len(set(table.values())) == len(table) > 10
