"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text (numpy over code points): densities of lexicon words and
of lexicon word beginnings, their closeness to a second-person pronoun, share of
capitals, punctuation and exclamation, obfuscated words (signs inside or doubled
letters), word lengths. The lexicon is a short fixed list together with words and
word beginnings that the labelled sample shows to be far likelier in toxic texts.

Fitting takes a bounded sample of labelled documents (MOST_ROWS of each label, first by
hash of doc_id, a repeated doc_id once with its least text); trees learn from three quarters of it, the calibration from the
rest, weighted back to the labels' true shares. Near copies count once for the
lexicon: texts are counted by their least word hash, which copies share. All rows
are scored, whole.

Defined cases: null text is empty; without both labels in the sample the score is
the share of toxic labels (0 without labels); null doc_id is not held out and never
learned from; a doc_id with several labels has the greatest; repeated rows are
scored each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialise, plainly_named, ship_package
from stratum.llm.textnum import _BASE, _UNBASE, Letters, code_points, mix, text_batches

MOST_ROWS = 6_000  # of each label
MOST_TERMS = 400  # learned words, and learned beginnings
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO = 3, 0.005, 20.0  # of a learned term, among toxic texts
PREFIXES = (4, 5, 6)
NEAR = 5
BATCH_CHARS = 1 << 19
REJECT = 0.7
FEATURES = ("log_words", "word_density", "log_word_hits", "prefix_density", "log_prefix_hits", "distinct_hits",
            "near_you", "capitals", "punctuation", "exclaims", "obfuscated", "doubled", "word_length")

# Common insults, and second-person pronouns of the four languages.
INSULTS = "idiot moron stupid loser trash scum clown pathetic worthless disgusting".split()
YOU = "you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros".split()


def _hash_words(first: np.ndarray, size: np.ndarray, sums: np.ndarray, unpower: np.ndarray) -> np.ndarray:
    return mix((sums[first + size] - sums[first]) * unpower[first])


def _sums(low: np.ndarray, letter: np.ndarray, table: Letters) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(len(low), _BASE, dtype=np.uint64)
    unpower = np.full(len(low), _UNBASE, dtype=np.uint64)
    power[:1] = unpower[:1] = 1
    value = np.where(letter, table.value[low], np.uint64(0)) * np.cumprod(power, dtype=np.uint64)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)]), np.cumprod(unpower, dtype=np.uint64)


def term_hashes(terms: list[str]) -> np.ndarray:
    """Sorted hashes of words, as ``features`` takes them from texts."""
    if not terms:
        return np.zeros(0, np.uint64)
    table = Letters.get()
    cps, begins = code_points(terms)
    sums, unpower = _sums(table.lower[cps], table.letter[cps], table)
    return np.unique(_hash_words(begins[:-1], np.diff(begins) - 1, sums, unpower))


def _within(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), dtype=bool)
    slot = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[slot] == h


def features(texts: list[str], lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(texts, FEATURES). ``lexicon``: hashes of words and of word beginnings."""
    table, n = Letters.get(), len(texts)
    cps, begins = code_points(texts)
    letter, low = table.letter[cps], table.lower[cps]
    doc_of = np.repeat(np.arange(n), np.diff(begins))
    before = np.concatenate([[False], letter[:-1]])
    first = np.flatnonzero(letter & ~before)
    end = np.flatnonzero(before & ~letter)
    size, doc = end - first, doc_of[first]
    sums, unpower = _sums(low, letter, table)
    h = _hash_words(first, size, sums, unpower)
    words = np.bincount(doc, minlength=n)
    per_word, per_char = np.maximum(words, 1), np.maximum(np.diff(begins) - 1, 1)

    hit = _within(h, lexicon[0])
    opens = np.zeros(len(h), dtype=bool)
    for k in PREFIXES:
        longer = np.flatnonzero(size > k)
        opens[longer] |= _within(_hash_words(first[longer], np.full(len(longer), k), sums, unpower), lexicon[1])
    opens |= hit
    you = np.flatnonzero(_within(h, term_hashes(YOU)))
    any_hit = np.flatnonzero(opens)
    left = np.searchsorted(you, any_hit - NEAR)
    near = np.zeros(len(any_hit), dtype=bool)
    has = left < len(you)
    near[has] = (you[left[has]] <= any_hit[has] + NEAR) & (doc[you[left[has]]] == doc[any_hit[has]])
    kinds = np.unique(np.stack([doc[any_hit].astype(np.uint64), h[any_hit]]), axis=1)[0].astype(np.int64) if len(any_hit) else []

    sign = ~letter & ~table.space[cps]
    inside = sign & before & np.concatenate([letter[1:], [False]])
    same = np.zeros(len(cps), dtype=bool)
    same[2:] = letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    count = lambda mask: np.bincount(doc_of[mask], minlength=n)
    hits, starts = np.bincount(doc[hit], minlength=n), np.bincount(doc[opens], minlength=n)
    return np.stack([
        np.log1p(words), hits / per_word, np.log1p(hits), starts / per_word, np.log1p(starts),
        np.bincount(np.asarray(kinds, dtype=np.int64), minlength=n) / np.sqrt(per_word),
        np.bincount(doc[any_hit[near]], minlength=n) / per_word,
        count(letter & table.upper[cps]) / np.maximum(count(letter), 1), count(sign) / per_char,
        count(cps == 0x21) / per_word, count(inside) / per_word, count(same) / per_word,
        np.bincount(doc, weights=size, minlength=n) / per_word,
    ], axis=1)


def _rows(lexicon: tuple[list[str], list[str]], passed: list[str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = term_hashes(lexicon[0]), term_hashes(lexicon[1])
        for f in frames:
            for start, batch in text_batches(f["text"].tolist(), BATCH_CHARS):
                out = f.iloc[start:start + len(batch)][passed].copy()
                out["features"] = list(features(batch, known))
                yield out

    return run


def with_features(rows: DataFrame, lexicon: tuple[list[str], list[str]], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` and the feature vector of ``text``."""
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    taken = rows.select(*keep, *([] if "text" in keep else ["text"]))
    got = taken.mapInPandas(_rows(lexicon, keep), f"{schema}, features array<double>")
    return got.select(*keep, array_to_vector("features").alias("features"))


class Model:
    def __init__(self, lexicon, trees: GBTClassificationModel | None, curve: IsotonicRegressionModel | None, base: float):
        self.lexicon, self.trees, self.curve, self.base = lexicon, trees, curve, base

    def score(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """Columns ``keep`` of ``rows``, score (0 to 1) and predicted (0 or 1)."""
        ship_package(rows.sparkSession)
        if self.trees is None:
            scored = rows.select(*keep, F.lit(self.base).alias("score"))
        else:
            margin = self.trees.transform(with_features(rows, self.lexicon, keep)).select(
                *keep, vector_to_array("probability")[1].alias("margin"))
            scored = self.curve.transform(margin).select(*keep, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
        return scored.withColumn("predicted", F.when(F.col("score") >= REJECT, 1).otherwise(0).cast("int"))

    def keep_clean(self, rows: DataFrame) -> DataFrame:
        """``rows`` without those predicted to be toxic, columns as they were, whatever
        their names."""
        own = plainly_named(rows, ("doc_id", "text"))
        return self.score(own, own.columns).where(F.col("predicted") == 0).select(*own.columns).toDF(*rows.columns)


def _sample(documents: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """At most MOST_ROWS rows of each label (text, toxic, fold), and all labels' counts."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    one = materialise(one, "tox-labels")
    shares = {r.toxic: r["count"] for r in one.groupBy("toxic").count().collect()}
    first = None
    for kind in (0, 1):
        # hashes are even, so the MOST_ROWS first lie below twice their share: few rows meet in the task that orders them
        most = min(2**63 - 1, 2 * MOST_ROWS * 2**64 // max(shares.get(kind, 0), 1) - 2**63)
        part = one.where((F.col("toxic") == kind) & (F.xxhash64("id") <= most)).orderBy(F.xxhash64("id"), "id").limit(MOST_ROWS)
        first = part if first is None else first.unionAll(part)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # broadcast: at most 2 * MOST_ROWS rows of an id and a label
    one_text = texts.join(F.broadcast(first), texts["doc_id"] == first["id"]).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = one_text.select("text", "toxic", (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) == 0).alias("checks"))
    return materialise(rows, "tox-sample"), shares


def _lexicon(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Words and word beginnings far likelier in toxic texts of the sample."""
    words = sample.select("toxic", F.array_distinct(F.split(F.lower(F.trim(F.regexp_replace("text", r"\P{L}+", " "))), " ")).alias("w"))
    words = words.select("toxic", "w", F.array_min(F.transform("w", lambda x: F.xxhash64(x))).alias("text_key"))
    prefixes = [F.transform(F.filter("w", lambda x, k=k: F.length(x) > k), lambda x, k=k: F.concat(F.lit("^"), F.substring(x, 1, k)))
                for k in PREFIXES]
    terms = words.select("toxic", "text_key", F.explode(F.array_distinct(F.concat("w", *prefixes))).alias("term"))
    seen = terms.where(F.col("term") != "").groupBy("term").agg(
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("text_key"))).alias("bad"),
        F.count_distinct(F.when(F.col("toxic") == 0, F.col("text_key"))).alias("good"))
    n = words.agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("text_key"))).alias("bad"),
                  F.count_distinct(F.when(F.col("toxic") == 0, F.col("text_key"))).alias("good")).first()
    ratio = (F.col("bad") / max(n.bad, 1)) / ((F.col("good") + 0.5) / max(n.good, 1))
    likely = seen.where((F.col("bad") >= max(LEAST_TEXTS, LEAST_SHARE * n.bad)) & (ratio >= LEAST_RATIO))
    found = []
    for begins in (False, True):
        own = likely.where(F.col("term").startswith("^") == begins).orderBy(F.desc("bad"), "term").limit(MOST_TERMS)
        found.append([r.term.lstrip("^") for r in own.collect()])
    return sorted({*found[0], *INSULTS}), found[1]


def fit(documents: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learns from the labelled documents that ``learn`` (over labels) allows."""
    ship_package(documents.sparkSession)
    sample, shares = _sample(documents, labels, learn)
    total = sum(shares.values())
    base = shares.get(1, 0) / total if total else 0.0
    kinds = {(r.toxic, r.checks): r["count"] for r in sample.groupBy("toxic", "checks").count().collect()}
    if any(not kinds.get((kind, checks)) for kind in (0, 1) for checks in (False, True)):
        return Model(([], []), None, None, base)
    lexicon = _lexicon(sample.where(~F.col("checks")))
    taken = {kind: kinds[kind, False] + kinds[kind, True] for kind in (0, 1)}
    weight = F.when(F.col("toxic") == 1, shares[1] / taken[1]).otherwise(shares[0] / taken[0])
    rows = materialise(with_features(sample, lexicon, ["toxic", "checks", "text"]).select(
        "features", F.col("toxic").cast("double").alias("label"), "checks", weight.alias("weight")), "tox-feat")
    trees = GBTClassifier(maxIter=20, maxDepth=4, maxBins=32, stepSize=0.2, seed=7, featuresCol="features", labelCol="label").fit(
        rows.where(~F.col("checks")))
    checks = trees.transform(rows.where("checks")).select(vector_to_array("probability")[1].alias("margin"), "label", "weight")
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="score").fit(checks)
    return Model(lexicon, trees, curve, base)
