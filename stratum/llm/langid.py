"""Language ID by cross-parsing: fewest longest-match phrases per letter.

For every language a suffix automaton is built over a sample of its labelled text.
A text is cut greedily into the longest phrases that occur in that sample; texts
of the same language need fewer. A phrase is a place in the sample, so it is worth the
logarithm of the sample's length (of LEAST where the sample is shorter). The language with
the fewest phrases a character, so weighted, wins, ties going to the first by name.

Fitting takes a bounded sample: of the labelled documents of a language, dealt over
CELLS cells, the MOST_DOCS / CELLS first of each by hash of doc_id, as far as CHARS characters of normalised text
(less where very many languages share MOST_CHARS). A repeated doc_id counts once a
language, with its least text. Texts are normalised and cut by workers, so the driver
gets the samples alone. No language's sample is cut to another's length. Workers build the
automata from those samples, over all letters of each: moves by a language's most frequent
letters (SYMBOLS less three) are looked up in a table, moves by its others in a
sorted list. Whole texts are parsed in lanes
of LANE characters, all lanes of a batch step by step together.

``keep_identified`` drops what no learned language explains. Breaks (phrases without the
one that opens each lane) a character of a text in the language stay far below those of
the same letters in random order. So half of each sample is parsed by the other half, as
it is and shuffled; a language explains texts up to EXPLAINED of the shuffled rate, or
half way between both rates where that is more (up to the shuffled rate itself where the
sample has fewer than LEAST characters), and two standard deviations for short texts.

Normalised text: lower-case letters, every run of other characters one space.
Defined cases: null text, or text without a letter, is ``und`` with score 0; with no
labelled text at all every document is ``und``, and ``keep_identified`` keeps all; null doc_id is not held out and
never learned from; repeated rows are judged each; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import materialise, plainly_named, ship_package
from stratum.llm.textnum import Letters, code_points, text_batches

UNKNOWN = "und"
MOST_DOCS, CHARS, MOST_CHARS = 400, 30_000, 300_000
CELLS = 50  # hash cells of a language, each of which gives its share of MOST_DOCS
SYMBOLS = 64  # columns of an automaton's table: space, its frequent letters, RARE and ABSENT
RARE, ABSENT = SYMBOLS - 2, SYMBOLS - 1  # other letters of the sample; letters it does not hold
LANE, BATCH_CHARS = 256, 3 << 19
SHARPNESS = 8
EXPLAINED, LEAST = 0.75, 2_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def normalised(texts: list[str | None], alphabet: np.ndarray | None = None):
    """(codes, begins): lower-case letters (mapped by ``alphabet`` if given) and single
    zeros for what lies between; no zero begins a text."""
    table = Letters.get()
    cps, begins = code_points(texts)
    letter = table.letter[cps]
    keep = letter | np.concatenate([[False], letter[:-1]])
    low = table.lower[cps]
    codes = np.where(letter, low if alphabet is None else alphabet[low], 0)[keep]
    return codes, np.concatenate([[0], np.cumsum(keep)])[begins]


class SuffixAutomaton:
    """Of a sequence of codes; ``step[state]`` has the next state by code."""

    def __init__(self, codes: list[int]):
        step: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes:
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p != -1:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and step[p].get(c) == q:
                        step[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.step = step


class Model:
    """Automata of all languages in one table, built from the samples."""

    _built: dict[int, Model] = {}

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        letters = sorted({c for s in samples.values() for c in s if c != " "})
        code = {" ": 0, **{c: k + 1 for k, c in enumerate(letters)}}
        self.letters = len(letters) + 2  # the last for letters of no sample
        self.alphabet = np.full(0x110000, self.letters - 1, dtype=np.int32)
        self.alphabet[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.column = np.full((self.letters, len(self.names)), ABSENT, dtype=np.uint8)  # of a letter in a language's table
        self.first = np.zeros((self.letters, len(self.names)), dtype=np.int64)  # state after a phrase's first letter
        tables, keys, values, self.roots, at = [], [], [], [], 0
        for k, name in enumerate(self.names):
            codes = [code[c] for c in samples[name]]
            column = self.column[:, k]
            column[codes] = RARE
            column[0] = 0
            for nth, (c, _) in enumerate(Counter(c for c in codes if c).most_common(RARE - 1)):
                column[c] = nth + 1
            step = SuffixAutomaton(codes).step
            state = np.repeat(np.arange(len(step)), [len(row) for row in step])
            by = np.array([c for row in step for c in row], dtype=np.int64)
            to = np.array([x for row in step for x in row.values()], dtype=np.int64) + at
            table = np.zeros((len(step), SYMBOLS), dtype=np.int32)
            rare = column[by] == RARE
            table[state[~rare], column[by[~rare]]] = to[~rare]
            keys.append((state[rare] + at) * self.letters + by[rare])
            values.append(to[rare])
            self.first[:, k] = at
            self.first[by[state == 0], k] = to[state == 0]
            self.roots.append(at)
            tables.append(table)
            at += len(step)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        keys, values = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, values))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]  # moves by rare letters
        self.worth = np.log([max(len(samples[x]), LEAST) for x in self.names])

    @classmethod
    def get(cls, samples: dict[str, str]) -> Model:
        """One model a worker."""
        key = hash(tuple(sorted(samples.items())))
        if key not in cls._built:
            cls._built.clear()
            cls._built[key] = cls(samples)
        return cls._built[key]

    def phrases(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """(texts, languages): phrases that each text needs."""
        size = np.diff(begins)
        lanes = -(-size // LANE)
        text = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = begins[:-1][text] + nth * LANE
        long = np.minimum(size[text] - nth * LANE, LANE)
        order = np.argsort(-long, kind="stable")
        start, long, text = start[order], long[order], text[order]
        roots = np.array(self.roots, dtype=np.int64)
        state = np.broadcast_to(roots, (len(start), len(roots))).copy()
        count = np.zeros(state.shape, dtype=np.int32)
        live = np.searchsorted(-long, -np.arange(LANE), side="left")  # lanes longer than t
        for t in range(int(long[0]) if len(long) else 0):
            m = int(live[t])
            c = codes[start[:m] + t]
            column = self.column[c]
            to = self.table[state[:m] * SYMBOLS + column].astype(np.int64)
            if len(self.keys):
                lane, language = np.nonzero(column == RARE)
                to[lane, language] = self._by_rare(state[lane, language], c[lane])
            cut = to == 0
            count[:m] += cut
            state[:m] = np.where(cut, self.first[c], to)
        out = np.zeros((len(size), len(roots)))
        for k in range(len(roots)):
            out[:, k] = np.bincount(text, weights=count[:, k] + 1, minlength=len(size))
        return out

    def _by_rare(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Next states by rare letters, 0 if none."""
        key = state * self.letters + c
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], 0)


def _cut(limit: int):
    """Normalised texts of ``limit`` characters at most."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for start, batch in text_batches(f["text"].tolist(), BATCH_CHARS):
                codes, begins = normalised(batch)
                out = f.iloc[start:start + len(batch)][["lang", "rank"]].copy()
                out["sample"] = ["".join(" " if c == 0 else chr(c) for c in codes[a:min(a + limit, b)].tolist())
                                 for a, b in zip(begins[:-1], begins[1:])]
                yield out

    return run


def fit(documents: DataFrame, learn: Column) -> dict[str, str]:
    """Normalised sample of every language among the rows that ``learn`` allows."""
    rows = documents.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    spark = documents.sparkSession
    ship_package(spark)
    # ranked in cells of a language, so that no task gets a whole language
    cell = F.pmod(F.xxhash64(F.lit("cell"), "doc_id"), F.lit(CELLS)).cast("int")
    by_hash = Window.partitionBy("lang", "cell").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("lang", "doc_id").distinct().withColumn("cell", cell).withColumn("nth", F.row_number().over(by_hash))
    chosen = materialise(chosen.where(F.col("nth") <= MOST_DOCS // CELLS).select(
        "lang", "doc_id", ((F.col("nth") - 1) * CELLS + F.col("cell")).cast("int").alias("rank")), "lang-ids")
    languages = chosen.select("lang").distinct().count()
    if not languages:
        return {}
    limit = max(1, min(CHARS, MOST_CHARS // languages))
    texts = rows.join(chosen, ["lang", "doc_id"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    cut = texts.mapInPandas(_cut(limit), "lang string, rank int, sample string")
    before = F.coalesce(F.sum(F.length("sample")).over(
        Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = cut.withColumn("left", (limit - before).cast("int")).where(F.col("left") > 0).select(
        "lang", "rank", F.substring("sample", F.lit(1), F.col("left")).alias("sample"))
    samples: dict[str, str] = {}
    for r in sorted(used.collect(), key=lambda r: r["rank"]):  # at most MOST_CHARS characters
        samples[r.lang] = samples.get(r.lang, "") + r.sample
    return {lang: s for lang, s in samples.items() if s}


def _breaks(phrases: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Breaks a character, from phrases of texts of ``size`` characters."""
    return (phrases - (-(-size // LANE))[:, None]) / np.maximum(size, 1)[:, None]


def limits(samples: dict[str, str]) -> dict[str, float]:
    """Breaks a character up to which each language explains a text."""
    model = Model({lang: s[:len(s) // 2] for lang, s in samples.items()})
    out = {}
    for k, lang in enumerate(model.names):
        s = samples[lang]
        codes, begins = normalised([s[len(s) // 2:]], model.alphabet)
        mixed = np.random.default_rng(0).permutation(codes)
        own, noise = (float(_breaks(model.phrases(c, begins), np.diff(begins))[0, k]) for c in (codes, mixed))
        out[lang] = max((own + noise) / 2, noise * (EXPLAINED if len(s) >= LEAST else 1))
    return out


def _predict(samples: dict[str, str], passed: list[str], most: dict[str, float] | None = None):
    """With ``most`` (limits), texts that no language explains are UNKNOWN."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model.get(samples)
        names = np.array([*model.names, UNKNOWN], dtype=object)
        for f in frames:
            for start, batch in text_batches(f["text"].tolist(), BATCH_CHARS):
                codes, begins = normalised(batch, model.alphabet)
                size = np.diff(begins)
                out = f.iloc[start:start + len(batch)][passed].copy()
                if model.names:
                    phrases = model.phrases(codes, begins)
                    rate = phrases * model.worth / np.maximum(size, 1)[:, None]
                    best = rate.argmin(axis=1)
                    least = rate.min(axis=1)[:, None]
                    with np.errstate(invalid="ignore", divide="ignore"):
                        score = 1 / ((least / rate) ** SHARPNESS).sum(axis=1)
                    seen = size > 0
                    if most is not None:
                        limit = np.array([most[x] for x in model.names])
                        limit = limit + 2 * np.sqrt(limit * np.maximum(1 - limit, 0) / np.maximum(size, 1)[:, None])
                        seen &= (_breaks(phrases, size) <= limit).any(axis=1)
                    out["lang_pred"] = names[np.where(seen, best, len(model.names))]
                    out["score"] = np.where(seen, score, 0.0)
                else:
                    out["lang_pred"], out["score"] = UNKNOWN, 0.0
                yield out

    return run


def identify(documents: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(_predict(samples, ["doc_id"]), "doc_id long, lang_pred string, score double")


def keep_identified(documents: DataFrame, samples: dict[str, str]) -> DataFrame:
    """``documents`` without those that no learned language explains, columns as they
    were; all of them if nothing was learned."""
    if not samples:
        return documents
    ship_package(documents.sparkSession)
    own = plainly_named(documents, ("doc_id", "text"))
    named = own.mapInPandas(_predict(samples, own.columns, limits(samples)), ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields) + ", lang_pred string, score double")
    return named.where(F.col("lang_pred") != UNKNOWN).select(*own.columns).toDF(*documents.columns)
