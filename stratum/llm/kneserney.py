"""Interpolated modified Kneser-Ney model of order 2, counted over the whole corpus.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, then one end token a
document. Nothing is pruned: every word and every pair of the training documents is in
the model, so it grows with the corpus.

* Words. Tasks count the 64-bit hashes of their words and send sorted, delta-coded
  blocks; one task a hash range merges them into a sorted hash array with counts. A
  word's place in these arrays is its id.
* Pairs. Tasks look ids up in the mapped word arrays, count ``id << 32 | id`` keys and
  send sorted blocks; one task a shard merges them into a sorted key array with counts.
  A shard holds the pairs of its first words; a first word with many occurrences is
  dealt over several shards by the second word, by its count alone.
* Types. From its pairs a shard sends, for every id, how many pairs end in it and how
  many begin with it (by count 1, 2, 3 or more); one task an id range adds them up.
* Scoring. Workers map the arrays read-only and look up the distinct words and pairs of
  a batch in sorted order; memory holds a batch, the arrays stay with the page cache.

The arrays are files in the shared folder (``spark.checkpoint.dir``), written under a
name of their own and moved into place, so a repeated task writes the same file again.
The folder has to be mounted where workers run; another scheme than ``file`` is refused.
The driver gathers a few numbers a shard.

    p(w|v) = (n(vw) - D(n(vw))) / n(v) + g(v) p(w)
    p(w)   = (N1+(.w) - D'(N1+(.w))) / N1+(..) + g' / (V + 1)

``D`` (pairs) and ``D'`` (types) are the three discounts of their counts of counts,
kept within ``LEAST`` and the count; ``g`` gives what they take. A document starts with
a context of its own. After an unknown word ``p(w|v)`` is ``p(w)``; an unknown word has
the last term alone.

Defined cases: null text is an empty one (its end token alone); rows repeat as they are;
without training rows every token has probability 1 (V = 0); a null doc_id is kept;
columns besides ``doc_id, text`` are not read by ``score``. A task holds the tokens of
``PIECE_BYTES`` of text, or of one longer document. V has to stay below 2^32 - 1.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialise, ship_package
from stratum.scratch import scratch_path

# Fixed value: what separates words.
SEPARATORS = r"[\x20\x09-\x0D]+"
END = "\n"  # no word holds it
SHARD_BYTES = 32_000_000  # text a shard stands for
SPLIT_TOKENS = 250_000  # occurrences of a first word a shard takes
RANGE_IDS = 2_000_000  # ids whose types one task adds up
HELD = 1_500_000  # distinct keys a counting task holds
PIECE_BYTES = 8_000_000
LEAST = 0.05
LARGE = 255  # counts from here on are kept beside the one-byte ones
KEY = np.uint64
BLOCK = "shard int, size int, block binary"
SUMS = "shard int, size int, block binary, sums array<long>"
SCORED = "n_tokens long, n_known long, base_score double, score double"
_LOW = KEY(0xFFFFFFFF)


# ------------------------------------------------------------------ tokens
def hashes(words) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words, dtype=object), categorize=False).astype(KEY)


@dataclass
class Tokens:
    """Tokens of some documents: ``codes`` (into ``hash``) one document after another,
    each closed by the end token; ``ends`` are the places of the end tokens."""

    codes: np.ndarray
    hash: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        words = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
        coded = pc.dictionary_encode(pc.list_flatten(words))
        code, row = coded.indices.to_numpy().astype(np.int64), pc.list_parent_indices(words).to_numpy()
        blank = pc.index(coded.dictionary, "").as_py()
        if blank >= 0:
            code, row = code[code != blank], row[code != blank]
        size = np.bincount(row, minlength=len(texts)) + 1
        ends = np.cumsum(size) - 1
        codes = np.full(int(size.sum()), len(coded.dictionary), np.int64)
        inner = np.ones(len(codes), bool)
        inner[ends] = False
        codes[inner] = code
        return cls(codes, np.concatenate([hashes(coded.dictionary.to_numpy(zero_copy_only=False)), hashes([END])]), ends)

    def before(self, start: int) -> np.ndarray:
        """The code before each token; ``start`` where a document begins."""
        prior = np.empty_like(self.codes)
        prior[1:] = self.codes[:-1]
        prior[0] = start
        prior[self.ends[:-1] + 1] = start
        return prior


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about PIECE_BYTES of text."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
        start = 0
        while start < batch.num_rows:
            past = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, past + PIECE_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


# ------------------------------------------------------------------ sorted blocks
def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys as deltas beside their columns, byte plane by byte plane."""
    rows = np.stack([np.diff(keys, prepend=KEY(0)), *(c.astype(KEY) for c in columns)])
    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1, 8).transpose(0, 2, 1))
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(block: bytes, size: int, columns: int = 1) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(block, size * 8 * (columns + 1), codec="zstd", asbytes=True), np.uint8)
    rows = np.ascontiguousarray(planes.reshape(columns + 1, 8, size).transpose(0, 2, 1)).view(KEY).reshape(columns + 1, size)
    return [np.cumsum(rows[0], dtype=KEY), *rows[1:]]


def summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their columns."""
    if not len(keys):
        return (keys, *columns)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[heads], *(np.add.reduceat(c[order], heads) for c in columns))


def _blocks(shard: np.ndarray, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row a shard; keys are sorted."""
    order = np.argsort(shard, kind="stable")
    shard, keys, columns = shard[order], keys[order], [c[order] for c in columns]
    heads = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.array([], int)
    tails = np.append(heads[1:], len(shard))
    return pa.RecordBatch.from_arrays([
        pa.array(shard[heads], pa.int32()), pa.array(tails - heads, pa.int32()),
        pa.array([pack(keys[s:e], *(c[s:e] for c in columns)) for s, e in zip(heads, tails)], pa.binary())],
        names=["shard", "size", "block"])


class Counter:
    """Counts of keys; ``add`` returns what has to be sent once too many are held."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        self.held.append((keys, counts.astype(KEY)))
        if sum(len(k) for k, _ in self.held) < HELD:
            return None
        found = self.take()
        if 2 * len(found[0]) >= HELD:
            return found
        self.held = [found]
        return None

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        held, self.held = self.held, []
        if not held:
            return np.array([], KEY), np.array([], KEY)
        return summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))


def _gathered(table: pa.Table, columns: int = 1) -> tuple[np.ndarray, ...]:
    parts = [unpack(b, n, columns) for b, n in zip(table["block"].to_pylist(), table["size"].to_pylist())]
    return summed(*(np.concatenate(c) for c in zip(*parts)))


# ------------------------------------------------------------------ files
def mounted(path: str) -> str:
    """The folder as workers see it."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"workers map the model's files: {path} has to be a mounted folder (file:)")
    return url.path


def _store(folder: str, name: str, values: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    values.tofile(own)
    os.replace(own, f"{folder}/{name}")


def _map(folder: str, name: str, kind) -> np.ndarray:
    path = f"{folder}/{name}"
    return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.array([], kind)


def _counts_of_counts(n: np.ndarray, shard: int) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)] + [len(n), int(n.sum()), shard]


@dataclass
class Model:
    """What the driver knows: sizes and discounts. The arrays are opened by workers."""

    folder: str
    bits: int  # words are dealt by the first bits of their hash
    shards: int
    documents: int = 0
    starts: list[int] = field(default_factory=list)  # first id of each word array
    n_words: int = 0
    n_tokens: int = 0
    pair_discounts: tuple = (0.0, 0.0, 0.0)
    type_discounts: tuple = (0.0, 0.0, 0.0)
    n_types: int = 0  # of pairs
    type_rest: float = 0.0
    with_pairs: frozenset = frozenset()  # shards that hold a pair

    @property
    def start_id(self) -> int:
        return self.n_words


def discounts(t: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many keys
    have a count of 1, 2, 3 and 4; where a count of counts is missing, the plain one."""
    y = t[0] / (t[0] + 2 * t[1]) if t[0] else 0.5
    found = [k - (k + 1) * y * t[k] / t[k - 1] if t[k - 1] and t[k] else y for k in (1, 2, 3)]
    return tuple(min(max(d, LEAST), k) for d, k in zip(found, (1, 2, 3)))


def _discount(n: np.ndarray, d: tuple) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3).astype(np.int64)]


class Arrays:
    """The model's arrays, mapped as they are needed."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}
        self.starts = np.asarray([*model.starts, model.n_words], dtype=np.int64)

    def _of(self, name: str, kind) -> np.ndarray:
        if name not in self.open:
            self.open[name] = _map(self.model.folder, name, kind)
        return self.open[name]

    def ids(self, word_hash: np.ndarray) -> np.ndarray:
        """Ids of hashes, -1 where unknown."""
        order = np.argsort(word_hash, kind="stable")
        asked, found = word_hash[order], np.full(len(word_hash), -1, np.int64)
        for b, s, e in _runs(_bucket(asked, self.model.bits)):
            if self.starts[b] == self.starts[b + 1]:
                continue
            known = self._of(f"words-{b}", KEY)
            at = np.searchsorted(known, asked[s:e])
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == asked[s:e][hit]]
            found[order[s:e][hit]] = self.starts[b] + at[hit]
        return found

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Occurrences of known words; of the start of a document: the documents."""
        found = np.zeros(len(ids), np.int64)
        order = np.argsort(ids, kind="stable")
        asked = ids[order]
        for b, s, e in _runs(np.searchsorted(self.starts, asked, side="right") - 1):
            if b < len(self.starts) - 1:
                found[order[s:e]] = self._of(f"counts-{b}", KEY)[asked[s:e] - self.starts[b]]
            else:
                found[order[s:e]] = self.model.documents
        return found

    def types(self, ids: np.ndarray) -> np.ndarray:
        """For each id: pairs that end in it; pairs that begin with it, by count 1, 2, 3+."""
        found = np.zeros((len(ids), 4), np.int64)
        order = np.argsort(ids, kind="stable")
        asked = ids[order]
        for r, s, e in _runs(asked // RANGE_IDS):
            found[order[s:e]] = self._of(f"types-{r}", "<u4").reshape(-1, 4)[asked[s:e] - r * RANGE_IDS]
        return found

    def pairs(self, first: np.ndarray, n_first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Occurrences of pairs of ids."""
        keys = first.astype(KEY) << KEY(32) | second.astype(KEY)
        shard = pair_shard(keys, n_first, self.model.shards)
        order = np.lexsort((keys, shard))
        found = np.zeros(len(keys), np.int64)
        for b, s, e in _runs(shard[order]):
            if b not in self.model.with_pairs:
                continue
            known = self._of(f"pairs-{b}", KEY)
            asked = keys[order[s:e]]
            at = np.searchsorted(known, asked)
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == asked[hit]]
            n = self._of(f"pair-counts-{b}", "<u1")[at[hit]].astype(np.int64)
            large = np.flatnonzero(n == LARGE)
            where = self._of(f"large-places-{b}", "<u8")
            n[large] = self._of(f"large-counts-{b}", "<u8")[np.searchsorted(where, at[hit][large].astype("<u8"))]
            found[order[s:e][hit]] = n
        return found


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Equal neighbours: value, first place, place after the last."""
    if len(values):
        heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        for s, e in zip(heads, np.append(heads[1:], len(values))):
            yield int(values[s]), int(s), int(e)


def _bucket(word_hash: np.ndarray, bits: int) -> np.ndarray:
    return (word_hash >> KEY(64 - bits)).astype(np.int64) if bits else np.zeros(len(word_hash), np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> KEY(31))) * KEY(0x9E3779B97F4A7C15)
    return (x ^ (x >> KEY(29))) * KEY(0xBF58476D1CE4E5B9) >> KEY(20)


def pair_shard(keys: np.ndarray, n_first: np.ndarray, shards: int) -> np.ndarray:
    """By the first word; a word of n occurrences has 1 + n // SPLIT_TOKENS places, of
    which the second word chooses one."""
    places = (1 + n_first // SPLIT_TOKENS).astype(KEY)
    place = _mixed(keys & _LOW) % places
    return (_mixed((keys >> KEY(32)) + (place << KEY(40))) % KEY(shards)).astype(np.int64)


# ------------------------------------------------------------------ counting in Spark
def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for piece in _pieces(batches):
            t = Tokens.of(piece.column("text"))
            n = np.bincount(t.codes, minlength=len(t.hash))
            if found := counter.add(t.hash[n > 0], n[n > 0]):
                yield _blocks(_bucket(found[0], bits), *found)
        found = counter.take()
        yield _blocks(_bucket(found[0], bits), *found)

    return run


def _count_pairs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, counter = Arrays(model), Counter()

        def sent(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            first, place = np.unique((keys >> KEY(32)).astype(np.int64), return_inverse=True)
            return _blocks(pair_shard(keys, arrays.counts(first)[place], model.shards), keys, counts)

        for piece in _pieces(batches):
            t = Tokens.of(piece.column("text"))
            ids = np.append(arrays.ids(t.hash), model.start_id)
            keys = ids[t.before(len(t.hash))].astype(KEY) << KEY(32) | ids[t.codes].astype(KEY)
            if found := counter.add(*np.unique(keys, return_counts=True)):
                yield sent(*found)
        yield sent(*counter.take())

    return run


def _merge_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        b = key[0].as_py()
        words, n = _gathered(table)
        _store(folder, f"words-{b}", words)
        _store(folder, f"counts-{b}", n)
        return pa.table({"shard": pa.array([b], pa.int32()), "size": pa.array([len(words)], pa.int64()),
                         "total": pa.array([int(n.sum())], pa.int64())})

    return run


def _merge_pairs(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        b = key[0].as_py()
        keys, n = _gathered(table)
        large = np.flatnonzero(n >= LARGE)
        _store(folder, f"pairs-{b}", keys)
        _store(folder, f"pair-counts-{b}", np.minimum(n, LARGE).astype("<u1"))
        _store(folder, f"large-places-{b}", large.astype("<u8"))
        _store(folder, f"large-counts-{b}", n[large].astype("<u8"))
        one, zero = np.ones(len(keys), KEY), np.zeros(len(keys), KEY)
        begins = [keys >> KEY(32), zero, *((np.minimum(n, 3) == k).astype(KEY) for k in (1, 2, 3))]
        types = summed(*(np.concatenate(c) for c in zip(begins, [keys & _LOW, one, zero, zero, zero])))
        rows = _blocks((types[0] // KEY(RANGE_IDS)).astype(np.int64), *types)
        sums = [None] * len(rows) + [_counts_of_counts(n, b)]
        last = pa.RecordBatch.from_pydict({"shard": pa.array([-1], pa.int32()), "size": pa.array([0], pa.int32()), "block": pa.array([b""], pa.binary())})
        return pa.Table.from_batches([rows, last]).append_column("sums", pa.array(sums, pa.list_(pa.int64())))

    return run


def _merge_types(folder: str, n_ids: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        r = key[0].as_py()
        ids, *columns = _gathered(table, 4)
        dense = np.zeros((min(RANGE_IDS, n_ids - r * RANGE_IDS), 4), "<u4")
        dense[ids.astype(np.int64) - r * RANGE_IDS] = np.stack(columns, axis=1)
        _store(folder, f"types-{r}", dense)
        ends = dense[:, 0][dense[:, 0] > 0]
        return pa.table({"shard": pa.array([r], pa.int32()), "sums": pa.array([_counts_of_counts(ends, r)], pa.list_(pa.int64()))})

    return run


def _added_up(rows) -> list[int]:
    return [sum(int(r.sums[k]) for r in rows) for k in range(6)]


def fit(documents: DataFrame, training: Column) -> Model:
    """Counts the words and pairs of the rows for which ``training`` holds."""
    spark = documents.sparkSession
    ship_package(spark)
    folder = mounted(scratch_path(spark, "kneser-ney"))
    texts = documents.where(training).select(F.coalesce("text", F.lit("")).alias("text"))
    n_docs, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    bits = max(0, (-(-size // SHARD_BYTES) - 1)).bit_length()
    model = Model(folder, bits, 1 << bits, documents=n_docs)

    words = texts.mapInArrow(_count_words(bits), BLOCK).groupBy("shard").applyInArrow(_merge_words(folder), "shard int, size long, total long")
    sizes = {r.shard: r for r in words.collect()}  # one row a hash range
    model.n_words, model.n_tokens = sum(r["size"] for r in sizes.values()), sum(r.total for r in sizes.values())
    if model.n_words >= int(_LOW):
        raise ValueError(f"{model.n_words} different words: ids have 32 bits")
    at = 0
    for b in range(1 << bits):
        model.starts.append(at)
        at += sizes[b]["size"] if b in sizes else 0
    if not n_docs:
        return model

    pairs = texts.mapInArrow(_count_pairs(model), BLOCK).groupBy("shard").applyInArrow(_merge_pairs(folder), SUMS)
    pairs = materialise(pairs, "kneser-ney-types")
    sums = pairs.where("shard = -1").select("sums").collect()  # seven numbers a shard
    model.pair_discounts, model.with_pairs = discounts(_added_up(sums)), frozenset(r.sums[6] for r in sums)
    types = pairs.where("shard >= 0").drop("sums").groupBy("shard").applyInArrow(
        _merge_types(folder, model.n_words + 1), "shard int, sums array<long>")
    t = _added_up(types.collect())  # seven numbers an id range
    model.type_discounts, model.n_types = discounts(t), t[5]
    d = model.type_discounts
    model.type_rest = (d[0] * t[0] + d[1] * t[1] + d[2] * (t[4] - t[0] - t[1])) / t[5]
    return model


# ------------------------------------------------------------------ scoring
class Scorer:
    def __init__(self, model: Model):
        self.model, self.arrays = model, Arrays(model)

    def word_probability(self, ends: np.ndarray) -> np.ndarray:
        """p(w) of words that end ``ends`` pairs."""
        m = self.model
        if not m.n_words:
            return np.ones(len(ends))
        return (ends - _discount(ends, m.type_discounts)) / m.n_types + m.type_rest / (m.n_words + 1)

    def probabilities(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each distinct word of ``t`` in training; p(w|v) of each token."""
        m, arrays = self.model, self.arrays
        ids = np.append(arrays.ids(t.hash), m.start_id if m.documents else -1)
        known = np.flatnonzero(ids >= 0)
        n, types = np.zeros(len(ids), np.int64), np.zeros((len(ids), 4), np.int64)
        n[known], types[known] = arrays.counts(ids[known]), arrays.types(ids[known])
        p = self.word_probability(types[:, 0])
        coded = t.before(len(t.hash)) * len(ids) + t.codes
        pair, place = np.unique(coded, return_inverse=True)
        v, w = np.divmod(pair, len(ids))
        begins = types[:, 1:].sum(axis=1) > 0
        out = p[w]
        inner = np.flatnonzero(begins[v])
        seen = inner[ids[w[inner]] >= 0]
        count = np.zeros(len(pair), np.int64)
        count[seen] = arrays.pairs(ids[v[seen]], n[v[seen]], ids[w[seen]])
        rest = types[:, 1:] @ np.array(m.pair_discounts)
        vi = v[inner]
        out[inner] = (count[inner] - _discount(count[inner], m.pair_discounts) + rest[vi] * out[inner]) / n[vi]
        return n[:-1], out[place]

    def score(self, texts: pa.Array) -> pa.Table:
        t, m = Tokens.of(texts), self.model
        n, p = self.probabilities(t)
        heads = np.append(0, t.ends[:-1] + 1)
        base = np.log10((n + 0.1) / (m.n_tokens + 0.1 * (m.n_words + 1)))

        def by_document(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, heads)

        return pa.table({"n_tokens": np.diff(np.append(-1, t.ends)), "n_known": by_document((n > 0).astype(np.int64)[t.codes]),
                         "base_score": by_document(base[t.codes]), "score": by_document(np.log10(p))})


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (additive words) and score (the model's), both
    log10 of the whole text's probability."""
    ship_package(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for piece in _pieces(batches):
            found = scorer.score(piece.column("text")).combine_chunks()
            yield from found.add_column(0, "doc_id", piece.column("doc_id")).to_batches()

    asked = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return asked.mapInArrow(run, f"doc_id {kind}, {SCORED}")
