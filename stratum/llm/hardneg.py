"""Hard negatives by segment summaries.

Vectors are integer weights. Rows are dealt evenly over blocks (whatever their ids,
labels or vectors), and a block keeps, beside the weights, the mean and the deviation of
every segment of every vector, for segments of 16, 8 and 4 weights. For two vectors
``x, y`` and segments ``s`` of ``l`` weights,

    |x.y - sum(l * mean_s(x) * mean_s(y))| <= sum(dev_s(x) * dev_s(y)),

with ``dev_s`` the root of the summed squared differences from the mean. An anchor
takes a block's rows in the order of their coarsest upper bound and refines the bounds
from long to short segments; only rows whose bounds still meet what the anchor looks for
are scored exactly. Where nothing can be ruled out all rows are scored: the result is
exact whatever the data.

1. Positives: an anchor's ``k`` best other rows of its label.
2. Negatives: for each positive, the ``k`` best rows of other labels whose score is at
   most the positive's and at least ``share`` (4/5) of it. The positive's score is the
   upper end, ``share`` of it or the k-th score so far the lower end that bounds have to
   meet.

Spark deals the blocks once; each block of anchors meets each block of rows in a task of
its own, and a ranked window keeps the best of what they bring. No task holds more than
``BLOCK_ROWS`` rows and ``ANCHOR_ROWS`` anchors; only an anchor's ``k`` positives
are gathered into one row.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component take no part; rows of different lengths have no score with each other; a
repeated id is a row of its own, as an anchor, as a positive and as a negative, and an
anchor's own row is never its positive; ties go to the smaller id; an anchor without a
positive, or a positive without a negative, gives no row; an empty table gives none;
columns besides ``vec_id, label, embedding`` are not read. Scores are exact below 2^63;
larger weights raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import materialise, ship_package

SCALE = 256
SEGMENTS = (16, 8, 4)  # weights of a segment, coarse to fine
BLOCK_ROWS = 4_096
ANCHOR_ROWS = 1_024
CHUNK_ANCHORS = 64  # anchors of one label that share their bounds' matrix
CHUNK_ROWS = 256
NONE = -(2**63 - 1)
BLOCKS = "g int, dims int, n int, ids binary, labels binary, anchors binary, w binary, means binary, devs binary"
ANCHORS = "ag int, dims int, pos int, anchor_id long, label long, q array<double>"
_KEY = ["ag", "dims", "pos"]


def weighted(embeddings: DataFrame, label: Column, anchor: Column) -> DataFrame:
    """vec_id, label, is_anchor and the unscaled vector of the rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"),
                       F.coalesce(anchor, F.lit(False)).alias("is_anchor"), e.cast("array<double>").alias("x"))


# ------------------------------------------------------------------ summaries
def segment_lengths(dims: int) -> list[np.ndarray]:
    """Weights of every segment, level by level; the last of a level may be shorter."""
    return [np.diff(np.append(np.arange(0, dims, s), dims)) if dims else np.array([], int) for s in SEGMENTS]


def summaries(w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) of the segments of each level."""
    found = []
    for step, size in zip(SEGMENTS, segment_lengths(w.shape[1])):
        if not len(size):
            found.append((np.zeros((len(w), 0)),) * 2)
            continue
        heads = np.arange(0, w.shape[1], step)
        mean = np.add.reduceat(w, heads, axis=1) / size
        found.append((mean, np.sqrt(np.add.reduceat((w - np.repeat(mean, size, axis=1)) ** 2, heads, axis=1))))
    return found


def bounds(q: tuple, r: tuple, size: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of all of ``q`` with all of ``r``; ``slack``
    covers rounding."""
    middle, spread = (q[0] * size) @ r[0].T, q[1] @ r[1].T + slack
    return middle - spread, middle + spread


@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray
    w: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids, labels, w) -> Block:
        return cls(ids, labels, w, summaries(w))

    @classmethod
    def read(cls, row: dict) -> Block:
        n, dims = row["n"], row["dims"]
        means, devs = (np.frombuffer(row[k]).reshape(n, -1) if n else np.zeros((0, 0)) for k in ("means", "devs"))
        cuts = np.cumsum([len(x) for x in segment_lengths(dims)])[:-1]
        return cls(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
                   np.frombuffer(row["w"]).reshape(n, dims), list(zip(np.split(means, cuts, axis=1), np.split(devs, cuts, axis=1))))

    @cached_property
    def norms(self) -> np.ndarray:
        return np.sqrt((self.w**2).sum(axis=1))

    @cached_property
    def largest(self) -> float:
        return float(np.abs(self.w).max(initial=0))


def exact_scores(q: np.ndarray, w: np.ndarray, largest: float) -> np.ndarray:
    if q.shape[1] * largest < 2.0**53:
        return (q @ w.T).astype(np.int64)
    if q.shape[1] * largest < 2.0**63:
        return q.astype(np.int64) @ w.astype(np.int64).T
    raise OverflowError("inner products of these weights need more than 64 bits")


def search(rows: Block, asked: Block, same: bool, high: np.ndarray, low: np.ndarray, own: np.ndarray, k: int):
    """For each of ``asked`` and each of its ranges ``low <= score <= high``: the ``k``
    best rows of its label (``same``) or of all others, but for the row at ``own``.
    Returns their scores (NONE: fewer), their ids and how many scores were taken."""
    lengths = segment_lengths(rows.w.shape[1])
    best = np.full((*high.shape, k), NONE, np.int64)
    best_id = np.full(best.shape, np.iinfo(np.int64).max)
    taken = 0
    for label in np.unique(asked.labels):
        mine = np.flatnonzero(asked.labels == label)
        cols = np.flatnonzero((rows.labels == label) == same)
        for start in range(0, len(mine) if len(cols) else 0, CHUNK_ANCHORS):
            a = mine[start:start + CHUNK_ANCHORS]
            slack = 1e-9 * np.outer(asked.norms[a], rows.norms[cols]) + 1e-6

            def between(level: int, i: np.ndarray, c: np.ndarray):
                q, r = (tuple(x[at] for x in side.levels[level]) for side, at in ((asked, a[i]), (rows, cols[c])))
                return bounds(q, r, lengths[level], slack[np.ix_(i, c)])

            every = np.arange(len(a))
            first = between(0, every, np.arange(len(cols)))
            order = np.argsort(-first[1].max(axis=0), kind="stable")
            for at in range(0, len(order), CHUNK_ROWS):
                c, i = order[at:at + CHUNK_ROWS], every
                # bounds that equal the k-th score may hide a smaller id
                need, top = np.maximum(low[a], best[a, :, -1]), high[a].max(axis=1)[:, None]
                least = need.min(axis=1)[:, None]
                below, above = (x[:, c] for x in first)
                for level in range(len(lengths)):
                    if level:
                        below, above = between(level, i, c)
                    alive = ~(above < least[i]) & ~(below > top[i])
                    keep_i, keep_c = alive.any(axis=1), alive.any(axis=0)
                    i, c = i[keep_i], c[keep_c]
                    if not len(c):
                        break
                if not len(c):
                    continue
                ids, score = rows.ids[cols[c]], exact_scores(asked.w[a[i]], rows.w[cols[c]], asked.largest * rows.largest)
                taken += score.size
                self_row = own[a[i]][:, None] == cols[c][None, :]
                for j in range(high.shape[1]):
                    fits = (score <= high[a[i], j][:, None]) & (score >= need[i, j][:, None]) & ~self_row
                    hit = np.flatnonzero(fits.any(axis=1))
                    if not len(hit):
                        continue
                    some = np.flatnonzero(fits[hit].any(axis=0))
                    who, sub = a[i[hit]], np.ix_(hit, some)
                    scores = np.concatenate([best[who, j], np.where(fits[sub], score[sub], NONE)], axis=1)
                    named = np.concatenate([best_id[who, j], np.where(fits[sub], ids[some][None, :], np.iinfo(np.int64).max)], axis=1)
                    first_k = np.lexsort((named, -scores), axis=1)[:, :k]
                    best[who, j] = np.take_along_axis(scores, first_k, axis=1)
                    best_id[who, j] = np.take_along_axis(named, first_k, axis=1)
    return best, best_id, taken


# ------------------------------------------------------------------ Spark
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition as one block for each length of vector."""
    rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if rows is None or not len(rows):
        return
    x = rows["x"].combine_chunks()
    size = np.diff(x.offsets.to_numpy())
    flat = np.floor(x.flatten().to_numpy() * SCALE)
    heads = np.append(0, np.cumsum(size))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    anchors = rows["is_anchor"].to_numpy()
    for dims in np.unique(size):
        at = np.flatnonzero(size == dims)
        at = at[np.lexsort((ids[at], labels[at]))]
        w = flat[heads[at][:, None] + np.arange(dims)[None, :]]
        levels = summaries(w)
        yield pa.RecordBatch.from_pydict({
            "g": pa.array([TaskContext.get().partitionId()], pa.int32()), "dims": pa.array([dims], pa.int32()), "n": pa.array([len(at)], pa.int32()),
            "ids": [ids[at].astype(np.int64).tobytes()], "labels": [labels[at].astype(np.int64).tobytes()], "anchors": [anchors[at].astype(np.uint8).tobytes()],
            "w": [w.tobytes()], **{name: [np.concatenate([x[part] for x in levels], axis=1).tobytes()] for part, name in ((0, "means"), (1, "devs"))}})


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(row["anchors"], np.uint8))
            w = np.frombuffer(row["w"]).reshape(row["n"], row["dims"])[at]
            yield pa.RecordBatch.from_arrays([
                pa.array([row["g"]] * len(at), pa.int32()), pa.array([row["dims"]] * len(at), pa.int32()), pa.array(at, pa.int32()),
                pa.array(np.frombuffer(row["ids"], np.int64)[at]), pa.array(np.frombuffer(row["labels"], np.int64)[at]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * row["dims"], pa.int32()), pa.array(w.ravel()))],
                names=[*_KEY, "anchor_id", "label", "q"])


def _cells(blocks: DataFrame, anchors: DataFrame, groups: int, asked: int):
    """Each block of anchors beside each block of rows."""
    b = max(1, -(-asked // ANCHOR_ROWS))
    rows = blocks.drop("anchors").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    mine = anchors.withColumns({"b": F.pmod(F.xxhash64(*_KEY), F.lit(b)).cast("int")})
    mine = mine.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return rows.groupBy("g", "b", "dims").cogroup(mine.groupBy("g", "b", "dims"))


def _asked(table: pa.Table) -> Block:
    w = table["q"].combine_chunks().flatten().to_numpy().reshape(len(table), -1) if len(table) else np.zeros((0, 0))
    return Block.of(table["anchor_id"].to_numpy(), table["label"].to_numpy(), w)


def _own(table: pa.Table, g: int) -> np.ndarray:
    return np.where(table["ag"].to_numpy() == g, table["pos"].to_numpy(), -1)


def _found(table: pa.Table, best: np.ndarray, best_id: np.ndarray, extra: dict) -> pa.Table:
    i, j, r = np.nonzero(best != NONE)
    out = {k: table[k].combine_chunks().take(pa.array(i)) for k in [*_KEY, "anchor_id"]}
    out |= {name: pa.array(values[i, j], pa.int64()) for name, values in extra.items()}
    return pa.table(out | {"other_id": pa.array(best_id[i, j, r]), "score": pa.array(best[i, j, r])})


_FOUND = "ag int, dims int, pos int, anchor_id long, {} other_id long, score long"


def positives(blocks: DataFrame, anchors: DataFrame, groups: int, asked: int, k: int) -> DataFrame:
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        best = best_id = np.full((len(right), 1, 0), NONE)
        if len(left) and len(right):
            every = np.ones((len(right), 1), np.int64)
            best, best_id, _ = search(Block.read(left.to_pylist()[0]), _asked(right), True, every * (2**63 - 1), every * NONE,
                                      _own(right, key[0].as_py()), k)
        return _found(right, best, best_id, {})

    near = _cells(blocks, anchors, groups, asked).applyInArrow(run, _FOUND.format(""))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.desc("score"), "other_id")))
    return ranked.where(F.col("rank") <= k)


def negatives(blocks: DataFrame, anchors: DataFrame, groups: int, asked: int, k: int) -> DataFrame:
    """``anchors`` carry ``positives``, an array of (rank, positive_id, positive_score)."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lists = right["positives"].to_pylist()
        shape = len(lists), max(map(len, lists), default=0)
        high, low, ids = np.full(shape, NONE), np.full(shape, 2**63 - 1), np.zeros(shape, np.int64)
        for i, found in enumerate(lists):
            for p in found:
                j, s = p["rank"] - 1, p["positive_score"]
                high[i, j], low[i, j], ids[i, j] = s, s - s // 5, p["positive_id"]  # s - s // 5: 4 s / 5, rounded up
        best = best_id = np.full((*shape, 0), NONE)
        if len(left) and shape[1]:
            best, best_id, _ = search(Block.read(left.to_pylist()[0]), _asked(right), False, high, low, np.full(len(right), -1), k)
        place = np.broadcast_to(np.arange(1, shape[1] + 1), shape)
        return _found(right, best, best_id, {"place": place, "positive_id": ids, "positive_score": high})

    near = _cells(blocks, anchors, groups, asked).applyInArrow(run, _FOUND.format("place long, positive_id long, positive_score long,"))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(*_KEY, "place").orderBy(F.desc("score"), "other_id")))
    return ranked.where(F.col("rank") <= k)


def mine(rows: DataFrame, k: int = 5) -> DataFrame:
    """``rows`` as ``weighted`` gives them. anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    ship_package(rows.sparkSession)
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    groups = max(1, -(-total // BLOCK_ROWS))
    blocks = materialise(rows.repartition(groups).mapInArrow(_pack, BLOCKS), "negatives-blocks")
    anchors = materialise(blocks.where(F.col("anchors").isNotNull()).mapInArrow(_anchors, ANCHORS), "negatives-anchors")
    near = positives(blocks, anchors, groups, asked, k)
    listed = near.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct(  # k of an anchor
        "rank", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("positives"))
    asking = materialise(anchors.join(listed, _KEY), "negatives-positives")
    return negatives(blocks, asking, groups, asked, k).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
