"""Exact top-k inner products with block-at-a-time pruning.

Vectors are integer term weights (one term per dimension). Rows are put in an
order that brings similar rows together, cut into document-range blocks, and
each block keeps a forward index (its weights, row by row) with the largest and
smallest weight of every term. A query orders blocks by the sum of its term
maxima, ``sum(q_t * (max_t if q_t > 0 else min_t))``, scores blocks through
their forward index in that order, and stops when the next bound falls below its
k-th score. Results are exact whatever the order of rows: the order only decides
how early a query stops.

Spark deals blocks over tasks by a hash of the row order's key; each query block
meets every group of blocks once and brings back its k best of it, and a ranked
window keeps the k best of those. Queries are handed out in bounded blocks, so no
task holds more than one group of blocks and one block of queries.

Defined cases: null vectors and vectors with a null or non-finite component take
no part; vectors of different lengths have no score with each other; a repeated id is a
row of its own, as a candidate and as a query with a list of its own, and only a query's
own row is no candidate of it; ties go to the smaller id; an empty table gives
no rows; columns besides ``vec_id, embedding`` are not read. Scores are exact below
2^63; larger weights raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import materialise

SCALE = 256
BLOCK = 64  # rows of a document-range block
GROUP_ROWS = 1_024  # rows a task holds as blocks
QUERY_ROWS = 4_096  # queries of a query block
OUT = "query_row long, query_id long, vec_id long, score long, scored long"
NONE = -(2**63 - 1)


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and the integer weights, for rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & e.isNotNull() & finite)
    return rows.select("vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("w"))


def _order_key(w: Column) -> Column:
    """Similar rows get equal leading terms: the three terms of largest weight."""
    ranked = F.slice(F.reverse(F.array_sort(F.transform(w, lambda x, i: F.struct(F.abs(x).alias("m"), x.alias("x"), i.alias("i"))))), 1, 3)
    return F.transform(ranked, lambda s: s["i"] * 2 + F.when(s["x"] > 0, 1).otherwise(0))


def _scores(q: np.ndarray, w: np.ndarray, largest: float) -> np.ndarray:
    """Inner products as 64-bit integers; ``largest``: a bound of their sums of products."""
    if largest < 2.0**53:
        return (q @ w.T).astype(np.int64)
    if largest < 2.0**63:
        return q.astype(np.int64) @ w.astype(np.int64).T
    raise OverflowError("inner products of these weights need more than 64 bits")


def _matrix(weights: pd.Series) -> np.ndarray:
    return np.stack(weights.to_numpy()).astype(np.float64)


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best k of ``rows`` (row, vec_id, w) for each of ``queries`` (query_row, query_id,
    q), block by block."""
    own, ids, w = rows["row"].to_numpy(), rows["vec_id"].to_numpy(), _matrix(rows["w"])
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(w, starts), np.minimum.reduceat(w, starts)
    qrows, qids, q = queries["query_row"].to_numpy(), queries["query_id"].to_numpy(), _matrix(queries["q"])
    largest = w.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(w).max(initial=0))
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    bounds += largest * 1e-12 * (largest >= 2.0**53)  # sums of floats are exact below
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((len(qids), k), NONE)
    best_id = np.full((len(qids), k), np.iinfo(np.int64).max)
    scored = np.zeros(len(qids), dtype=np.int64)
    alive = np.arange(len(qids))
    for step in range(len(starts)):
        # a block whose bound equals the k-th score may still hold a smaller id
        alive = alive[bounds[alive, order[alive, step]] >= best[alive, -1]]
        if not len(alive):
            break
        at = order[alive, step]
        for b in np.unique(at):
            mine, rng = alive[at == b], slice(starts[b], starts[b] + BLOCK)
            s = _scores(q[mine], w[rng], largest)
            scored[mine] += s.shape[1]
            other = qrows[mine][:, None] != own[rng][None, :]
            alls = np.concatenate([best[mine], np.where(other, s, NONE)], axis=1)
            allids = np.concatenate([best_id[mine], np.where(other, ids[rng][None, :], np.iinfo(np.int64).max)], axis=1)
            top = np.lexsort((allids, -alls), axis=1)[:, :k]
            best[mine] = np.take_along_axis(alls, top, axis=1)
            best_id[mine] = np.take_along_axis(allids, top, axis=1)
    found = best != NONE
    many = found.sum(axis=1)
    return pd.DataFrame({
        "query_row": np.repeat(qrows, many), "query_id": np.repeat(qids, many), "vec_id": best_id[found],
        "score": best[found], "scored": np.repeat(scored, many)})


def top_k(vectors: DataFrame, asks: Column, k: int = 5, groups: int | None = None) -> DataFrame:
    """The k best of all other rows of ``vectors`` (vec_id, w) for each row for which
    ``asks`` holds: query_id, rank, vec_id, score, and the rows scored for the query."""
    rows = materialise(vectors.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "w", F.size("w").alias("n"), _order_key(F.col("w")).alias("key"),
        F.coalesce(asks, F.lit(False)).alias("asks")), "topk-rows")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    groups = groups or max(1, -(-total // GROUP_ROWS))
    blocks = max(1, -(-asked // QUERY_ROWS))
    # rows of a leading term stay together, a common vector is dealt over groups
    lead = F.when(F.col("n") > 0, F.element_at("key", 1))
    left = rows.withColumn("g", F.pmod(F.xxhash64(lead, F.floor(F.col("row") / 997)), F.lit(groups))).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("g", F.col("b").cast("long").alias("b"), "n", "row", "vec_id", "w", "key")
    right = rows.where("asks").withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
        F.col("g").cast("long").alias("g"), "b", "n", F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("w").alias("q"))

    def run(r: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(r) or not len(q):
            return pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")}).astype("int64")
        order = sorted(range(len(r)), key=lambda i: (tuple(r["key"].iat[i]), r["vec_id"].iat[i]))
        return _search(q, r.iloc[order], k)

    keys = ["g", "b", "n"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, OUT)
    by_query = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
