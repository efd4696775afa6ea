"""Divergence audit of sources: how far each (lang, source) group's words are from the
other sources of its language, and which words set it apart.

Each task runs an Arrow compute pipeline over its batches: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and a hash ``group_by`` turn texts into
partial counts (lang, source, term, occurrences, documents), merged inside the task, so
a hot source sends one row a term and task. Spark sums them by (lang, term), where the
terms of at least ``min_docs`` documents are kept, and deals them over columnar shards
by the term's hash. A shard holds all groups' counts of its terms and sums, for each
pair of sources, what its terms add; the sums of shards meet in one aggregate.

With ``count`` occurrences of a term in a group of ``N`` kept occurrences and ``V`` kept
terms of the language, ``p = 1 + floor(10^9 (count + 1) / (N + V))``; a term adds
``floor((p - q)^2 / q)``. All of it is integer arithmetic: the quotient is taken by long
division, so counts may reach 9 * 10^15.

Defined cases: null text, lang and source are empty strings; every row is a document of
its own (repeated ids and rows count each); a group without terms is a group, its pairs
are 0 where the language keeps no term; a source alone in its language has no pair; ties
go to the smaller item in UTF-8 order; an empty table gives no rows; columns besides
``lang, source, text`` are not read.

A task holds one shard: about ``SHARD_ROWS`` counts, the groups of one language, and the
pairs of at most ``PART_SOURCES`` sources with all others of the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import materialise, ship_package

# Fixed value: what a term does not hold.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
FLUSH_ROWS = 200_000  # partial counts a task holds before it sends them
SHARD_ROWS = 100_000  # counts of a shard, on average
PART_SOURCES = 512  # sources whose pairs one task sums
CELLS = 1 << 20  # terms x sources laid out at once
PARTIAL = "lang string, source string, term string, n long, docs long"
CELL = "lang string, source string, part string, item string, value long"
_KEYS = ["lang", "source", "term"]


# ------------------------------------------------------------------ partial counts
def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """Partial counts of one batch; a row without a term marks each group of it."""
    groups = {k: pc.dictionary_encode(batch.column(k)) for k in ("lang", "source")}
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=SEPARATORS)
    rows, terms = pc.list_parent_indices(words), pc.dictionary_encode(pc.list_flatten(words))
    found = pa.table({"row": rows, "term": terms.indices})
    blank = pc.index(terms.dictionary, "").as_py()  # before and after outer separators
    if blank >= 0:
        found = found.filter(pc.not_equal(found["term"], blank))
    per_doc = found.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    for k, v in groups.items():
        per_doc = per_doc.append_column(k, v.indices.take(per_doc["row"]))
    per_group = per_doc.group_by(_KEYS, use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    counted = pa.table({
        "lang": groups["lang"].dictionary.take(per_group["lang"]), "source": groups["source"].dictionary.take(per_group["source"]),
        "term": terms.dictionary.take(per_group["term"]), "n": per_group["count_all_sum"], "docs": per_group["count_all_count"]})
    seen = pa.table({k: batch.column(k) for k in ("lang", "source")}).group_by(["lang", "source"], use_threads=False).aggregate([])
    nothing = pa.nulls(len(seen), pa.string()), *[pa.array(np.zeros(len(seen), np.int64))] * 2
    return pa.concat_tables([counted, pa.table([seen["lang"], seen["source"], *nothing], names=counted.column_names)])


def _merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return t.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select([*_KEYS, "n", "docs"])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(count_terms(batch))
        if sum(map(len, held)) >= FLUSH_ROWS:
            held = [_merged(held)]
            if 2 * len(held[0]) >= FLUSH_ROWS:
                yield from held.pop().combine_chunks().to_batches(max_chunksize=FLUSH_ROWS)
    if held:
        yield from _merged(held).combine_chunks().to_batches(max_chunksize=FLUSH_ROWS)


# ------------------------------------------------------------------ arithmetic
def scaled(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / whole), by long division: 10^9 as three digits of 1000."""
    quotient, rest = np.divmod(np.asarray(count, np.int64) + 1, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digit
    return 1 + quotient


def added(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pairs(term: np.ndarray, source: np.ndarray, p: np.ndarray, p0: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """For each of ``mine`` (rows) and every source: the sum over the terms of what they
    add. ``term, source, p``: the counted cells, sorted by term; ``p0``: each source's p
    where it has no occurrence. Work follows the counted cells: terms that both sources
    lack are counted, not visited."""
    total = np.zeros((len(mine), len(p0)), np.int64)
    if not len(term):
        return total
    step, last = max(1, CELLS // len(p0)), int(term[-1]) + 1
    cuts = np.searchsorted(term, np.arange(0, last + step, step))
    for k, (start, end) in enumerate(zip(cuts[:-1], cuts[1:])):
        n_terms = min(step, last - k * step)
        t, s, here = term[start:end] - k * step, source[start:end], p[start:end]
        dense = np.tile(p0, (n_terms, 1))
        dense[t, s] = here
        present = np.zeros(dense.shape, bool)
        present[t, s] = True
        by = np.argsort(s, kind="stable")
        t, s, here = t[by], s[by], here[by]
        heads = np.searchsorted(s, np.arange(len(p0) + 1))
        filled = np.flatnonzero(np.diff(heads))  # sources with a cell in these terms
        for i, a in enumerate(mine):
            own = t[heads[a]:heads[a + 1]]
            total[i] += added(dense[own, a][:, None], dense[own]).sum(axis=0)
            lacking = ~present[t, a]
            total[i, filled] += np.add.reduceat(np.where(lacking, added(p0[a], here), 0), heads[filled])
            neither = np.full(len(p0), n_terms - len(own), np.int64)
            neither[filled] -= np.add.reduceat(lacking.astype(np.int64), heads[filled])
            total[i] += neither * added(p0[a], p0)
    return total


def shard_cells(cells: pa.Table, groups: pa.Table, parts: int, part: int, top: int) -> pa.Table:
    """One shard of a language: sums for pairs of sources, and the terms above the
    language's share (at most ``top`` a source: no other can be among the first ``top``)."""
    order = pc.sort_indices(groups["source"])
    names = groups["source"].combine_chunks().take(order)
    whole, v, lang_whole = (groups[c].to_numpy()[order] for c in ("n", "v", "lang_n"))
    whole, n, lang = whole + v, len(names), groups["lang"][0].as_py()
    mine = np.flatnonzero(np.arange(n) % parts == part)
    sums = np.zeros((len(mine), n), np.int64)
    out = {"source": [], "part": [], "item": [], "value": []}
    if len(cells):
        words = pc.dictionary_encode(cells["term"].combine_chunks())
        term, source = words.indices.to_numpy(), pc.index_in(cells["source"].combine_chunks(), value_set=names).to_numpy()
        by = np.lexsort((source, term))
        term, source, count, of_lang = term[by], source[by], cells["n"].to_numpy()[by], cells["term_n"].to_numpy()[by]
        p = scaled(count, whole[source])
        sums = _pairs(term, source, p, scaled(np.zeros(n, np.int64), whole), mine)
        q = scaled(of_lang, lang_whole[0] + v[0])
        above = np.flatnonzero((p > q) & (source % parts == part))
        place = np.empty(len(words.dictionary), np.int64)  # code point order is that of UTF-8
        place[np.argsort(words.dictionary.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(place))
        value = added(p[above], q[above])
        by = np.lexsort((place[term[above]], -value, source[above]))
        above, value = above[by], value[by]
        first = np.searchsorted(source[above], source[above])
        best = np.arange(len(above)) - first < top
        above, value = above[best], value[best]
        out = {"source": names.take(pa.array(source[above])).to_pylist(), "part": ["term"] * len(above),
               "item": words.dictionary.take(pa.array(term[above])).to_pylist(), "value": value.tolist()}
    a, b = np.nonzero(mine[:, None] != np.arange(n)[None, :])
    pairs = {"source": names.take(pa.array(mine[a])).to_pylist(), "part": ["pair"] * len(a),
             "item": names.take(pa.array(b)).to_pylist(), "value": sums[a, b].tolist()}
    found = {k: out[k] + pairs[k] for k in out}
    types = {"value": pa.int64()}
    return pa.table({"lang": pa.array([lang] * len(found["item"]), pa.string())} |
                    {k: pa.array(x, types.get(k, pa.string())) for k, x in found.items()})


# ------------------------------------------------------------------ Spark
def term_counts(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, term_n (the language's occurrences), is_first (one row a
    kept term of the language) of kept terms; a row without a term for every group."""
    ship_package(documents.sparkSession)
    texts = documents.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = texts.mapInArrow(_partials, PARTIAL).repartition("lang", "term")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term").orderBy("source")
    whole = by_term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counts.select("lang", "source", "term", "n", F.sum("n").over(whole).alias("term_n"),
                           F.sum("docs").over(whole).alias("docs"), (F.row_number().over(by_term) == 1).alias("is_first"))
    return ranked.where(F.col("term").isNull() | (F.col("docs") >= min_docs)).drop("docs")


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    counts = materialise(term_counts(documents, min_docs), "divergence-counts")
    kept = F.col("term").isNotNull()
    of_lang = Window.partitionBy("lang")
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if(kept & F.col("is_first")).alias("v"))
    groups = groups.withColumns({"v": F.sum("v").over(of_lang), "lang_n": F.sum("n").over(of_lang),
                                 "sources": F.count(F.lit(1)).over(of_lang)})
    groups = materialise(groups, "divergence-groups")
    n_groups, widest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("sources"), F.lit(0))).first()
    rows = counts.where(kept).count()
    shards = max(1, rows // max(SHARD_ROWS, 4 * n_groups))  # groups go to every shard: never more than the counts do
    parts = max(1, -(-widest // PART_SOURCES))

    def spread(name: str, n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    cells = counts.where(kept).select("lang", "source", "term", "n", "term_n", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"),
                                      spread("part", parts))
    keys = ["lang", "shard", "part"]
    sides = groups.select("*", spread("shard", shards)).select("*", spread("part", parts))

    def shard(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return shard_cells(left, right, parts, key[2].as_py(), top)

    found = materialise(cells.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(shard, CELL), "divergence-cells")
    by_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    group = ["lang", "source", "part", "item"]
    pairs = found.where(F.col("part") == "pair").groupBy(*group).agg(F.sum("value").alias("value"))
    terms = found.where(F.col("part") == "term").select(*group, "value")
    ranked = [f.withColumn("rank", F.row_number().over(by_group)) for f in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
