"""Near duplicates: ProbMinHash signatures, banding, verification, components.

Texts are weighted sets of five-word shingles (weight: occurrences). A signature
component is the shingle whose arrival comes first in that register, arrivals
being a Poisson process of the shingle's weight whose points fall into uniform
registers; two texts agree in a register with probability J_P, their probability
Jaccard similarity. A text stops drawing arrivals once every register is taken
and the next arrivals come later than all of them. A second signature has all weights
1, so two texts agree in its registers with probability of their plain Jaccard
similarity; where no shingle repeats it is the first one, and is not kept twice.

1. Equal texts collapse to one (by 128-bit digest), combined before the shuffle.
2. Bands of both signatures name buckets (one name for both, so a text without
   repeats meets others by either). In every bucket the members are paired
   with one hub, the member that shares most buckets, never with each other.
3. Pairs are verified on their whole texts: a link has J_P, or plain Jaccard, of
   0.8 or more. Links give components.
4. A bucket that still holds several components takes another hub; after
   STAR_ROUNDS the members that are left are compared through their signatures
   in blocks, and what the two estimates do not both rule out (five standard deviations
   below 0.8) is verified there, so that only links leave a block. So every pair
   that shares a bucket is either verified, ruled out by both estimates, or already
   in one component.

With 24 bands of 4 a pair of similarity 0.8 shares no bucket once in 300,000.

Defined cases: null text is the empty text; texts without words have no shingles
and stay alone unless equal texts exist; null doc_ids form links like others, the
class of a group of null ids is null; repeated rows are equal texts; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import materialise, ship_package
from stratum.llm.components import components
from stratum.llm.textnum import _GOLDEN, chunks, mix, weighted_shingles

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
SIMILARITY = 0.8
RULED_OUT = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
STAR_ROUNDS = 2
BLOCK = 512  # members of a block in the comparison of what is left
_SEED = np.uint64(0x5851F42D4C957F2D)


def prob_minhash(doc: np.ndarray, h: np.ndarray, w: np.ndarray, n: int, k: int = REGISTERS) -> np.ndarray:
    """(n, k) signatures as uint32; texts without elements have zeros."""
    best, sig = np.full(n * k, np.inf), np.zeros(n * k, dtype=np.uint32)
    total = np.bincount(doc, weights=w, minlength=n)
    with np.errstate(divide="ignore"):
        limit = k * (np.log(k) + 1) / total
    state = mix(h * _GOLDEN + _SEED)
    mark = (state >> np.uint64(32)).astype(np.uint32)
    at, point = np.zeros(len(h)), np.zeros(len(h), dtype=np.uint64)

    def arrive(e: np.ndarray) -> None:
        """Moves elements ``e`` to their next arrival."""
        point[e] += np.uint64(1)
        u = mix(state[e] + point[e] * _GOLDEN)
        at[e] += -np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w[e]

    live = np.arange(len(h))
    arrive(live)
    while len(live):
        now = live[at[live] <= limit[doc[live]]]
        while len(now):
            register = mix(state[now] ^ (point[now] * _SEED)) % np.uint64(k)
            key = doc[now] * k + register.astype(np.int64)
            np.minimum.at(best, key, at[now])
            first = best[key] == at[now]
            sig[key[first]] = mark[now[first]]
            arrive(now)
            now = now[at[now] <= limit[doc[now]]]
        worst = best.reshape(n, k).max(axis=1)  # infinite while a register is free
        limit = np.where(np.isinf(worst), limit * 2, worst)
        live = live[np.isinf(worst)[doc[live]]]
    return sig.reshape(n, k)


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        texts = f["text"].tolist()
        for start, piece in chunks(texts):
            doc, h, w = weighted_shingles(piece)
            sig = prob_minhash(doc, h, w.astype(np.float64), len(piece))
            has = np.bincount(doc, minlength=len(piece)) > 0
            most = np.zeros(len(piece), np.int64)
            np.maximum.at(most, doc, w)
            repeats = most > 1
            own = repeats[doc]
            place = np.cumsum(repeats) - 1
            plain = prob_minhash(place[doc[own]], h[own], np.ones(int(own.sum())), int(repeats.sum()))
            part = f.iloc[start:start + len(piece)]
            yield pd.DataFrame({"tid": part["tid"], "doc_id": part["doc_id"],
                                "sig": [s.tobytes() if x else None for s, x in zip(sig, has)],
                                "plain": [plain[k].tobytes() if x else None for k, x in zip(place, repeats)]})


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(J_P, plain Jaccard) of two texts given as (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0, 0.0
    x, y = a[1][i] / a[1].sum(), b[1][j] / b[1].sum()
    plain = len(i) / (len(a[0]) + len(b[0]) - len(i))
    ratio = np.round(x / y, 12)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.searchsorted(ratio, ratio, side="left")
    xs, ys = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]]), np.concatenate([[0.0], np.cumsum(y)])
    only_a, only_b = 1 - x.sum(), 1 - y.sum()
    return float((1 / ((xs[below] + only_a) / x + (ys[below] + only_b) / y)).sum()), plain


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        slot: dict[bytes, int] = {}
        texts: list[str] = []
        for tid, t in (("a", "ta"), ("b", "tb")):
            for k, x in zip(f[tid], f[t]):
                if k not in slot:
                    slot[k] = len(texts)
                    texts.append(x)
        sets = _weighted(texts)
        linked = [max(similarity(sets[slot[a]], sets[slot[b]])) >= SIMILARITY - 1e-9 for a, b in zip(f["a"], f["b"])]
        yield f.loc[linked, ["a", "b"]].rename(columns={"a": "u", "b": "v"})


def _signatures(f: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weighted and plain signatures, (members, REGISTERS) each."""
    plain = [s if p is None else p for s, p in zip(f["sig"], f["plain"])]
    return tuple(np.stack([np.frombuffer(x, np.uint32) for x in own]) for own in (f["sig"], plain))


def _candidates(left: pd.DataFrame, right: pd.DataFrame, band: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of ``left``, rows of ``right``) that an estimate leaves in: of different
    components, and sharing no band before this one, where they are compared too."""
    (lw, lp), (rw, rp) = _signatures(left), _signatures(right)
    names = {label: k for k, label in enumerate({*left["label"], *right["label"]})}
    rl = np.array([names[x] for x in right["label"]])
    odd = np.flatnonzero((rw != rp).any(axis=1))  # the others have one signature
    for i, label in enumerate(left["label"]):
        agree = rw == lw[i]
        near = agree.mean(axis=1) >= RULED_OUT
        if (lw[i] != lp[i]).any():
            near |= (rp == lp[i]).mean(axis=1) >= RULED_OUT
        elif len(odd):
            near[odd] |= (rp[odd] == lp[i]).mean(axis=1) >= RULED_OUT
        near &= rl != names[label]
        at = np.flatnonzero(near)
        if len(at):
            met = np.zeros((len(at), BANDS), dtype=bool)
            for mine in (lw[i], lp[i]):
                for theirs in (rw, rp):
                    met |= (theirs[at] == mine).reshape(-1, BANDS, ROWS).all(axis=2)
            at = at[met.argmax(axis=1) == band]
        if len(at):
            yield i, at


def _weighted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted shingle hashes, occurrences) of each text."""
    sets = []
    for _, piece in chunks(texts):
        doc, h, w = weighted_shingles(piece)
        cut = np.searchsorted(doc, np.arange(len(piece) + 1))
        sets += [(h[s:e], w[s:e].astype(np.float64)) for s, e in zip(cut[:-1], cut[1:])]
    return sets


def _compare_blocks(f: pd.DataFrame) -> pd.DataFrame:
    """Links of one cell (two blocks of one bucket).

    Candidates are verified here. J_P is at most the overlap of the two
    distributions and equals plain Jaccard where no shingle repeats, so J_P itself is
    worked out only for repeating shingles and an overlap of 0.8."""
    left, right = f[f["side"] != 1], f[f["side"] != 0]
    out: list[tuple[bytes, bytes]] = []
    if len(left) and len(right):
        ls, rs = _weighted(left["text"].tolist()), _weighted(right["text"].tolist())
        known, which = np.unique(np.concatenate([h for h, _ in rs]), return_inverse=True)
        parts = np.split(which, np.cumsum([len(h) for h, _ in rs])[:-1])
        share = [w / w.sum() for _, w in rs]
        repeats = np.array([w.max() > 1 for _, w in rs])
        lt, rt = left["tid"].tolist(), right["tid"].tolist()
        held = np.zeros(len(known))
        for i, near in _candidates(left, right, int(f["band"].iat[0])):
            h, w = ls[i]
            slot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            own = known[slot] == h
            held[:] = 0
            held[slot[own]] = w[own] / w.sum()
            size = np.array([len(parts[j]) for j in near])
            begin = np.cumsum(size) - size
            theirs = held[np.concatenate([parts[j] for j in near])]
            overlap = np.add.reduceat(np.minimum(theirs, np.concatenate([share[j] for j in near])), begin)
            common = np.add.reduceat((theirs > 0).astype(np.int64), begin)
            linked = common / (len(h) + size - common) >= SIMILARITY - 1e-9
            for k in np.flatnonzero(~linked & (overlap >= SIMILARITY - 1e-9) & (repeats[near] | (w.max() > 1))):
                linked[k] = similarity(ls[i], rs[near[k]])[0] >= SIMILARITY - 1e-9
            out += [(lt[i], rt[j]) for j in near[linked]]
    return pd.DataFrame(out, columns=["u", "v"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that their whole texts verify, as (u, v)."""
    a = texts.select(F.col("tid").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("tid").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInPandas(_verify, "u binary, v binary")


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), tid, is_kept: one row per row
    of ``documents``, True on one row of each class (least doc_id, then digest)."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select(F.unhex(F.md5("text")).alias("tid"), "doc_id", "text")
    signed = materialise(docs.mapInPandas(_sign, "tid binary, doc_id long, sig binary, plain binary"), "nd-sig")
    owners = materialise(signed.groupBy("tid").agg(
        F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig"),
        F.min("plain").alias("plain")), "nd-own")

    def named(signature: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(
            b, F.substring(signature, b * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("bucket")))

    both = F.when(F.col("plain").isNull(), named(F.col("sig"))).otherwise(F.array_union(named(F.col("sig")), named(F.col("plain"))))
    bands = owners.where(F.col("sig").isNotNull()).select("tid", F.inline(both))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = materialise(bands.join(shared, "bucket").select(  # a window holds 2 * BANDS rows of a text at most
        "tid", "band", "bucket", F.sum("n").over(Window.partitionBy("tid")).alias("weight")), "nd-mem")

    wanted = owners.join(members, "tid", "leftsemi").select("tid", "owner")
    same = docs["tid"].eqNullSafe(wanted["tid"]) & docs["doc_id"].eqNullSafe(wanted["owner"])
    texts = materialise(docs.join(wanted, same, "leftsemi").dropDuplicates(["tid"]).select("tid", "text"), "nd-txt")

    labels = spark.createDataFrame([], "node binary, label binary")
    for turn in range(STAR_ROUNDS + 1):
        if turn:
            members = _unsettled(members, labels, turn)
            if members.isEmpty():
                break
        if turn < STAR_ROUNDS:
            label = ["label"] if turn else []
            hubs = members.groupBy("bucket").agg(F.max(F.struct("weight", "tid", *label)).alias("hub")).select(
                F.col("bucket").alias("hb"), F.col("hub.tid").alias("hub"), *[F.col(f"hub.{x}").alias("hl") for x in label])
            met = members.join(hubs, F.col("bucket") == F.col("hb")).where(F.col("tid") != F.col("hub"))
            found = _links((met.where(F.col("label") != F.col("hl")) if turn else met).select(
                F.least("tid", "hub").alias("a"), F.greatest("tid", "hub").alias("b")).distinct(), texts)
            members = materialise(members.join(hubs, F.col("bucket") == F.col("hb"), "left").where(
                F.col("tid") != F.col("hub")).select("tid", "band", "bucket", "weight"), "nd-left")
        else:
            found = _left_over(members, owners, texts)
        labels = components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).unionAll(found))

    by_text = owners.join(labels, owners["tid"] == labels["node"], "left").select(
        "tid", "owner", F.coalesce("label", "tid").alias("label"))
    groups = by_text.groupBy("label").agg(
        F.min("owner").alias("class_id"), F.min(F.struct(F.col("owner").isNull(), "owner", "tid"))["tid"].alias("keep"))
    per_text = materialise(by_text.join(groups, "label").select("tid", "class_id", "owner", "label", "keep"), "nd-class")
    rows = documents.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("tid"), "doc_id")
    return rows.join(per_text, "tid").select(
        "doc_id", "class_id", "tid", "label",
        ((F.col("tid") == F.col("keep")) & F.col("doc_id").eqNullSafe(F.col("owner"))).alias("is_kept"))


def _unsettled(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Members of buckets that still hold several components, with their label."""
    m = members.join(labels, members["tid"] == labels["node"], "left").select(
        "tid", "band", "bucket", "weight", F.coalesce("label", "tid").alias("label"))
    split = m.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(
        F.col("lo") != F.col("hi")).select("bucket")
    return materialise(m.join(split, "bucket", "leftsemi"), f"nd-open{turn}")


def _left_over(members: DataFrame, owners: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of what is left, from blocks of about BLOCK members at most."""
    n = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    m = members.join(n, "bucket").join(owners.select("tid", "sig", "plain"), "tid").join(texts, "tid")
    own = m.withColumn("own", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "tid", "label", "sig", "plain", "text",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    return cells.groupBy("bucket", "x", "y").applyInPandas(_compare_blocks, "u binary, v binary")


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class, all columns as they were. Rows equal
    in doc_id and text count once."""
    kept = classes(documents).where("is_kept").select(F.col("tid").alias("__tid"), F.col("doc_id").alias("__id")).distinct()
    tid = F.unhex(F.md5(F.coalesce(documents["text"], F.lit(""))))
    same = (tid == kept["__tid"]) & documents["doc_id"].eqNullSafe(kept["__id"])
    rows = documents.join(kept, same, "leftsemi")
    return rows.dropDuplicates(["doc_id", "text"])
