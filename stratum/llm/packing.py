"""Packing along a space-filling curve.

A document's hashed word vector is projected to DIMS numbers, these are cut into
2**BITS steps each and read as one Hilbert key; neighbours on the curve are texts
of similar words. Spark range-sorts the token arrays by that key (ties by a hash
of doc_id, then by the row's place in the written tokens, so a key, a document or a row
that very many rows share is split over ranges too). There are so many ranges that one
holds about ``range_bytes`` of tokens, however large the input (observed while they were
written). Each range lays its documents one after another into sequences of LIMIT tokens,
cutting a document where a sequence is full. What is left at the end of a range
goes into sequences whose lengths are powers of two, so nothing is padded.

Tokens are written once below ``spark.checkpoint.dir`` before the sort: sampling
the ranges and a lost executor do not tokenise again. A range is read as a stream
and holds one open sequence.

Defined cases: null text is empty and has only its end id; texts without words
have the key of the origin; null doc_ids hash like a value; repeated rows are
packed each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratum.llm.bpe import ID_TYPE, PIECE_BYTES, ByteEncoder, encoder
from stratum.llm.common import RANGE_BYTES, materialise, range_width, ship_package
from stratum.llm.textnum import chunks, words

LIMIT = 1024
DIMS, BITS = 4, 12
SPREAD = 4.0  # means of up to 0.5 / SPREAD either side of the origin are told apart
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long"


def project(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, DIMS) coordinates in [0, 2**BITS): mean of the words' hashed directions, which
    lie within 0.5 of the origin; SPREAD widens the middle, what passes it is clipped."""
    size = np.bincount(doc, minlength=n)
    out = np.zeros((n, DIMS), dtype=np.uint64)
    for d in range(DIMS):
        way = ((h >> np.uint64(16 * d)) & np.uint64(0xFFFF)).astype(np.float64) / 65535.0 - 0.5
        mean = np.bincount(doc, weights=way, minlength=n) / np.maximum(size, 1)
        at = (mean * SPREAD + 0.5) * (1 << BITS)
        out[:, d] = np.clip(at, 0, (1 << BITS) - 1).astype(np.uint64)
    return out


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of (n, d) points of ``bits`` bits a coordinate:
    the coordinates are turned into the curve's transposed form by undoing the
    rotations level by level, Gray-decoded, and their bits interleaved."""
    x = points.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for i in range(dims):
            inside = (x[i] & q) != 0
            swap = np.where(inside, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        turn = np.where((x[-1] & q) != 0, turn ^ (q - one), turn)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key.astype(np.int64)


def _tokens(vocabulary: str, end_id: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = encoder(ByteEncoder, vocabulary), np.array([end_id], dtype=ID_TYPE).tobytes()
        for f in frames:
            for start, piece in chunks(f["text"].tolist(), PIECE_BYTES):
                h, doc = words(piece)
                yield pd.DataFrame({
                    "doc_id": f["doc_id"].iloc[start:start + len(piece)].astype("Int64").to_numpy(),
                    "key": hilbert_key(project(h, doc, len(piece))),
                    "ids": [i + end for i in own.batch(piece)],
                })

    return run


class _Layout:
    """Pieces of one range, in order; the open sequence is held until it is full."""

    def __init__(self, part: int, limit: int):
        self.limit, self.next, self.open, self.fill = limit, part << 32, [], 0
        self.out: list[tuple] = []

    def _close(self) -> None:
        at = 0
        for doc, start, ids, total in self.open:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, at, 0))
            at += len(ids)
        self.next, self.open, self.fill = self.next + 1, [], 0

    def add(self, doc, start: int, ids: np.ndarray, total: int, limit: int | None = None) -> None:
        limit, done = limit or self.limit, 0
        while done < len(ids):
            take = min(limit - self.fill, len(ids) - done)
            self.open.append((doc, start + done, ids[done:done + take], total))
            self.fill, done = self.fill + take, done + take
            if self.fill == limit:
                self._close()

    def finish(self) -> None:
        """Cuts the open sequence into lengths that are powers of two."""
        rest, left = self.open, self.fill
        self.open, self.fill = [], 0
        for piece_doc, start, ids, total in rest:
            while len(ids):
                size = 1 << (left.bit_length() - 1)
                take = min(size - self.fill, len(ids))
                self.add(piece_doc, start, ids[:take], total, size)
                if not self.open:
                    left -= size
                start, ids = start + take, ids[take:]

    def rows(self) -> pd.DataFrame:
        names = [c.split()[0] for c in PIECES.split(", ")]
        frame = pd.DataFrame(self.out, columns=names)
        frame["doc_id"] = pd.array([None if pd.isna(d) else int(d) for d in frame["doc_id"]], dtype="Int64")
        self.out = []
        return frame


def _lay(limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layout = _Layout(TaskContext.get().partitionId(), limit)
        for f in frames:
            for doc, ids in zip(f["doc_id"], f["ids"]):
                whole = np.frombuffer(ids, ID_TYPE)
                layout.add(doc, 0, whole, len(whole))
            yield layout.rows()
        layout.finish()
        yield layout.rows()

    return run


def pack(documents: DataFrame, vocabulary: str, end_id: int = 0, limit: int = LIMIT,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and padding (of its sequence: none)."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    written = Observation()
    keyed = docs.mapInPandas(_tokens(vocabulary, end_id), "doc_id long, key long, ids binary")
    tokens = materialise(keyed.observe(written, F.sum(F.octet_length("ids")).alias("bytes")), "pack-ids")
    salted = tokens.select("*", F.xxhash64("doc_id").alias("salt"), F.monotonically_increasing_id().alias("row"))
    width = range_width(spark, written.get["bytes"], range_bytes)
    along = salted.repartitionByRange(width, "key", "salt", "row").sortWithinPartitions("key", "salt", "ids")
    return along.select("doc_id", "ids").mapInPandas(_lay(limit), PIECES)
