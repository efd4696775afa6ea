"""Token ids in binary blocks with Elias-Fano document boundaries.

A block holds the ids of consecutive documents as one concatenated array and, in
place of an offset table, the boundaries as an Elias-Fano code: the low bits of
each boundary packed side by side, the high parts as a unary bit vector whose
set-bit positions are sampled, so that ``select`` finds a boundary from the
nearest sample. That takes about 2 + log2(ids / documents) bits a document.

    magic  "TIDB"   version u8   id width u8   low bits u8   reserved u8
    documents u32   ids u64   ids before this block in its part u64
    bytes of low u32, of high u32, samples u32
    document ids: null flags (packed bits), then int64 each
    low bits, high bits, samples (u32), ids (u16 or u32, little-endian)

Documents are dealt to parts by ranges of ``doc_id``, then of a hash of the text, then
of the row's place in the input (Spark's range partitioner), so neither an id nor a row
that very many rows share has to fit one part. Parts are sorted, encoded and written by
Spark as Parquet rows (part, seq, block): files on any storage Spark can write. There
are so many parts that one holds about ``range_bytes`` of text, however large the input
(one sum of lengths is taken before). Reading back needs one number per part, the ids
before it: a list as long as there are parts.

Defined cases: null text is empty and has only its end id; null doc_ids come
first, equal doc_ids in order of their text's xxhash64; an empty table writes no block;
further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.bpe import ID_TYPE, PIECE_BYTES, WordEncoder, encoder
from stratum.llm.common import RANGE_BYTES, range_width, ship_package
from stratum.llm.textnum import chunks

MAGIC, VERSION = b"TIDB", 1
SAMPLE = 64  # one select sample for so many boundaries
BLOCK_IDS = 1 << 20
_HEAD = struct.Struct("<4sBBBxIQQIII")


class EliasFano:
    """A non-decreasing sequence of numbers from 0 to ``last``."""

    def __init__(self, low_bits: int, n: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.low_bits, self.n, self.low, self.high, self.samples = low_bits, n, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        high[at] = 1
        return cls(low_bits, n, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"),
                   at[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        value = 0
        for b in range(self.low_bits):
            p = i * self.low_bits + b
            value |= ((int(self.low[p >> 3]) >> (p & 7)) & 1) << b
        return value

    def select(self, i: int) -> int:
        """The i-th number, from the nearest sample on."""
        at, need = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while need >= word.bit_count():
            need -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(need):
            word &= word - 1
        position = (byte << 3) + (word & -word).bit_length() - 1
        return ((position - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (((at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | low).astype(np.int64)


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], before: int) -> bytes:
    ends = np.cumsum([len(i) for i in ids])
    bounds = EliasFano.of(np.concatenate([[0], ends]))
    whole = np.concatenate(ids)
    width = 2 if not len(whole) or int(whole.max()) < 1 << 16 else 4
    null = np.packbits([d is None for d in doc_ids], bitorder="little")
    return b"".join([
        _HEAD.pack(MAGIC, VERSION, width, bounds.low_bits, len(ids), len(whole), before,
                   len(bounds.low), len(bounds.high), len(bounds.samples)),
        null.tobytes(), np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        bounds.low.tobytes(), bounds.high.tobytes(), bounds.samples.tobytes(), whole.astype(f"<u{width}").tobytes(),
    ])


class Block:
    """Reader of one block: ``bounds`` (Elias-Fano), ``ids`` and the documents."""

    def __init__(self, data: bytes):
        magic, version, width, low_bits, n, self.n_ids, self.before, n_low, n_high, n_samples = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block of this version")
        at = _HEAD.size

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        null = np.unpackbits(part("u1", -(-n // 8)), bitorder="little")[:n]
        self.doc_ids = [None if x else int(d) for x, d in zip(null, part("<i8", n))]
        low, high = part("u1", n_low), part("u1", n_high)
        self.bounds = EliasFano(low_bits, n + 1, low, high, part("<u4", n_samples))
        self.ids = part(f"<u{width}", self.n_ids)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def _encode_blocks(vocabulary: str, end_id: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, part = encoder(WordEncoder, vocabulary), TaskContext.get().partitionId()
        seq = before = held = 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        end = np.array([end_id], dtype=ID_TYPE)

        def block() -> pd.DataFrame:
            nonlocal seq, before, held, docs, ids
            row = pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [held], "block": [pack_block(docs, ids, before)]})
            seq, before, held, docs, ids = seq + 1, before + held, 0, [], []
            return row

        for f in frames:
            keys = [None if pd.isna(d) else int(d) for d in f["doc_id"]]
            for start, piece in chunks(f["text"].tolist(), PIECE_BYTES):
                for k, got in enumerate(own.batch(piece)):
                    docs.append(keys[start + k])
                    ids.append(np.concatenate([np.frombuffer(got, ID_TYPE), end]))
                    held += len(ids[-1])
                    if held >= BLOCK_IDS:
                        yield block()
        if docs:
            yield block()

    return run


def write_blocks(documents: DataFrame, path: str, vocabulary: str, end_id: int = 1, range_bytes: int = RANGE_BYTES) -> None:
    """Encodes every whole text, appends ``end_id`` and writes blocks in ascending
    doc_id order below ``path``."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    width = range_width(spark, docs.agg(F.sum(F.octet_length("text"))).first()[0], range_bytes)
    placed = docs.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = placed.repartitionByRange(width, "doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "text")
    blocks = ordered.select("doc_id", "text").mapInPandas(_encode_blocks(vocabulary, end_id), "part int, seq int, n_ids long, block binary")
    blocks.write.option("compression", "none").parquet(path)


def _read(bases: dict[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for part, data in zip(f["part"], f["block"]):
                b = Block(data)
                bounds, wide = b.bounds.decode(), b.ids.astype("<u4")
                yield pd.DataFrame({
                    "doc_id": pd.array(b.doc_ids, dtype="Int64"),
                    "start": bounds[:-1] + (bases[part] + b.before),
                    "n_tokens": np.diff(bounds),
                    "ids_crc32": [zlib.crc32(wide[s:e].tobytes()) for s, e in zip(bounds[:-1], bounds[1:])],
                })

    return run


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    ship_package(spark)
    blocks = spark.read.schema("part int, seq int, n_ids long, block binary").parquet(path)
    bases, total = {}, 0
    for part, n in blocks.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect():  # one row per part
        bases[part], total = total, total + n
    return blocks.select("part", "block").mapInPandas(_read(bases), "doc_id long, start long, n_tokens long, ids_crc32 long")
