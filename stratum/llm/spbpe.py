"""SentencePiece BPE with seeded merge dropout, and its lossless inverse.

Symbols of a segment (a run of spaces with what follows it) merge in the order of
an agenda: best score first, leftmost among equals. Every candidate that comes up
is skipped for good if a keyed hash of (seed, doc_id, place of the segment in the
text, left, right, position in the segment) falls below the dropout rate; skipped
candidates leave their symbols free for others. So each occurrence of a word is cut by
its own draws, in every document, always into pieces of the vocabulary. At rate 0 the
ids are those of the sentencepiece library.

A worker keeps the undropped agenda of each distinct segment: its ids, and the
candidates that come up. An occurrence at which none of those is skipped has these ids;
all others go through their own agendas.

Segments of up to WIDE symbols go through their agendas together, one candidate
per segment and step, in numpy; longer ones and those with characters outside the
vocabulary (written as byte pieces) one by one. A literal U+2581, which the plain
format cannot tell from a space, is written as bytes too, so decoding returns every
text as it was.

Defined cases: null text is empty and has no ids; null doc_ids have one key; repeated rows are encoded each; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.bpe import _SPACED as SPACED
from stratum.llm.bpe import CHUNK_END, ID_TYPE, PIECE_BYTES, ChunkEncoder, _Store, irregular, words_and_lines
from stratum.llm.common import ship_package
from stratum.llm.textnum import _GOLDEN, chunks, code_points, mix

RATE, SEED = 0.1, 20_240_601
WIDE = 32
_NONE = np.iinfo(np.int32).max
_SEGMENT = re.compile(r" *[^ \n]+|\n| +")
_LEFT, _RIGHT, _PLACE = (int(x) for x in mix(np.arange(11, 14, dtype=np.uint64) * _GOLDEN) | np.uint64(1))
_WORD = (1 << 64) - 1


def _base(seed: int, variant: int) -> int:
    return int(mix(np.array([(seed * 0x9E3779B97F4A7C15 + variant * 0xD6E8FEB86659FD93 + 1) & _WORD], dtype=np.uint64))[0])


def _at(salt: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Keys of the ``nth`` segments of texts with key ``salt``."""
    return mix(salt + (nth.astype(np.uint64) + np.uint64(1)) * _GOLDEN)


def _candidate(left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
    h = (left.astype(np.uint64) * np.uint64(_LEFT)) ^ (right.astype(np.uint64) * np.uint64(_RIGHT))
    return h ^ (place.astype(np.uint64) * np.uint64(_PLACE))


def _skips(base: np.ndarray, candidate: np.ndarray, rate: float) -> np.ndarray:
    return (mix(base ^ candidate) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < rate


def _spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... (counts[0] of them), begins[1], ..."""
    ends = np.cumsum(counts)
    return np.repeat(begins - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Pieces(ChunkEncoder):
    """Vocabulary of a SentencePiece BPE model: merges, single characters, bytes."""

    GAP = b"\x0b"
    _open: dict[tuple[str, float], Pieces] = {}

    def __init__(self, path: str, rate: float = RATE):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        self._agendas = _Store()  # candidates of undropped agendas, 64 bits each
        self.rate = rate
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        names = [model.id_to_piece(i).replace("▁", " ") for i in range(n)]
        own = {p: i for i, p in enumerate(names) if not special[i] and not byte[i]}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if byte[i]}
        self.raw = [bytes([int(p[3:5], 16)]) if byte[i] else b"" if special[i] else p.encode() for i, p in enumerate(names)]
        scores = sorted({model.get_score(i) for i in own.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        merges = {(own[p[:k]], own[p[k:]]): i for p, i in own.items() for k in range(1, len(p)) if p[:k] in own and p[k:] in own}
        self.n = n
        self.merge = {pair: (rank[model.get_score(i)], i) for pair, i in merges.items()}
        keys = sorted((a * n + b, *v) for (a, b), v in self.merge.items())
        self.keys, self.ranks, self.to = (np.array(x) for x in zip(*keys))
        self.ranks = self.ranks.astype(np.int32)
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in own.items():
            if len(p) == 1:
                self.char[ord(p)] = i

    @classmethod
    def get(cls, path: str, rate: float = RATE) -> Pieces:
        """One vocabulary a worker and rate."""
        if (path, rate) not in cls._open:
            cls._open[path, rate] = cls(path, rate)
        return cls._open[path, rate]

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of pairs; _NONE where a side is missing or nothing merges."""
        key = left.astype(np.int64) * self.n + right
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[slot] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[slot], _NONE).astype(np.int32), self.to[slot]

    def one(self, segment: str, base: int, rate: float, met: list | None = None) -> list[int]:
        """The agenda for one segment, with byte pieces where they are needed; ``met``
        takes its candidates."""
        sym = [int(self.char[ord(c)]) for c in segment]
        end = len(sym)
        nxt, prv, agenda = list(range(1, end + 1)), list(range(-1, end - 1)), []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < end and (found := self.merge.get((sym[i], sym[j]))):
                heapq.heappush(agenda, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(end - 1):
            offer(i, i + 1)
        gone = [False] * end
        while agenda:
            _, i, a, b, to = heapq.heappop(agenda)
            j = nxt[i]
            if gone[i] or j >= end or sym[i] != a or sym[j] != b:
                continue
            c = _candidate(*(np.array([x], dtype=np.uint64) for x in (a, b, i)))
            if met is not None:
                met.append(c[0])
            if rate and _skips(np.array([base], dtype=np.uint64), c, rate)[0]:
                continue
            sym[i], gone[j], nxt[i] = to, True, nxt[j]
            if nxt[i] < end:
                prv[nxt[i]] = i
            offer(i, nxt[i])
            offer(prv[i], i)
        out: list[int] = []
        for i, s in enumerate(sym):
            if not gone[i]:
                out += [s] if s >= 0 else [self.byte_id[b] for b in segment[i].encode("utf-8", "surrogatepass")]
        return out

    def _together(self, sym: np.ndarray, base: np.ndarray, rate: float, met: list | None = None) -> np.ndarray:
        """Agendas of many segments: ``sym`` (segments, width), -1 beyond a segment.
        ``met`` takes (rows, candidates) of every step."""
        n, width = sym.shape
        nxt = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        prv = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        rank, to = np.full((n, width), _NONE, np.int32), np.zeros((n, width), np.int64)
        if width > 1:
            rank[:, :-1], to[:, :-1] = self._find(sym[:, :-1], sym[:, 1:])
        rows = np.arange(n)
        while True:
            at = rank[rows].argmin(axis=1)
            open_ = rank[rows, at] != _NONE
            rows, at = rows[open_], at[open_]
            if not len(rows):
                return sym
            j = nxt[rows, at]
            a, b = sym[rows, at], sym[rows, j]
            rank_new = np.full(len(rows), _NONE, np.int32)
            skip = np.zeros(len(rows), bool)
            if rate or met is not None:
                c = _candidate(a, b, at)
                if met is not None:
                    met.append((rows, c))
                if rate:
                    skip = _skips(base[rows], c, rate)
            rank[rows, at] = rank_new
            r, i, j = rows[~skip], at[~skip], j[~skip]
            sym[r, i] = to[r, i]
            sym[r, j], rank[r, j] = -1, _NONE
            k = nxt[r, j]
            nxt[r, i] = k
            inner = k < width
            prv[r[inner], k[inner]] = i[inner]
            rank[r[inner], i[inner]], to[r[inner], i[inner]] = self._find(sym[r[inner], i[inner]], sym[r[inner], k[inner]])
            p = prv[r, i]
            after = p >= 0
            rank[r[after], p[after]], to[r[after], p[after]] = self._find(sym[r[after], p[after]], sym[r[after], i[after]])

    def _cut(self, segments: list[str], which: np.ndarray, base: np.ndarray, rate: float,
             met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many each) of segments[which], ``base`` their keys.
        ``met`` takes (occurrences, candidates) of every step."""
        cps, begins = code_points(segments)
        ids, size = self.char[cps], np.diff(begins) - 1
        ids[begins[1:] - 1] = -1
        known = np.add.reduceat((ids < 0).astype(np.int64), begins[:-1]) == 1 if len(segments) else np.zeros(0, bool)
        counts = np.zeros(len(which), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        done, long, plain = 0, size[which], known[which]
        for width in (4, 8, 12, 16, WIDE):
            pick = np.flatnonzero(plain & (long > done) & (long <= width))
            done = width
            if not len(pick):
                continue
            grid = begins[which[pick]][:, None] + np.minimum(np.arange(width), long[pick][:, None])
            own = None if met is None else []
            sym = self._together(ids[grid], base[pick], rate, own)
            if met is not None:
                met += [(pick[rows], c) for rows, c in own]
            live = sym >= 0
            counts[pick] = live.sum(axis=1)
            parts.append((pick, sym[live].astype(ID_TYPE)))
        for s in np.flatnonzero(~plain | (long > WIDE)).tolist():
            own = None if met is None else []
            new = np.array(self.one(segments[which[s]], int(base[s]), rate, own), dtype=ID_TYPE)
            if own:
                met.append((np.full(len(own), s), np.array(own, dtype=np.uint64)))
            counts[s] = len(new)
            parts.append((np.array([s]), new))
        out, starts = np.zeros(int(counts.sum()), ID_TYPE), np.cumsum(counts) - counts
        for pick, new in parts:
            out[_spread(starts[pick], counts[pick])] = new
        return out, counts

    def segments(self, segments: list[str], base: np.ndarray, rate: float) -> list[bytes]:
        """Ids of each segment, ``base`` its key."""
        ids, counts = self._cut(segments, np.arange(len(segments)), base, rate)
        ends = np.cumsum(counts)
        return [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]

    def batch(self, piece: list[bytes], salts: np.ndarray | None = None) -> list[bytes]:
        """Ids of each text of ``piece`` (UTF-8 bytes), ``salts`` the texts' keys."""
        if salts is None:
            salts = np.zeros(len(piece), np.uint64)
        begins = np.cumsum([0] + [len(b) + 1 for b in piece])
        buf = np.frombuffer(self.GAP.join(piece) + self.GAP, dtype=np.uint8)
        gap = begins[1:] - 1
        odd = np.unique(np.searchsorted(begins, np.flatnonzero(self._odd(buf, begins, gap)), side="right") - 1)
        if len(odd):
            alone = {i: self.ids(piece[i].decode("utf-8", "surrogatepass"), int(salts[i])) for i in odd.tolist()}
            rest = self.batch([b"" if i in alone else b for i, b in enumerate(piece)], salts)
            return [alone.get(i, r) for i, r in enumerate(rest)]
        first, keys = self._chunks(buf, gap)
        if not len(first):
            return [b""] * len(piece)
        text = np.searchsorted(begins, first, side="right") - 1
        base = _at(salts[text], np.arange(len(first)) - np.searchsorted(first, begins)[text])
        distinct, one, which = np.unique(keys, return_index=True, return_inverse=True)
        raw = buf.tobytes()
        absent = self._store.missing(distinct)
        self._agendas.missing(distinct)  # starts anew together with the ids
        if len(absent):
            self._learn(distinct[absent], self._strings(raw, first[one[absent]].tolist()))
        at, n = self._store.take(distinct)
        counts = n[which]
        dropped = self._touched(distinct, which, base) if self.rate else np.zeros(len(which), bool)
        hit = np.flatnonzero(dropped)
        new = np.zeros(0, ID_TYPE)
        if len(hit):
            own, place = np.unique(which[hit], return_inverse=True)
            new, counts[hit] = self._cut(self._strings(raw, first[one[own]].tolist()), place, base[hit], self.rate)
        mine = np.repeat(dropped, counts)
        ids = np.zeros(len(mine), ID_TYPE)
        ids[mine] = new
        ids[~mine] = self._store.pool[_spread(at[which[~dropped]], counts[~dropped])]
        ids, ends = ids.tobytes(), np.cumsum(counts)
        cut = np.concatenate([[0], ends])[np.searchsorted(first, begins)] * ID_TYPE.itemsize
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def _learn(self, keys: np.ndarray, segments: list[str]) -> None:
        """Keeps the undropped agendas of new segments."""
        met: list[tuple[np.ndarray, np.ndarray]] = []
        every = np.arange(len(segments))
        ids, counts = self._cut(segments, every, np.zeros(len(segments), np.uint64), 0.0, met)
        ends = np.cumsum(counts)
        self._store.add(keys, [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())])
        rows = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in met]])
        found = np.concatenate([np.zeros(0, np.uint64), *[c for _, c in met]])[np.argsort(rows, kind="stable")]
        ends = np.cumsum(np.bincount(rows, minlength=len(segments)))
        begins = np.concatenate([[0], ends[:-1]])
        self._agendas.add(keys, [found[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())])

    def _touched(self, distinct: np.ndarray, which: np.ndarray, base: np.ndarray) -> np.ndarray:
        """At which occurrences a candidate of the undropped agenda is skipped."""
        at, n = self._agendas.take(distinct)
        wide = 8 // ID_TYPE.itemsize
        n = n // wide
        own = self._agendas.pool[_spread(at, n * wide)].view(np.uint64)
        begins = np.cumsum(n) - n
        counts = n[which]
        skip = _skips(np.repeat(base, counts), own[_spread(begins[which], counts)], self.rate)
        return np.bincount(np.repeat(np.arange(len(which)), counts)[skip], minlength=len(which)) > 0

    def _odd(self, buf: np.ndarray, begins: np.ndarray, gap: np.ndarray) -> np.ndarray:
        return irregular(buf, gap)

    def _chunks(self, buf: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, keys = words_and_lines(buf)
        opens = (first == 0) | (buf[np.maximum(first - 1, 0)] == 0x0B)  # a text begins as if after a space
        return first, np.where(opens, keys ^ SPACED, keys)

    def _strings(self, raw: bytes, starts: list[int]) -> list[str]:
        segments = []
        for at in starts:
            if raw[at] == 0x0A:
                segments.append("\n")
                continue
            spaced = " " if at == 0 or raw[at - 1] in (0x20, 0x0B) else ""
            segments.append(spaced + raw[at:CHUNK_END.search(raw, at).start()].decode("utf-8", "surrogatepass"))
        return segments

    def ids(self, text: str, salt: int = 0) -> bytes:
        """Ids of one text of any white space."""
        own = _SEGMENT.findall(" " + text) if text else []
        every = np.arange(len(own))
        return self._cut(own, every, _at(np.full(len(own), salt, dtype=np.uint64), every), self.rate)[0].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.raw[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")
        return text[1:] if text[:1] == " " else text


def _encode(path: str, seed: int, rate: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces.get(path, rate)
        for f in frames:
            salts = mix(f["key"].to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(_base(seed, 0)))
            for start, piece in chunks(f["text"].tolist(), PIECE_BYTES):
                out = f.iloc[start:start + len(piece)][["doc_id", "text_crc32"]].copy()
                out["ids"] = pieces.batch(piece, salts[start:start + len(piece)])
                yield out

    return run


def encode(documents: DataFrame, path: str, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """doc_id, text_crc32 (of the source's UTF-8) and ids (little-endian 16 bits)."""
    ship_package(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(F.lit(seed), "doc_id").alias("key"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.mapInPandas(_encode(path, seed, rate), "doc_id long, text_crc32 long, ids binary")


def _decode(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces.get(path)
        for f in frames:
            own = [np.frombuffer(i, ID_TYPE) for i in f["ids"]]
            yield pd.DataFrame({
                "doc_id": f["doc_id"], "text": [pieces.decode(i) for i in own],
                "n_tokens": [len(i) for i in own], "ids_crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in own],
                "text_crc32": f["text_crc32"]})

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text, n_tokens, ids_crc32 and the source's text_crc32."""
    ship_package(encoded.sparkSession)
    return encoded.mapInPandas(_decode(path), "doc_id long, text string, n_tokens long, ids_crc32 long, text_crc32 long")
