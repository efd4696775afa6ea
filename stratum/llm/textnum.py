"""Words of many texts as numpy hashes, computed over one byte buffer.

A word is a run of characters other than ``\\x20 \\x09-\\x0D`` (bytes in UTF-8). Its
hash is a polynomial over per-byte random values, taken for all words of the
buffer at once, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_VALUE[_SPACE] = 0
_SALT = mix(np.arange(1, SHINGLE + 2, dtype=np.uint64) * _GOLDEN + np.uint64(7)) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for k, base in enumerate((_BASE, _UNBASE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1]


def chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as bytes) in pieces of about ``limit`` bytes;
    null is the empty text, a longer text is a piece of its own."""
    start, size, piece = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if piece and size + len(b) > limit:
            yield start, piece
            start, size, piece = i, 0, []
        piece.append(b)
        size += len(b) + 1
    if piece:
        yield start, piece


def word_starts(buf: np.ndarray) -> np.ndarray:
    """Positions at which a word begins."""
    space = _SPACE[buf]
    return np.flatnonzero(~space & np.concatenate(([True], space[:-1])))


def word_hashes(buf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the word at each of the positions (all of the buffer's words)."""
    if not len(first):
        return np.zeros(0, np.uint64)
    power, unpower = _power(len(buf))
    return mix(np.add.reduceat(_VALUE[buf] * power, first) * unpower[first])


def words(piece: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word of the texts, in order."""
    buf = np.frombuffer(b"\n".join(piece) + b"\n", dtype=np.uint8)
    first = word_starts(buf)
    begins = np.cumsum([0] + [len(b) + 1 for b in piece[:-1]])
    return word_hashes(buf, first), np.searchsorted(begins, first, side="right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of SHINGLE words; a text of fewer words has
    one shingle of all its words, a text without words has none."""
    full = np.zeros(0, np.int64)
    if len(h) >= SHINGLE:
        full = np.flatnonzero(doc[: len(h) - SHINGLE + 1] == doc[SHINGLE - 1:])
    s = np.zeros(len(full), np.uint64)
    for k in range(SHINGLE):
        s += h[full + k] * _SALT[k]
    count = np.bincount(doc, minlength=n)
    begin = np.cumsum(count) - count
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    t = count[few].astype(np.uint64) * _SALT[SHINGLE]
    for k in range(SHINGLE - 1):
        has = count[few] > k
        t[has] += h[begin[few[has]] + k] * _SALT[k]
    s, d = np.concatenate([s, t]), np.concatenate([doc[full], few])
    return mix(s), d


def weighted_shingles(piece: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash, occurrences), sorted by text then hash. The hash keeps
    44 bits beside the text's index: within one text those tell shingles apart."""
    h, doc = words(piece)
    s, d = shingles(h, doc, len(piece))
    key, count = np.unique((d.astype(np.uint64) << np.uint64(44)) | (s >> np.uint64(20)), return_counts=True)
    return (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), count


class Letters:
    """Per code point: is it a letter, an upper-case letter, a digit, white space; its
    one-character lower case; a random value. Built once a worker."""

    _one: Letters | None = None

    def __init__(self):
        n, step = 0x110000, 1 << 12
        self.letter, self.upper, self.digit, self.space = (np.zeros(n, dtype=bool) for _ in range(4))
        self.lower = np.arange(n, dtype=np.uint32)
        for at in range(0, n, step):
            chars = [chr(c) for c in range(at, at + step)]
            here = slice(at, at + step)
            self.letter[here] = [c.isalpha() for c in chars]
            self.upper[here] = [c.isupper() for c in chars]
            self.digit[here] = [c.isdigit() for c in chars]
            self.space[here] = [c.isspace() for c in chars]
            self.lower[here] = [ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars]
        self.value = mix((np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)

    @classmethod
    def get(cls) -> Letters:
        if cls._one is None:
            cls._one = cls()
        return cls._one


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of the texts, each followed by a line feed; where each begins, and
    the end)."""
    own = [t or "" for t in texts]
    begins = np.cumsum([0] + [len(t) + 1 for t in own])
    return np.frombuffer("".join(t + "\n" for t in own).encode("utf-32-le", "surrogatepass"), dtype="<u4"), begins


def text_batches(texts: list[str | None], limit: int) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) in batches of about ``limit`` characters;
    null is the empty text, a longer text is a batch of its own."""
    start, size, batch = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if batch and size + len(t) > limit:
            yield start, batch
            start, size, batch = i, 0, []
        batch.append(t)
        size += len(t) + 1
    if batch:
        yield start, batch
