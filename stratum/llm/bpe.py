"""Ids of whole texts from the tokenizers library, each distinct word asked once.

Splitting, not merging, takes most of that library's time, so texts are cut here
at white space, where no token can span, and the ids of every distinct chunk come
from the library and are kept by a worker under the chunk's 64-bit hash. Chunks of
letters and closing marks go straight to the library's merge model, others through
its whole pipeline. Texts with irregular white space are cut one by one, the rest
a megabyte at a time. The ids equal those of the whole text (tests compare
them).
"""

from __future__ import annotations

import os
import re

import numpy as np

from stratum.llm.textnum import word_hashes, word_starts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

ID_TYPE = np.dtype("<u2")
MOST_KEPT = 1_500_000  # chunks a worker keeps (about 30 bytes each); then it starts anew
PIECE_BYTES = 1 << 20

# White_Space characters of Unicode, as the library's \s.
_WS = "\t-\r \x85\xa0  -     　"
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
_WORD_CHUNK = re.compile(f"[^{_WS}]+")
_BYTE_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
CHUNK_END = re.compile(rb"[\x20\x09-\x0d]")


def _byte_chars() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(spare)) for b in range(256))


_ALPHABET = _byte_chars()


class _Store:
    """Ids by the hash of a chunk: sorted keys beside one pool of ids."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, ID_TYPE), 0

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) > MOST_KEPT:
            self.__init__()
        slot = np.searchsorted(self.keys, keys)
        slot[slot == len(self.keys)] = 0
        return np.flatnonzero(self.keys[slot] != keys) if len(self.keys) else np.arange(len(keys))

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        """``keys`` ascending and not held yet."""
        n = np.array([len(i) // ID_TYPE.itemsize for i in ids], dtype=np.int64)
        new = np.frombuffer(b"".join(ids), dtype=ID_TYPE)
        while self.used + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(new)] = new
        place = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, place, self.used + np.cumsum(n) - n)
        self.n = np.insert(self.n, place, n)
        self.keys = np.insert(self.keys, place, keys)
        self.used += len(new)

    def take(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.searchsorted(self.keys, keys)
        return self.at[slot], self.n[slot]


def _odd_spaces(buf: np.ndarray) -> np.ndarray:
    """Where a control character that the library does not count as white space, or
    a white-space character beyond ASCII, may begin."""
    after = np.concatenate([buf[1:], [0]])
    return (((buf >= 0x1C) & (buf <= 0x1F)) | ((buf == 0xC2) & ((after == 0x85) | (after == 0xA0)))
            | ((buf == 0xE1) & (after == 0x9A)) | ((buf == 0xE2) & ((after == 0x80) | (after == 0x81)))
            | ((buf == 0xE3) & (after == 0x80)))


_LINE_KEY, _SPACED = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xA24BAED4963EE407)


def irregular(buf: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Where white space is not one space or line feed between two words. Texts are
    parted by 0x0B."""
    space = (buf == 0x20) | (buf == 0x0A)
    other = (buf >= 0x09) & (buf <= 0x0D) & ~space
    other[gap] = False
    edge = space | (buf == 0x0B)
    return other | (space & (np.concatenate([edge[1:], [True]]) | np.concatenate([[True], edge[:-1]])))


def words_and_lines(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of words and line feeds; words after a space have keys of
    their own."""
    words = word_starts(buf)
    keys = word_hashes(buf, words)
    before = np.where(words > 0, buf[np.maximum(words - 1, 0)], 0)
    keys = np.where(before == 0x20, keys ^ _SPACED, keys)
    lines = np.flatnonzero(buf == 0x0A)
    first = np.concatenate([words, lines])
    order = np.argsort(first, kind="stable")
    return first[order], np.concatenate([keys, np.full(len(lines), _LINE_KEY)])[order]


class ChunkEncoder:
    """Ids of whole texts from those of their distinct chunks."""

    GAP = b"\n"  # stands between texts in a buffer

    def __init__(self):
        self._store = _Store()

    def batch(self, piece: list[bytes], salts: np.ndarray | None = None) -> list[bytes]:
        """Ids of each text of ``piece`` (UTF-8 bytes). ``salts``: one key per text, if
        chunks have other ids under other keys."""
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
        salt = salts[np.searchsorted(begins, first, side="right") - 1]
        distinct, one, which = np.unique(keys ^ salt, return_index=True, return_inverse=True)
        absent = self._store.missing(distinct)
        if len(absent):
            self._store.add(distinct[absent], self._ask_all(buf.tobytes(), first[one[absent]].tolist(), salt[one[absent]]))
        at, n = self._store.take(distinct)
        n_each = n[which]
        ends = np.cumsum(n_each)
        source = np.repeat(at[which] - (ends - n_each), n_each) + np.arange(ends[-1])
        ids = self._store.pool[source].tobytes()
        cut = np.concatenate([[0], ends])[np.searchsorted(first, begins)] * ID_TYPE.itemsize
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]


class Encoder(ChunkEncoder):
    """Ids as little-endian unsigned 16-bit bytes (the vocabulary is smaller)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self._merge = self.library.model.tokenize
        self._marks: dict[str, bytes] = {"": b""}

    def _pack(self, ids) -> bytes:
        return np.array(ids, dtype=ID_TYPE).tobytes()

    def _of_letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_ALPHABET_MAP)
        elif word[0] == " ":
            word = _ALPHABET[32] + word[1:]
        return self._pack([t.id for t in self._merge(word)])

    def _closing(self, marks: str) -> bytes:
        if marks not in self._marks:
            if len(self._marks) > MOST_KEPT // 8:
                self._marks = {"": b""}
            self._marks[marks] = self._pack([t.id for t in self._merge(marks)])
        return self._marks[marks]

    def _whole(self, chunk: str) -> bytes:
        return self._pack(self.library.encode(chunk, add_special_tokens=False).ids)

    def _ask_all(self, raw: bytes, starts: list[int], salts: np.ndarray) -> list[bytes]:
        return [self._ask_at(raw, at) for at in starts]


_ALPHABET_MAP = {b: c for b, c in enumerate(_ALPHABET)}


class WordEncoder(Encoder):
    """For a vocabulary with word ends: lower case, white space dropped."""

    def _ask(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return self._whole(chunk)
        return self._of_letters(plain[1].lower()) + self._closing(plain[2])

    def _odd(self, buf: np.ndarray, begins: np.ndarray, gap: np.ndarray) -> np.ndarray:
        return _odd_spaces(buf)

    def _chunks(self, buf: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = word_starts(buf)
        return first, word_hashes(buf, first)

    def _ask_at(self, raw: bytes, at: int) -> bytes:
        return self._ask(raw[at:CHUNK_END.search(raw, at).start()].decode("utf-8", "surrogatepass"))

    def ids(self, text: str, salt: int = 0) -> bytes:
        return b"".join(map(self._ask, _WORD_CHUNK.findall(text)))


class ByteEncoder(Encoder):
    """For a byte-level vocabulary: a space belongs to the word after it. Regular
    texts have single spaces and line feeds between words and none at the ends."""

    GAP = b"\x0b"

    def _ask(self, space: str, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain is None:
            return self._whole(space + chunk)
        return self._of_letters(space + plain[1]) + self._closing(plain[2])

    def _odd(self, buf: np.ndarray, begins: np.ndarray, gap: np.ndarray) -> np.ndarray:
        return irregular(buf, gap) | _odd_spaces(buf)

    def _chunks(self, buf: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return words_and_lines(buf)

    def _ask_at(self, raw: bytes, at: int) -> bytes:
        if raw[at] == 0x0A:
            return self._whole("\n")
        chunk = raw[at:CHUNK_END.search(raw, at).start()].decode("utf-8", "surrogatepass")
        return self._ask(" " if at and raw[at - 1] == 0x20 else "", chunk)

    def ids(self, text: str, salt: int = 0) -> bytes:
        return b"".join([self._ask(" ", c[1:]) if c[0] == " " and len(c) > 1 and not c.isspace() else self._whole(c)
                         for c in _BYTE_CHUNK.findall(text)])


_OPEN: dict[tuple[type, str], Encoder] = {}


def encoder(kind: type[Encoder], path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]
