"""Vectorised text kernels over Arrow string buffers, shared by the Arrow-batch stages.

A *word* is a maximal run of bytes that are ASCII letters, digits or >= 0x80
(so any non-ASCII letter); ASCII is lower-cased. By this rule, which the SQL has
too, a text without ASCII borders is one word; with ``scripts`` every character of
a script written without spaces is its own word, and Unicode punctuation and
spaces are borders. Words carry 64-bit hashes, so
whole batches are compared without building Python strings.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_IS_WORD = np.zeros(256, bool)
for _b in [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]:
    _IS_WORD[_b] = True
for _b in range(65, 91):
    _VALUES[_b] = _VALUES[_b + 32]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: A batch is cut at document borders into chunks of about this many bytes.
CHUNK_BYTES = 1 << 21
#: Words are found in pieces of so many bytes.
PIECE_BYTES = 1 << 20
_tables = [np.ones(1, U), np.ones(1, U)]
#: Blocks of scripts written without spaces: Thai, Lao, Myanmar, Khmer, Tai, Balinese, Javanese, Han, kana, bopomofo, Yi.
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFD)]
_BORDER, _ALONE = 1, 2
_kinds: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse, modulo 2**64."""
    if len(_tables[0]) < n:
        n = max(n, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            t = np.full(n, base, U)
            t[0] = 1
            _tables[k] = np.multiply.accumulate(t)
    return _tables


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if off is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(raw: np.ndarray, offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows, about ``most`` bytes each; a longer row stands alone, whole."""
    k, n = 0, len(offsets) - 1
    while k < n:
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + most, "right")) - 1)
        end = min(end, n)
        yield k, raw[offsets[k] : offsets[end]], offsets[k : end + 1] - offsets[k]
        k = end


def _kind() -> np.ndarray:
    """_BORDER, _ALONE or 0 of every code point, made once a worker."""
    if not _kinds:
        kind = np.zeros(0x110000, np.uint8)
        for a, b in _UNSPACED:
            kind[a : b + 1] = _ALONE
        borders = [c for c in range(128, 0x110000) if unicodedata.category(chr(c))[0] in "PZ" or chr(c).isspace()]
        kind[[*borders, 0x200B]] = _BORDER
        _kinds.append(kind)
    return _kinds[0]


def _by_script(raw: np.ndarray, word: np.ndarray, edge: np.ndarray) -> None:
    """Enters borders and characters that are words by themselves into ``Words``' marks (one place later than the bytes)."""
    at = np.flatnonzero((raw >= 0xC6) | (raw == 0xC2))  # U+00C0 to U+017F are letters
    if not len(at):
        return
    b = [np.r_[raw, np.zeros(3, np.uint8)][at + k].astype(np.int64) for k in range(4)]
    two, three, four = (b[0] & 31) << 6 | b[1] & 63, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63, (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63
    kind = _kind()[np.minimum(np.where(b[0] < 0xE0, two, np.where(b[0] < 0xF0, three, four)), 0x10FFFF)]
    size = 2 + (b[0] >= 0xE0) + (b[0] >= 0xF0)
    for k in range(4):
        word[at[(kind == _BORDER) & (size > k)] + k + 1] = False
    alone = kind == _ALONE
    edge[at[alone] + 1] = True
    edge[np.minimum(at[alone] + size[alone], len(raw)) + 1] = True


class Words:
    """Words of a chunk: hash, first byte, end byte and row of each; ``first[r]:first[r + 1]`` are row r's words. ``scripts``: see above.

    Bytes are gone through in pieces, so that a long row needs memory for its words
    alone; a word that a piece's end cuts is put together again.
    """

    __slots__ = ("hash", "start", "end", "row", "first")

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, scripts: bool = False):
        n = len(raw)
        place = np.int32 if n < 2**31 else np.int64
        sums: list[np.ndarray] = []
        starts: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        a, goes_on = 0, False
        while a < n:
            b = min(a + PIECE_BYTES, n)
            for _ in range(3):  # not within a character
                if b < n and raw[b] & 0xC0 == 0x80:
                    b -= 1
            piece = raw[a:b]
            m = b - a
            edge = np.zeros(m + 2, bool)
            word = np.zeros(m + 2, bool)
            word[1:-1] = _IS_WORD[piece]
            edge[offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a + 1] = True
            if scripts:
                _by_script(piece, word, edge)
            before = word[:-1] & ~edge[1:]  # the byte before, within the same row
            start = np.flatnonzero(word[1:-1] & ~before[:-1])
            after = word[1:] & ~edge[1:]
            end = np.flatnonzero(word[1:-1] & ~after[1:]) + 1
            power, inverse = _powers(m + 1)
            total = np.zeros(m + 1, U)
            np.cumsum(_VALUES[piece] * power[:m], out=total[1:])
            value = (total[end] - total[start]) * inverse[start]
            if goes_on and len(start) and start[0] == 0 and not edge[1]:
                done = int(ends[-1][-1]) - int(starts[-1][-1])
                sums[-1][-1:] += value[:1] * np.array([pow(_BASE, done, 2**64)], U)
                ends[-1][-1] = a + end[0]
                start, end, value = start[1:], end[1:], value[1:]
            if len(start):
                sums.append(value)
                starts.append((start + a).astype(place))
                ends.append((end + a).astype(place))
            goes_on = bool(ends) and ends[-1][-1] == b and not edge[m + 1]
            a = b
        join = lambda parts, kind: parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, kind)
        self.start, self.end = join(starts, place), join(ends, place)
        self.hash = mix(join(sums, U))
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(self.first))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) of the n words from each word on; not valid where they leave the row."""
    h = words.hash
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, bool)
    have, out, done, span = h, None, 0, 1
    left = n
    while left:
        if left & 1:
            part = have[done : done + m]
            out = part if out is None else mix(out * U(0xD6E8FEB86659FD93) + part)
            done += span
        left >>= 1
        if left:
            have = mix(have[:-span] * U(0xA0761D6478BD642F) + have[span:])
            span *= 2
    return out, words.row[:m] == words.row[n - 1 :]
