"""Bytes, words and hashes of Arrow text columns, as whole-array numpy work.

A text column is used as its UTF-8 buffer and offsets; no Python string is made per row.
Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which cannot be part of a
longer UTF-8 sequence. Hashes are polynomials modulo 2^64 over short pieces, taken from one
running sum per slice and finished with a mixing step, so equal byte strings have equal hashes
wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
PIECE = 256
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SAME = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER = _SAME.copy()
_LOWER[65:91] += np.uint64(32)
_powers: dict[str, np.ndarray] = {}


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        out = np.full(size, _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if size <= SLICE_BYTES * 2:
            _powers[kind] = have
    return have[:n]


def forget_tables() -> None:
    """Drop the powers that hashing keeps; they are made again when needed."""
    _powers.clear()


def running(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of ``data``."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((_LOWER if lower else _SAME)[data] * _power("up", len(data)), out=out[1:])
    return out


def _short_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power("down", len(sums))[start] + (end - start).astype(np.uint64))


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span. A polynomial modulo 2^64 has colliding texts of regular structure from
    1,024 bytes on, so longer spans are sums over pieces of ``PIECE`` bytes, each hashed and mixed
    on its own and weighted by a mixed, not a geometric, number of its place."""
    out = _short_hash(sums, start, end)
    long = np.flatnonzero(end - start > PIECE)
    if len(long):
        a, b = start[long].astype(np.int64), end[long].astype(np.int64)
        n = -(-(b - a) // PIECE)
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        lo = np.repeat(a, n) + place * PIECE
        weight = mix(place.astype(np.uint64) + _BASE) | np.uint64(1)
        parts = _short_hash(sums, lo, np.minimum(lo + PIECE, np.repeat(b, n))) * weight
        out[long] = mix(np.add.reduceat(parts, first) + (b - a).astype(np.uint64))
    return out


def window_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every span of ``width`` bytes."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[width:] - sums[:n]) * _power("down", n) + np.uint64(width))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, rows' first words) of the words of consecutive texts; ``offsets`` from 0."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]  # a text's first byte never goes on with the text before
    last[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(hashes, starts, ends, rows' first words)."""
    start, end, rows = word_spans(data, offsets)
    return span_hash(running(data, lower), start, end), start, end, rows


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; of the whole sequence where it is shorter."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out = out * _BASE + words[j : n - k + 1 + j]
    return mix(out + np.uint64(k))
