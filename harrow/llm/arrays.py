"""Vectorised numpy helpers over UTF-8 bytes, word hashes and Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
#: Bytes that separate words: 0x20 and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * _ODD)
_BYTE2 = mix(np.arange(1001, 1257, dtype=U64) * _ODD)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, U64(base), U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n (base is odd), kept for reuse."""
    if base not in _KEPT or len(_KEPT[base][0]) <= n:
        size = max(n, 1 << 16) * 5 // 4
        _KEPT[base] = (_powers(base, size), _powers(pow(base, -1, 1 << 64), size))
    up, down = _KEPT[base]
    return up[: n + 1], down[: n + 1]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, by prefix sums of values * base**i.

    It depends on the content and the length of a span, not on its place.
    """
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], dtype=U64, out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U64) * _ODD)


def windows_hash(values: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Hashes of all k consecutive values; empty if there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], dtype=U64, out=total[1:])
    return mix((total[k:] - total[:n]) * down[:n])


def byte_values(data: np.ndarray, second: bool = False) -> np.ndarray:
    return (_BYTE2 if second else _BYTE)[data]


def window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    n, span, m = len(h) - w + 1, 1, h
    if n <= 0:
        return h[:0]
    while 2 * span <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[w - span : w - span + n])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes that are not blanks."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~BLANK[data]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a newline after each, and the start of each text (and the end of all)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t or b"") + 1 for t in texts], out=at[1:])
    data = np.frombuffer(b"".join(x for t in texts for x in (t or b"", b"\n")), np.uint8)
    return data, at


def chunks(batch: pa.RecordBatch | pa.Table, text: str, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows of about ``most`` bytes of text: the first row's index and the texts as bytes (null: empty)."""
    column = batch.column(text)
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    first, held, size = 0, [], 0
    for i, value in enumerate(column):
        raw = value.as_py() or b""
        held.append(raw)
        size += len(raw)
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def sorted_groups(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values in a sorted array, and its length."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
