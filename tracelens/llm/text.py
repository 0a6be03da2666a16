"""Words of many texts at once, as arrays over one byte buffer.

A text is handled as its UTF-8 bytes.  The separators of all operators here are
ASCII bytes, which never occur inside a multi-byte character, so splitting bytes
and splitting characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once inside a task; one longer text is handled alone.
BLOCK_BYTES = 1 << 21

U = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def space_words() -> np.ndarray:
    r"""Byte table: true where a byte belongs to a word of ``[^\x20\x09-\x0D]+``."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def lower_ascii() -> np.ndarray:
    """Byte table that maps A-Z to a-z and keeps every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def blocks(column: pa.Array, target: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of rows of about ``target`` bytes.

    A null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + target, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (one more at the end)."""
    if not len(buf):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = is_word[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(buf))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that every bit depends on all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Tables(dict):
    """Tables that every process makes for itself: functions are shipped without them."""

    def __reduce__(self):
        return _Tables, ()


_powers: dict[str, np.ndarray] = _Tables()


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` from 0 to ``n`` - 1 at least; tables for blocks are kept, longer ones are not."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * BLOCK_BYTES:
            _powers[str(base)] = have
    return have


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + U(1)) * _power_table(_BASE, len(buf))[:len(buf)], out=sums[1:])
    inverse = _power_table(_BASE_INVERSE, len(buf))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def hash_grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= U(0xD1342543DE82EF95)
        out += h[j:j + n]
    return mix(out)


def inside_mask(first: np.ndarray, k: int) -> np.ndarray:
    """For each word: does a run of ``k`` words that starts here stay inside its text?"""
    n = int(first[-1])
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return room >= k
