"""Words of UTF-8 texts as arrays: where each lies, and a 64-bit hash of its bytes.

A word is a run of bytes other than space and 0x09 to 0x0D. The texts of an Arrow column lie end to
end in one buffer; everything here works on such a buffer and the offsets of its texts, so that no
Python object is made per word. Work space is bounded by ``BLOCK``, whatever a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
# Bytes of text handled at once; a longer text is handled alone.
SLICE = 4 << 20
_MASK = (1 << 64) - 1

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_rng = np.random.default_rng(977)
_EXACT = _rng.integers(1, _MASK, 256, dtype=np.uint64)
_FOLDED = _EXACT.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, BLOCK), _powers(_BACK, BLOCK)


def spread(x: np.ndarray) -> np.ndarray:
    """Mix the bits of each value, one to one."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two hashes in order."""
    return spread(a * np.uint64(0xA0761D6478BD642F) + b)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``; starts and ends ascend. ``fold`` takes A-Z as a-z.

    A polynomial over the bytes' random values: differences of running sums, moved to position 0.
    """
    table = _FOLDED if fold else _EXACT
    before, after = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    carry, scale, step = 0, 1, pow(_BASE, BLOCK, 1 << 64)
    for at in range(0, len(data), BLOCK):
        sums = table[data[at : at + BLOCK]]
        sums *= _UP[: len(sums)]
        np.cumsum(sums, out=sums)
        for where, into in ((starts, before), (ends, after)):
            i, j = np.searchsorted(where, (at + 1, at + len(sums) + 1))
            into[i:j] = sums[where[i:j] - (at + 1)] * np.uint64(scale) + np.uint64(carry)
        carry = (carry + scale * int(sums[-1])) & _MASK
        scale = scale * step & _MASK
    blocks = _powers(pow(_BACK, BLOCK, 1 << 64), len(data) // BLOCK + 1)
    after -= before
    after *= _DOWN[starts % BLOCK]
    after *= blocks[starts // BLOCK]
    after += (ends - starts).astype(np.uint64)
    return spread(after)


@dataclass
class Words:
    """``starts`` and ``ends`` in the buffer; ``first[d]:first[d + 1]`` are the words of text ``d``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = IS_WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    begin, end = offsets[offsets < len(data)], offsets[offsets > 0] - 1
    opens[begin] = inside[begin]
    closes[end] = inside[end]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` words in a row of one text, with the index of their first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n]
    for i in range(1, width):
        out = joined(out, hashes[i : i + n])
    whole = np.ones(n, bool)
    for i in range(1, width):
        cut = first[1:-1] - i
        whole[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(whole)
    return out[at], at


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of consecutive rows of up to ``limit`` bytes; null counts as empty."""
    done = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if chunk.null_count:
            chunk = chunk.fill_null("")
        chunk = chunk.cast(pa.large_string())
        _, where, raw = chunk.buffers()
        if not len(chunk):
            continue
        offsets = np.frombuffer(where, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(chunk):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
            yield done + lo, done + hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi
        done += len(chunk)
