"""Words of Arrow text columns and their hashes, computed on the UTF-8 bytes of whole slices of rows.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return; these six are
single bytes in UTF-8, so splitting bytes splits characters. All functions take a slice of rows as one buffer with row
offsets, as Arrow stores it, and run without a loop over rows. Memory follows the slice, which holds SLICE_BYTES of
text or one longer text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
BLOCK_BYTES = 256 << 10
LONG_WORD = 64 << 10

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multiplier of the rolling hashes, one random value per byte, powers of the multiplier and of its inverse.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = np.random.default_rng(20240131).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    values = np.full(n, base, dtype=np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


_POWER = _powers(_BASE, BLOCK_BYTES + LONG_WORD)
_INVERSE = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), BLOCK_BYTES + LONG_WORD)


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values; every salt gives another hash."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string column; NULL is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * width).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts have together at most `limit` bytes, or a single row."""
    _, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Start and end of every word, and per row the number of words before it (one more than rows).

    `space` marks the bytes between words where the default of six is not wanted.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~(SPACE[data] if space is None else space)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; spans ascend and do not overlap. fold: ASCII letters as lower case."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _BYTES[LOWER] if fold else _BYTES
    at = 0
    while at < len(starts):
        origin = int(starts[at])
        if ends[at] - origin > LONG_WORD:
            word = data[origin: int(ends[at])]
            word = LOWER[word] if fold else word
            out[at] = int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(ends, origin + BLOCK_BYTES, side="right")))
        if np.any(ends[at:end] - starts[at:end] > LONG_WORD):
            end = at + int(np.argmax(ends[at:end] - starts[at:end] > LONG_WORD))
        n = int(ends[end - 1]) - origin
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[data[origin: origin + n]] * _POWER[:n], out=sums[1:])
        a, b = starts[at:end] - origin, ends[at:end] - origin
        out[at:end] = mix((sums[b] - sums[a]) * _INVERSE[a])
        at = end
    return out


def window_hashes(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every n consecutive values, by doubling: a window of 2k is the window of k beside the next one of k.

    A plain loop: a function that calls itself would keep the arrays of every call until the garbage collector comes.
    """
    single = mix(hashes, salt) if salt else hashes
    step = _STEP + np.uint64(2 * salt)
    value, power, k = single, step, 1
    with np.errstate(over="ignore"):
        for bit in bin(n)[3:]:
            m = max(0, len(hashes) - 2 * k + 1)
            value, power, k = value[:m] * power + value[k: k + m], power * power, 2 * k
            if bit == "1":
                m = max(0, len(hashes) - k)
                value, power, k = value[:m] * step + single[k: k + m], power * step, k + 1
    return mix(value)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, n: int) -> np.ndarray:
    """Whether n words from each position on lie in one row; one entry per window of the slice."""
    total = int(first[-1])
    m = max(0, total - n + 1)
    if not m:
        return np.zeros(0, dtype=bool)
    return np.arange(m) + n <= first[1:][rows_of(first)[:m]]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
