"""Vectorised word and n-gram hashes over Arrow text columns.

A word is ``[^\\x20\\x09-\\x0D]+``. Its hash is a polynomial over random byte values modulo
2**64, taken from one prefix sum per block of bytes, and then mixed; no Python object is made
per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLOCK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER, _INVERSE = _powers(_BASE, _BLOCK), _powers(_BASE_INVERSE, _BLOCK)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word; changes ``h`` in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the n + 1 offsets; null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and per text the offset of its first word."""
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]  # a word ends with its text
    first[cuts] |= inside[cuts + 1]
    last[cuts - 1] |= inside[cuts]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hash of each span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTE[_LOWER] if lower else _BYTE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK - 1, "right")))
        low, high = starts[i], ends[j - 1]
        n = int(high - low)
        power, inverse = (_POWER, _INVERSE) if n < _BLOCK else (_powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1))
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[raw[low:high]] * power[:n], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * inverse[starts[i:j] - low]
        i = j
    return mix(out)


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and per text the offset of its first one."""
    raw, offsets = text_bytes(texts)
    starts, ends, words = word_spans(raw, offsets)
    return span_hashes(raw, starts, ends, lower), words


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]``; 0 where that is empty."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full])
    return out


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def pieces(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``most_bytes``, single rows apart that are larger."""
    if batch.num_rows > 1 and batch.nbytes > most_bytes:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), most_bytes)
        yield from pieces(batch.slice(half), most_bytes)
    elif batch.num_rows:
        yield batch
