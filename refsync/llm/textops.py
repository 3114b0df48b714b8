"""Words and word shingles of whole Arrow text columns as 64-bit hashes, with numpy.

A column is worked through in slices of whole texts of about `SLICE_BYTES` (the numpy arrays of a slice take some 50 times
its bytes; where nothing hangs on the slice, `SMALL_SLICE_BYTES`), so memory is bounded by a slice or by the longest single text. Two different words or shingles have the same hash with a chance of about 2^-64 per pair; the
operators that compare hashes say so.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
SMALL_SLICE_BYTES = 1 << 18
_SEED = 20240229


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values: each input bit changes every output bit with a chance of a half."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _random(n: int, salt: int) -> np.ndarray:
    return np.random.default_rng([_SEED, salt]).integers(0, 2**64, n, dtype=np.uint64, endpoint=False)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BYTE = _random(256, 1)[_FOLD]  # A-Z count as a-z
_BYTE[_BLANK] = 0
_STEP = _random(64, 2) | np.uint64(1)
_BASE = np.uint64(int(_random(1, 3)[0]) | 5)
_powers = np.ones(1, np.uint64)


def _powers_of_base(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * _powers[-1] * _BASE])
    return _powers


class Words(NamedTuple):
    """Words of a slice of texts: `hashes[offsets[i]:offsets[i + 1]]` are those of text i."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray  # byte where each word begins, counted from the slice's first byte
    ends: np.ndarray
    bytes: np.ndarray
    text_offsets: np.ndarray


def text_buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with at most `limit` bytes each, or one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of the texts between the offsets, A-Z lower-cased."""
    origin = offsets[0]
    data, offsets = data[origin : offsets[-1]], offsets - origin
    n = len(data)
    if n == 0:
        nothing = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), nothing, nothing, data, offsets)
    filled = ~_BLANK[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    begins = filled.copy()
    begins[1:] &= ~filled[:-1] | edge[1:n]
    stops = np.zeros(n, bool)
    stops[:-1] = filled[:-1] & (~filled[1:] | edge[1:n])
    stops[-1] = filled[-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if not len(starts):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts, ends, data, offsets)
    length = ends - starts
    place = np.zeros(n, np.int64)
    place[starts[0] :] = np.arange(n - starts[0]) - np.repeat(starts - starts[0], np.diff(np.append(starts, n)))
    place[~filled] = 0
    value = _BYTE[data] * _powers_of_base(int(length.max()))[place]
    hashes = mix(np.add.reduceat(value, starts) + length.astype(np.uint64) * _STEP[0])
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data, offsets)


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `k` words of each text, in order; a text with fewer words gives its whole sequence.

    Returns (hashes, offsets by text). Texts without words give nothing.
    """
    n = len(hashes)
    counts = np.diff(offsets)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    runs = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if len(runs) else 0):
        runs += mix(hashes[j : j + len(runs)] + _STEP[j + 1]) * _STEP[j + 1]
    inside = np.maximum(counts - k + 1, 0)
    short = (counts > 0) & (counts < k)
    sizes = inside + short
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    # positions of the runs that lie inside one text
    first = np.repeat(offsets[:-1], sizes) + np.arange(out_offsets[-1]) - np.repeat(out_offsets[:-1], sizes)
    out = np.zeros(len(first), np.uint64)
    is_short = np.repeat(short, sizes)
    out[~is_short] = runs[first[~is_short]]
    for i in np.flatnonzero(short):
        own = hashes[offsets[i] : offsets[i + 1]]
        steps = _STEP[1 : len(own) + 1]
        out[out_offsets[i]] = (mix(own + steps) * steps).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), out_offsets


def distinct(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def sum_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's values (wrapping for unsigned integers)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[offsets[1:]] - total[offsets[:-1]]
