"""Words of whole texts as arrays: one pass of array operations over the bytes of an Arrow batch.

A word is a run of bytes other than space and 09-0D; UTF-8 bytes of other characters are never separators.
A-Z count as a-z. A word is known by a 64-bit hash: the sum of a random number per byte value times a random odd
number per place in the word, mixed with the word's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of an Arrow batch are worked on in pieces of about this many bytes (one text at least).
CHUNK_BYTES = 4 << 20


_TABLES: list = []  # made once in a worker


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is a separator, number of a byte with A-Z as a-z, number of a place)."""
    if not _TABLES:
        _TABLES.append(_tables())
    return _TABLES[0]


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    sep = np.zeros(256, bool)
    sep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    value = draw.integers(1, 2**63, 256, dtype=np.uint64)
    value[0x41:0x5B] = value[0x61:0x7B]
    return sep, value, draw.integers(1, 2**63, 1 << 16, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(batch: pa.RecordBatch, column: str, limit: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of a text column; null is empty; offsets start at 0."""
    arr = batch.column(batch.schema.get_field_index(column))
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    offsets = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64) \
        if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first, limit = 0, limit or CHUNK_BYTES
    while first < len(arr):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text and after the last); ``sep``: per byte, no word goes on there."""
    n = len(data)
    word = ~sep
    opens, closes = np.empty(n, bool), np.empty(n, bool)
    opens[:1], closes[-1:] = True, True
    opens[1:], closes[:-1] = sep[:-1], sep[1:]
    opens[offsets[:-1][offsets[:-1] < n]] = True
    closes[offsets[1:][offsets[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(word & opens), np.flatnonzero(word & closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte spans; ``value``: a number per byte (by default A-Z have those of a-z)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    _, folded, place = tables()
    value = folded if value is None else value
    lens = ends - starts
    at = np.cumsum(lens) - lens
    inner = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    terms = value[data[np.repeat(starts, lens) + inner]] * place[inner & 0xFFFF]
    return mixed(np.add.reduceat(terms, at) + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each text and after the last)."""
    starts, ends, before = word_spans(data, offsets, tables()[0][data])
    return span_hashes(data, starts, ends), before


def shingle_sets(hashes: np.ndarray, before: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-word shingle hashes, text after text; shingles before each text and after the last).

    A text of fewer words has its whole sequence as its one shingle; a text without words has none."""
    counts = np.diff(before)
    draw = np.random.default_rng(5)
    odd = draw.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
    grams = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        grams += hashes[k:k + len(grams)] * odd[k]
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(at[-1]), np.uint64)
    full = np.flatnonzero(counts >= n)
    lens = sizes[full]
    shift = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(at[full], lens) + shift] = grams[np.repeat(before[full], lens) + shift]
    few = draw.integers(1, 2**63, n, dtype=np.uint64)  # by the number of words
    for k in np.flatnonzero((counts > 0) & (counts < n)):
        part = hashes[before[k]:before[k + 1]]
        out[at[k]] = np.append(part * odd[:len(part)], few[len(part)]).sum(dtype=np.uint64)
    out = mixed(out)
    for k in range(len(counts)):
        if sizes[k] > 1:
            out[at[k]:at[k + 1]].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][at[:-1] < len(out)]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], total[at]


def set_hashes(items: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set of hashes; 0 for an empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(items ^ np.uint64(0xA0761D6478BD642F)))])
    sizes = np.diff(before).astype(np.uint64)
    found = mixed((sums[before[1:]] - sums[before[:-1]]) ^ (sizes * np.uint64(0xE7037ED1A0B428DB)))
    return np.where(sizes == 0, np.uint64(0), found)
