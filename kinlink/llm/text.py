"""Ragged numpy views of Arrow text columns, shared by the operators that read words or bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows are handled in slices of about so many bytes of text, whatever size Spark's batches have.
SLICE_BYTES = 8 << 20
#: Units hashed at a time, so that the work stays in a core's cache.
CHUNK = 1 << 17
ODD = 0x9E3779B97F4A7C15
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has about `most` bytes of text; a single longer text stays whole."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(size, dtype=np.int64) // most
        edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(size)]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch.slice(int(a), int(b - a))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with null as empty."""
    return pc.fill_null(batch.column(column), "")


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and the offsets of its rows in them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binaries(data: bytes | np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary array of the pieces of data between edges (in bytes)."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(data)])


def flat(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All values in a binary column, and how many each row has."""
    parts = [flat_bytes(c) for c in column.chunks]
    data = np.concatenate([np.zeros(0, np.uint8), *(d for d, _ in parts)])
    return data.view(dtype), np.concatenate([np.zeros(0, np.int64), *(np.diff(at) for _, at in parts)]) // np.dtype(dtype).itemsize


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs without ASCII white space, of all rows in turn, and each row's offsets into them."""
    data, at = flat_bytes(texts)
    inside = ~WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = at[:-1][at[:-1] < len(data)]
    first[begin] = inside[begin]  # words end with their row
    starts, before = np.flatnonzero(first), np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])
    offsets = np.concatenate([before[starts], before[-1:]]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(starts, at)


def spaced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words with a space after each, and where each starts in them."""
    data, ends = flat_bytes(words)
    out = np.full(len(data) + len(words), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(words)), np.diff(ends))] = data
    return out, ends + np.arange(len(words) + 1)


@lru_cache(maxsize=4)
def _series(n: int, factor: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, factor, np.uint64)]), dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64."""
    return _series(1 << max(18, n.bit_length()), ODD)[:n]


def inverses(n: int) -> np.ndarray:
    """What undoes the first n powers."""
    return _series(1 << max(18, n.bit_length()), pow(ODD, -1, 1 << 64))[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word that spaced() gave: a sum of powers times bytes."""
    count = len(starts) - 1
    out = np.zeros(count, np.uint64)
    for a in range(0, count, CHUNK):
        b = min(count, a + CHUNK)
        part, offset = text[starts[a] : starts[b]], starts[a:b] - starts[a]
        out[a:b] = mixed(np.add.reduceat((part.astype(np.uint64) + np.uint64(1)) * powers(len(part)), offset) * inverses(len(part))[offset])
    return out


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of equal values, and the distinct values."""
    d = values.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """For each element of a ragged array, its row."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def gather(values: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows `rows` of (values, starts), one after the other, and their offsets."""
    lengths = starts[rows + 1] - starts[rows]
    at = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.repeat(starts[rows] - at[:-1], lengths) + np.arange(at[-1])], at


def windows_coded(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes of the windows of `size` elements of a flat array (equal code: equal window), by doubling: exact, without hashes."""
    have, done = codes, 1
    while done < size:
        step = min(done, size - done)
        n = len(have) - step
        if n <= 0:
            return np.zeros(0, np.int64)
        have = np.unique(have[:n] * (int(have.max()) + 1) + have[step:], return_inverse=True)[1]
        done += step
    return have
