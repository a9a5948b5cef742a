"""Word and shingle hashing over Arrow text columns, one numpy pass per few hundred kilobytes of text.

The functions work on the UTF-8 bytes of many documents at once.  Separators are ASCII bytes, so words never
depend on how a batch was cut.  Hashes are 64-bit and depend on the words alone, not on place, batch or process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass takes; its work arrays hold about 200 bytes for each of them.
CHUNK_BYTES = 1 << 18

_RNG = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_ROOT = 0x9E3779B97F4A7C15
_INVERSE = pow(_ROOT, -1, 2**64)
_MULTIPLIERS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes outside ``[\x20\x09-\x0D]``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that sums and powers turn into even hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for k, root in enumerate((_ROOT, _INVERSE)):
            out = np.full(size, root, np.uint64)
            out[0] = 1
            _POWERS[k] = np.multiply.accumulate(out)
    return _POWERS[0][:n + 1], _POWERS[1][:n + 1]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole documents of about `limit` bytes: first, last + 1, bytes, offsets.

    Null texts count as empty.  A document longer than the limit makes a chunk of its own.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def segments(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of one non-zero kind inside a document: document index, start, end (exclusive)."""
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    k = kind[data]
    begins = np.empty(n, bool)
    begins[0] = True
    np.not_equal(k[1:], k[:-1], out=begins[1:])
    edges = offsets[:-1]
    begins[edges[edges < n]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], n)
    keep = k[starts] != 0
    starts, ends = starts[keep], ends[keep]
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One hash per byte span; with `lower`, A-Z count as a-z."""
    powers, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers[:-1], out=sums[1:])
    body = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(body + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of every word ``[^\x20\x09-\x0D]+``, in order."""
    docs, starts, ends = segments(data, offsets, NOT_SPACE.view(np.uint8))
    return docs, span_hashes(data, starts, ends, lower)


def word_counts(docs: np.ndarray, n_docs: int) -> np.ndarray:
    return np.bincount(docs, minlength=n_docs)


def shingles(docs: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words inside a document: index of its first word, hash."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.full(n, np.uint64(size))
    for i in range(size):
        total += words[i:i + n] * _MULTIPLIERS[i]
    at = np.flatnonzero(docs[:n] == docs[size - 1:])
    return at, mix(total[at])


def short_shingles(docs: np.ndarray, words: np.ndarray, size: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For documents of 1 to size - 1 words, the hash of the whole sequence: document index, hash."""
    counts = word_counts(docs, n_docs)
    firsts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    total = counts[short].astype(np.uint64)
    for i in range(size - 1):
        has = counts[short] > i
        total[has] += words[firsts[short][has] + i] * _MULTIPLIERS[i]
    return short, mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
