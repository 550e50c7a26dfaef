"""Array code over the bytes of many texts at once; no Python loop runs per word or character."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = 32
U = np.uint64


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers, the same in every process."""
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * U(2) + U(1)


BYTE = constants(256, 11)
P = constants(1, 12)[0]
P_INV = U(pow(int(P), -1, 2**64))
LENGTH = constants(1, 13)[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection)."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of about ``most`` text bytes (one longer text: a piece of its own)."""
    _, off = column_bytes(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(off, off[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def word_spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of many texts: mapped bytes, starts, ends, and each text's first word (n + 1 numbers).

    ``table`` maps a byte to what it counts as; those mapped to a space part words.
    """
    flat = table[data]
    inside = flat != SPACE
    edge = np.zeros(len(flat) + 1, bool)
    edge[off] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return flat, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(BYTE[flat] * powers(P, len(flat)), out=sums[1:])
    back = powers(P_INV, len(flat))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * LENGTH)


def grams(h: np.ndarray, k: int, seed: int = 21) -> np.ndarray:
    """A hash of each k consecutive hashes."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    c = constants(k, seed)
    out = h[: len(h) - k + 1] * c[0]
    for j in range(1, k):
        out += h[j : len(h) - k + 1 + j] * c[j]
    return mix(out)


def lower_table(word: bytes | None = None, gap: bytes | None = None) -> np.ndarray:
    """A table for word_spans that lower-cases A-Z; all but ``word``, or only ``gap``, are spaces."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    if gap is not None:
        t[list(gap)] = SPACE
    if word is not None:
        keep = np.zeros(256, bool)
        keep[list(word)] = True
        t[~keep] = SPACE
    return t


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if total else np.zeros(0, np.int64)
    return first + np.arange(total)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0
