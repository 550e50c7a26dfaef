"""Canonical length-limited Huffman codes: lengths by package-merge, packing and table decoding."""

from __future__ import annotations

import numpy as np

from weftline.llm.textcode import U

#: The longest code. 2 ** LIMIT table entries decode any code in one look-up.
LIMIT = 18
#: Ids between two bit-offset checkpoints; decoding may start at each.
STEP = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The length of each id's code (0: an id without occurrences), optimal under the limit."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if n <= 1:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.float64)
    merged, single = weight, [np.ones(n, bool)]  # of each round's list: which are ids by themselves
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        single.append(order < n)
        merged = both[order]
    # the least 2n - 2 of the last list are taken, then what their packages were made of, and so on
    take = 2 * n - 2
    lengths = np.zeros(n, np.int64)
    for of in reversed(single):
        ids = int(of[:take].sum())
        lengths[:ids] += 1
        take = 2 * (take - ids)
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The canonical codes: by length, then by id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        size = lengths[order].astype(np.int64)
        step = np.left_shift(np.int64(1), 62 - size)  # codes are read as fractions of 2 ** 62
        codes[order] = ((np.cumsum(step) - step) >> (62 - size)).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of ids, in big-endian 64-bit words, and the bit offset of every STEP-th id."""
    size, code = lengths[ids], codes[ids]
    if len(ids) and not size.all():
        raise ValueError("an id without a code")
    if len(ids) % 2:
        size, code = np.append(size, size[:1] * 0), np.append(code, code[:1] * U(0))
    # two codes in a row are one of 2 * LIMIT bits at most, so all that follows runs over half as many
    size, last = size[::2].astype(np.int64) + size[1::2], size[1::2].astype(np.uint64)
    code = code[::2] << last | code[1::2]
    end = np.cumsum(size)
    at = end - size
    total = int(end[-1]) if len(ids) else 0
    words = np.zeros((total >> 6) + 2, np.uint64)
    if len(ids):
        word = at >> 6
        room = 64 - (at & 63) - size
        inside = room >= 0
        high = np.where(inside, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        lead = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[lead]] = np.bitwise_or.reduceat(high, lead)
        over = ~inside
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), at[:: STEP // 2]


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """id * 32 + length of the code that each ``limit`` bits begin with."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    out = np.repeat(order * 32 + size, 1 << (limit - size))
    return np.concatenate([out, np.zeros((1 << limit) - len(out), np.int64)]).astype(np.uint32)


def unpack(bits: bytes, offsets: np.ndarray, counts: np.ndarray, table: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The ids of one or more bit strings; every checkpoint is a lane that decodes beside the others.

    offsets: a lane's first bit; counts: its ids, STEP at most.
    """
    words = np.frombuffer(bits, ">u4").astype(np.uint64)
    words = np.concatenate([words, np.zeros(2, np.uint64)])
    pos = offsets.astype(np.int64)
    lanes, longest = len(pos), int(counts.max()) if len(counts) else 0
    out = np.zeros((lanes, longest), np.uint32)
    mask = U((1 << limit) - 1)
    for k in range(longest):
        w = np.minimum(pos >> 5, len(words) - 2)
        both = (words[w] << U(32)) | words[w + 1]
        entry = table[((both >> (64 - limit - (pos & 31)).astype(np.uint64)) & mask).astype(np.int64)]
        out[:, k] = entry >> np.uint32(5)
        pos = pos + (entry & np.uint32(31))
    return out[np.arange(longest) < counts[:, None]]
