"""Texts to token ids with the tokenizers library, each distinct piece encoded once.

Both kinds of vocabulary file known here cut a text before they merge: always where white space
begins, and always between an ASCII letter and ASCII punctuation or a digit. So a text's ids are
those of the pieces between such places. Pieces of a batch are numbered by Arrow's dictionary
encoding; the ids of a piece are kept, and what is new in a batch is encoded by the library in
one call. Texts with white space beyond ASCII or control characters that some count as such, texts
that hold the string of an added token, and every text of another kind of file, are encoded whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from weftline.llm.textcode import column_bytes, ranges

#: Pieces that came in two batches and are kept (beyond that the later half goes), and pieces that came in one.
KEPT, YOUNG = 150_000, 200_000
#: New pieces that one call of the library encodes; it is slower on long texts.
GROUP = 500

_BLANK, _LETTER, _OTHER, _LONG = range(4)


def _classes() -> np.ndarray:
    t = np.full(256, _OTHER, np.uint8)
    t[[9, 10, 11, 12, 13, 32]] = _BLANK
    t[65:91] = t[97:123] = _LETTER
    t[128:] = _LONG
    return t


_CLASS = _classes()


def _fold() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[_CLASS == _BLANK] = 32
    return t


_FOLD = _fold()
#: First bytes of white space beyond ASCII in UTF-8, and control characters.
_ODD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F])


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII, or a control character from 1C to 1F, stands."""
    at = np.flatnonzero(_ODD[data])
    a, b, c = (data[np.minimum(at + k, max(len(data) - 1, 0))] for k in range(3))
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    three |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    return at[(a < 0x20) | two | three]


class Encoder:
    """Ids of texts as little-endian numbers of ``width`` bytes. added: strings of added tokens get their ids."""

    room = 1  # times KEPT and YOUNG that are stored

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added  # if set, their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.strategy = "whole"
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and norm is None:
            self.strategy = "space"
            self.length = np.zeros(size, np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                self.length[i] = len(token)  # a character of a token stands for one byte
        elif "'Split'" in str(before) and (spec["model"].get("end_of_word_suffix") or "") and "Lowercase" in str(norm):
            mark = self.tokenizer.encode("\x01", add_special_tokens=False).ids
            if len(mark) == 1:
                self.strategy, self.mark = "word", mark[0]
        strings = [t["content"] for t in spec.get("added_tokens") or []] if added else []
        if any(any(c.isspace() for c in s) or not s.isascii() for s in strings):
            self.strategy = "whole"
        # white space and case aside: a text that holds one perhaps is left to the library
        self.added = [_FOLD[np.frombuffer(s.encode(), np.uint8)].tobytes() for s in strings if s]
        self.memo: dict[bytes, bytes] = {}
        self.young: dict[bytes, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _one_call(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _learn(self, keys: list[bytes]) -> None:
        """Store the ids of pieces: those that can stand one after another are encoded in one call."""
        if self.strategy == "space":
            # white space after something else always starts anew
            fit = [k for k in keys if k[0] in b" \t\n\x0b\x0c\r" and k[-1] not in b" \t\n\x0b\x0c\r"]
        else:
            fit = [k for k in keys if b"\x01" not in k]
        done = 0
        for lo in range(0, len(fit), GROUP):
            some = fit[lo : lo + GROUP]
            if self.strategy == "space":
                ids = self._one_call(b"".join(some).decode())
                ends = np.cumsum(self.length[ids])
                want = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
                to = np.minimum(np.searchsorted(ends, want), len(ends) - 1)
                ok = bool((ends[to] == want).all())
                start, stop = np.concatenate([[0], to[:-1] + 1]), to + 1
            else:
                ids = self._one_call((b" \x01 ".join(some) + b" \x01").decode())
                stop = np.flatnonzero(ids == self.mark)
                ok = len(stop) == len(some)
                start = np.concatenate([[0], stop[:-1] + 1]) if ok else stop
            if not ok:
                break
            raw, w = ids.astype(self.kind).tobytes(), self.width
            self.young.update(zip(some, [raw[a:b] for a, b in zip((start * w).tolist(), (stop * w).tolist())]))
            done += len(some)
        if done < len(keys):
            rest = [k for k in keys if k not in self.young]
            self.young.update(zip(rest, self.whole([k.decode() for k in rest])))

    def _look_up(self, keys: list[bytes], whole: dict[int, bytes]) -> list[bytes]:
        """The ids of each piece; ``whole`` has some by their place."""
        if len(self.memo) > KEPT * self.room:
            self.memo = dict(list(self.memo.items())[: KEPT * self.room // 2])
        if len(self.young) > YOUNG * self.room:
            self.young = {}
        memo, young = self.memo, self.young
        pool = list(map(memo.get, keys))
        for i, x in whole.items():
            pool[i] = x
        at = [i for i, x in enumerate(pool) if x is None]
        if at:
            missed = [keys[i] for i in at]
            known = list(map(young.get, missed))
            again = [(k, x) for k, x in zip(missed, known) if x is not None]
            memo.update(again)  # came again: kept from now on
            for k, _ in again:
                del young[k]
            new = [k for k, x in zip(missed, known) if x is None]
            if new:
                self._learn(new)
            for i, k, x in zip(at, missed, known):
                pool[i] = young[k] if x is None else x
        return pool

    def _with_added(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Which texts hold the string of an added token."""
        out = np.zeros(len(off) - 1, bool)
        if self.added and len(data):
            raw = _FOLD[data].tobytes()
            for s in self.added:
                at = raw.find(s)
                while at >= 0:
                    k = int(np.searchsorted(off, at, "right")) - 1
                    out[k] = True
                    at = raw.find(s, int(off[k + 1]))
        return out

    def encode(self, col: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and how many each text has; ``end`` closes every text."""
        data, off = column_bytes(col)
        n = len(off) - 1
        special = self._with_added(data, off)
        if self.strategy == "word":  # the library lower-cases and drops white space as well, but for added tokens
            data = np.where(np.repeat(special, np.diff(off)), data, _FOLD[data]) if special.any() else _FOLD[data]
        apart = special
        if self.strategy == "whole":
            apart[:] = True
        else:
            apart[np.searchsorted(off, _odd_places(data), "right") - 1] = True
        kind = _CLASS[data]
        edge = np.zeros(len(data) + 1, bool)
        if len(data):
            edge[1:-1] = (kind[1:] == _BLANK) & (kind[:-1] != _BLANK) | (kind[:-1] == _LETTER) & (kind[1:] == _OTHER)
        edge[off] = True
        if apart.any():  # one piece each
            edge[1:-1] &= np.repeat(~apart, np.diff(off))[1:]
            edge[off] = True
        place = np.flatnonzero(edge) if len(data) else np.zeros(1, np.int64)
        first = np.searchsorted(place, off)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(place) - 1, [None, pa.py_buffer(place.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        codes = pieces.indices.to_numpy().astype(np.int64)
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        whole = {}
        if apart.any():
            some = np.flatnonzero(apart & (np.diff(off) > 0))
            whole = dict(zip(codes[first[some]].tolist(), self.whole([col[i].as_py() for i in some.tolist()])))
        pool = self._look_up(keys, whole)
        count = np.diff(first)
        if end is not None:
            codes = np.insert(codes, first[1:], len(pool))
            pool.append(np.array([end], self.kind).tobytes())
            count = count + 1
        size = np.fromiter(map(len, pool), np.int64, len(pool)) // self.width
        lead = np.cumsum(size) - size
        each = size[codes]
        ids = np.frombuffer(b"".join(pool), self.kind)[ranges(lead[codes], each)]
        total = np.concatenate([[0], np.cumsum(each)])
        at = np.concatenate([[0], np.cumsum(count)])
        return ids, total[at[1:]] - total[at[:-1]]


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker; its store of pieces serves all tasks of the worker."""
    return Encoder(path, added=True)
