"""Removal of repeated 200-byte strings with run-length indexes.

What has to meet, meets by content. Of the hashes of GRAM bytes in each string of LENGTH bytes the
least (the rightmost of equals) is its anchor: equal strings have equal anchors at equal offsets.
Consecutive strings of one anchor form a *range* (document, first start, last start).

1. Ranges are grouped by anchor. A range whose bytes equal another's is repeated throughout; one
   that is alone under its anchor has no repeat; the others are open.
2. Open ranges are cut, at fixed offsets from the anchor, into ranges of STEP starts, whose key is
   the hash of the bytes that all its strings share. The same rule decides: equal bytes are
   repeated, a lone key is not, the rest (about one for each edge of a repeat) stays open.
3. The bytes of what is open go to the bucket of their key. A bucket builds a run-length index
   (rlbwt) over its strings and streams matching statistics: a start is repeated if it matches
   another one over LENGTH bytes. No two ranges hold the same start, so a match in the index is
   a match of two places.

Equal ranges within a batch of documents are settled there and send one row on, so a text with
very many copies is dealt once per batch. A key with more than HOT open ranges (the edge of a
passage that very many documents share) is cut down to single strings, whose hash is the key, so no
index grows with a passage's popularity; single strings need none. A task holds one row of a key.

What the index settles is the edges of repeats. To feed it all repeated ranges would index a
quarter of the check tables' text twice, at about twice the budget of the check tool (README).

Null text is empty; texts shorter than LENGTH have no repeat; repeated rows and doc_ids are
documents of their own (one text twice is repeated as a whole); a very long text is read whole, in
a slice of its own; an empty table gives no rows; extra columns are ignored. Equality by hash is on
128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.rlbwt import RunIndex
from weftline.llm.scratch import Scratch, parts, small_batches
from weftline.llm.textcode import BYTE, LENGTH as SALT, P, P_INV, U, column_bytes, constants, covered, mix, powers, ranges, slices

LENGTH = 200
GRAM = 40
STEP = 13
#: Open ranges of a key that one index takes; beyond that the key is cut further.
HOT = 500
#: Keys beyond HOT that are broadcast at most.
CROWDS = 500_000
#: Bytes of one run-length index, about.
INDEX_BYTES = 1_500_000
_C = constants(64, 51)
_ITEM = [("row", pa.int64()), ("key", pa.int64()), ("same", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int32())]
_ITEM_SQL = "row long, key long, same long, at int, lo int, hi int, n int"
#: n: 0 settled as repeated, 1 a range alone so far, 2 one that stands for equal ones that are settled.
_SETTLED = 0


def _items(cols: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, (_, k) in zip(cols, _ITEM)], [n for n, _ in _ITEM])


class Prefix:
    """Hashes of any spans of some bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * powers(P, len(data)), out=self.sums[1:])
        self.back = powers(P_INV, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * SALT)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of every GRAM = 32 + 8 bytes."""
    h, width, eight = BYTE[data], 1, None
    while width < 32:
        h = h[:-width] * _C[width] + h[width:]
        width *= 2
        if width == 8:
            eight = h
    n = len(data) - GRAM + 1
    return mix(h[:n] * _C[40] + eight[32 : 32 + n])


def anchored(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Ranges of all texts: (anchor hash, text, anchor, first start, last start), places within the slice."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.uint64), *none)
    g = gram_hashes(data)
    window = length - GRAM + 1
    bits = max(22, len(g).bit_length())
    low = U((1 << bits) - 1)
    key = (g & ~low) | (low - np.arange(len(g), dtype=np.uint64))  # the rightmost of equals is least
    width = 1
    while width * 2 <= window:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[window - width : window - width + n])
    anchor = (low - (key & low)).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(off, start, "right") - 1
    ok = start + length <= off[text + 1]
    start, text, anchor = start[ok], text[ok], anchor[ok]
    if not len(start):
        return (np.zeros(0, np.uint64), *none)
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([cut[1:], [len(start)]]) - 1
    return g[anchor[cut]], text[cut], anchor[cut], start[cut], start[last]


def settle(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of one batch: equal ranges are settled; one of them goes on, with n = 2."""
    key, same = cols[1].view(np.uint64), cols[2].view(np.uint64)
    both = mix(key) ^ same
    _, first, which, count = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    several = count[which] > 1
    n = np.where(several, 2, 1)
    lead = np.zeros(len(key), bool)
    lead[first] = True
    go = [c[lead] for c in (*cols[:6], n)]
    done = [c[several] for c in (*cols[:6], np.zeros(len(key), np.int64))]
    return [np.concatenate(x) for x in zip(go, done)]


def _first_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            data, off = column_bytes(piece.column("text"))
            h, text, anchor, lo, hi = anchored(data, off)
            if not len(h):
                continue
            same = mix(Prefix(data).of(lo, hi + LENGTH) + (anchor - lo).astype(np.uint64) * SALT)
            row = piece.column("row").to_numpy()[text]
            base = off[text]
            yield _items(settle([row, h.view(np.int64), same.view(np.int64), anchor - base, lo - base, hi - base]))


def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, same) -> settled ranges, and open ones (n = 1): one of each kind, where kinds share a key.

    From batch to batch one row is held, the first of the last kind, however many rows its key has.
    """
    held: list[np.ndarray] | None = None
    settled_held = sent_held = others = False  # of the held row: whether it went out, and whether its key has other kinds
    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns]
        old = cols[6] == _SETTLED
        out = [[c[old] for c in cols]]
        cols = [c[~old] for c in cols]
        if len(cols[0]):
            settled, sent = np.zeros(len(cols[0]), bool), np.zeros(len(cols[0]), bool)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                settled, sent = np.append(settled_held, settled), np.append(sent_held, sent)
            key, same, n = cols[1], cols[2], cols[6]
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new = new_key | np.concatenate([[True], same[1:] != same[:-1]])
            group, kind = np.cumsum(new_key) - 1, np.cumsum(new) - 1
            kinds = np.bincount(group[new])
            kinds[0] += held is not None and others
            done = (np.bincount(kind, n)[kind] > 1) & (n == 1) & ~settled  # equal ranges somewhere
            go = new & (kinds[group] > 1) & ~sent
            out.append([*(c[done] for c in cols[:6]), np.zeros(int(done.sum()), np.int64)])
            out.append([*(c[go] for c in cols[:6]), np.ones(int(go.sum()), np.int64)])
            last = int(np.flatnonzero(new)[-1])
            held = [c[last : last + 1] for c in cols]
            settled_held, sent_held, others = bool(settled[last] | done[last]), bool(sent[last] | go[last]), bool(kinds[group[last]] > 1)
        yield _items([np.concatenate(x) for x in zip(*out)])


def _cut(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Documents with their open ranges -> ranges of at most ``step`` starts."""
    for batch in batches:
        for piece in slices(batch, "text"):
            data, off = column_bytes(piece.column("text"))
            doc, at, lo, hi, n = _open(piece)
            if not len(doc):
                continue
            base = off[doc]
            # fixed offsets from the anchor, so that equal strings are cut alike
            a, b = (lo - at) // step, (hi - at) // step
            count = b - a + 1
            cell = ranges(a, count)
            doc, at, base = np.repeat(doc, count), np.repeat(at, count), np.repeat(base, count)
            low, high = np.maximum(np.repeat(lo, count), at + cell * step), np.minimum(np.repeat(hi, count), at + cell * step + step - 1)
            span = Prefix(data)
            # the bytes that all strings of the cell have in common: part of each, so within the text
            first = base + at + cell * step
            shared = span.of(first + step - 1, first + LENGTH)
            key = mix(span.of(base + at, base + at + GRAM) + mix(shared) + cell.astype(np.uint64) * _C[7])
            same = mix(span.of(base + low, base + high + LENGTH) + (low - at).astype(np.uint64) * SALT)
            row = piece.column("row").to_numpy()[doc]
            yield _items(settle([row, key.view(np.int64), same.view(np.int64), at, low, high]))


def _open(piece: pa.RecordBatch) -> list[np.ndarray]:
    """(document in the piece, at, lo, hi, key) of the open ranges that came with the documents."""
    lists = piece.column("open")
    doc = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    flat = lists.flatten()
    return [doc, *(flat.field(c).to_numpy().astype(np.int64) for c in ("at", "lo", "hi", "key"))]


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their open ranges -> the bytes of each range."""
    names = ["key", "row", "lo", "bytes"]
    for batch in batches:
        for piece in slices(batch, "text"):
            data, off = column_bytes(piece.column("text"))
            doc, at, lo, hi, key = _open(piece)
            size = hi - lo + LENGTH
            flat = data[ranges(off[doc] + lo, size)]
            where = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            strings = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(where), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(piece.column("row").to_numpy()[doc]), pa.array(lo.astype(np.int32)), strings], names)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings sorted by key -> the starts that an index finds repeated, as ranges (row, lo, hi)."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        strings = t.column("bytes").chunk(0)
        _, off, data = strings.buffers()
        off = np.frombuffer(off, np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
        index = RunIndex(np.frombuffer(data, np.uint8)[off[0] : off[-1]], np.diff(off))
        found = np.flatnonzero(index.statistics() >= LENGTH)
        which = np.searchsorted(index.first, found, "right") - 1
        place = found - index.first[which] + t.column("lo").to_numpy()[which]
        cut = np.concatenate([[True], (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)]) if len(found) else np.zeros(0, bool)
        lead = np.flatnonzero(cut)
        tail = np.concatenate([lead[1:], [len(found)]])[: len(lead)] - 1
        return pa.RecordBatch.from_arrays([pa.array(t.column("row").to_numpy()[which[lead]]), pa.array(place[lead].astype(np.int32)), pa.array(place[tail].astype(np.int32))], ["row", "lo", "hi"])

    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        key = t.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1])) if size + t.nbytes >= INDEX_BYTES else 0
        if cut or (size >= INDEX_BYTES and held and held[-1].column("key")[-1].as_py() != key[0]):
            if cut:
                held.append(t.slice(0, cut))
            yield solve(pa.concat_tables(held))
            held, size = [], 0
            t = t.slice(cut)
        held.append(t)
        size += t.nbytes
    if held:
        yield solve(pa.concat_tables(held))


def repeated_starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Ranges (row, lo, hi) of starts whose LENGTH bytes also start elsewhere; rows (row, text) have unique ``row``."""
    spark = rows.sparkSession
    n = parts(spark)

    def grouped(items: DataFrame, name: str) -> DataFrame:
        # settled ranges only pass: they are dealt by their document
        dealt = items.withColumn("_to", F.when(F.col("n") == _SETTLED, F.xxhash64("row", "lo")).otherwise(F.col("key")))
        sorted_ = dealt.repartition(n, "_to").drop("_to").sortWithinPartitions("key", "same", F.col("n").desc(), "row", "lo")
        return scratch.keep(sorted_.mapInArrow(classify, _ITEM_SQL), name)

    def with_open(items: DataFrame) -> DataFrame:
        """Documents with their open ranges."""
        lists = items.groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi", "key")).alias("open"))
        return rows.join(lists, "row").select("row", "text", "open")

    def cut(items: DataFrame, step: int) -> DataFrame:
        return with_open(items).mapInArrow(lambda batches: _cut(batches, step), _ITEM_SQL)

    whole = grouped(rows.mapInArrow(_first_ranges, _ITEM_SQL), "ranges")
    cells = grouped(cut(whole.where("n > 0"), STEP), "cells")
    done = whole.where("n = 0").select("row", "lo", "hi").unionByName(cells.where("n = 0").select("row", "lo", "hi"))
    open_ = cells.where("n = 1")
    crowd = scratch.keep(open_.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT).select("key"), "crowd")
    many = crowd.count()
    if many:
        few = F.broadcast(crowd) if many <= CROWDS else crowd
        single = grouped(cut(open_.join(few, "key", "left_semi"), 1), "single")
        done = done.unionByName(single.where("n = 0").select("row", "lo", "hi"))
        open_ = open_.join(few, "key", "left_anti")
    strings = with_open(open_).mapInArrow(_bytes, "key long, row long, lo int, bytes binary")
    found = strings.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_indexed, "row long, lo int, hi int")
    return done.unionByName(scratch.keep(found, "indexed"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        for piece in slices(batch, "text"):
            data, off = column_bytes(piece.column("text"))
            lists = piece.column("found")
            doc = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            flat = lists.flatten()
            lo, hi = (flat.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
            gone = covered(off[doc] + lo, off[doc] + hi + LENGTH, len(data))
            edge = gone.copy()
            inner = off[1:-1]
            edge[1:] &= ~gone[:-1]
            edge[inner[inner < len(data)]] = gone[inner[inner < len(data)]]
            left = np.concatenate([[0], np.cumsum(~gone)])
            spans = np.concatenate([[0], np.cumsum(edge)])
            kept = memoryview(data[~gone].tobytes())
            size, stay = np.diff(off), left[off[1:]] - left[off[:-1]]
            sha = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(left[off[:-1]].tolist(), left[off[1:]].tolist())]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(size), pa.array(size - stay), pa.array(spans[off[1:]] - spans[off[:-1]]), pa.array(sha)], names)


def without_repeats(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, a row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "repeats")
    base = docs.select(F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total, known = base.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if known == total:
        base = base.withColumn("row", F.col("doc_id"))
    else:  # ids don't name rows: number them, fixed by writing them
        base = scratch.keep(base.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = repeated_starts(base.select("row", "text"), scratch)
    lists = scratch.keep(found.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("found")), "found")
    for name in ("ranges", "cells", "crowd", "single", "indexed"):
        scratch.drop(name)
    return base.join(lists, "row", "left").select("doc_id", "text", "found").mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_repeated_strings(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, nulls as empty text: a row for each; an empty table gives none."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
