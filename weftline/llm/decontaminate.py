"""Benchmark decontamination by winnowing.

Benchmark items and documents are cut into words; of every six consecutive hashes of five words
the least is kept (the rightmost of equals), so a span of ten words shared by both always keeps
one hash at the same place on both sides. Kept hashes are joined; around each meeting place the
windows of ten words that hold it are looked up among the item windows and compared byte by byte.
An item of fewer than ten words is one window, looked for at every place.

The benchmark is the stated query set. Repeated rows of it count once; items longer than a
quarter of a block go as pieces that overlap by nine words, so that every window is in one. What
that leaves is dealt into blocks whose sizes are measured: none holds more than BLOCK_BYTES, each
is broadcast and passed over the documents, so any size of benchmark gives whole results.

Null texts have no words. Repeated document rows give a row each; repeated items count once by
item_id, and a null item_id counts as the id ``null``. A very long document is read whole, in a
slice of its own. Empty tables give no rows or no hits. Other columns, whatever their names, are
ignored or carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import Scratch, small_batches
from weftline.llm.textcode import column_bytes, covered, grams, lower_table, ranges, slices, span_hashes, word_spans

WINDOW = 10
GRAM = 5
#: Hashes of GRAM words in a window of WINDOW words: the least of these is kept.
KEEP = WINDOW - GRAM + 1
#: Bytes of item texts that are broadcast at once.
BLOCK_BYTES = 16_000_000
#: Fixed value: bytes of words, [^\x00-\x2F\x3A-\x60\x7B-\x7F] in UTF-8 after lower-casing A-Z.
_WORD = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def _table() -> np.ndarray:
    t = lower_table(word=_WORD)
    t[65:91] = np.arange(97, 123)
    return t


_TABLE = _table()


def winnow(g: np.ndarray, ok: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """Places of the least hash, the rightmost of equals, of every ``keep`` hashes that are all ok.

    ok: whether a hash lies within one text; a run of ok hashes shorter than ``keep`` keeps none.
    """
    n = len(g) - keep + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(n) + keep - 1
    best = g[at].copy()
    for j in range(keep - 2, -1, -1):
        less = g[j : j + n] < best
        best = np.where(less, g[j : j + n], best)
        at = np.where(less, np.arange(n) + j, at)
    bad = np.concatenate([[0], np.cumsum(~ok)])
    return np.unique(at[bad[keep:] == bad[: n]])


class Words:
    """The words of many texts, their hashes and which text holds them."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.flat, self.start, self.end, self.first = word_spans(data, off, _TABLE)
        self.hash = span_hashes(self.flat, self.start, self.end)
        self.last = np.repeat(self.first[1:], np.diff(self.first))  # of each word: where its text ends

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each k words, and whether they lie in one text."""
        g = grams(self.hash, k)
        return g, np.arange(len(g)) + k <= self.last[: len(g)]


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from a's i and b's j have equal bytes, pair by pair."""
    if not len(i):
        return np.zeros(0, bool)
    i, j = (i[:, None] + np.arange(k)).ravel(), (j[:, None] + np.arange(k)).ravel()
    n = a.end[i] - a.start[i]
    ok = (n == b.end[j] - b.start[j]).reshape(-1, k).all(1)
    keep = np.repeat(ok, k)
    i, j, n = i[keep], j[keep], n[keep]
    if len(i):
        equal = a.flat[ranges(a.start[i], n)] == b.flat[ranges(b.start[j], n)]
        ends = np.cumsum(n.reshape(-1, k).sum(1))
        ok[ok] = np.logical_and.reduceat(equal, np.concatenate([[0], ends[:-1]]))
    return ok


class Index:
    """Kept hashes and windows of a block of items."""

    def __init__(self, texts: list[str | None], ids: list[str]):
        self.words = w = Words(*column_bytes(pa.array(texts, pa.string())))
        n = np.diff(w.first)
        item = np.repeat(np.arange(len(texts)), n)
        g, ok = w.grams(GRAM)
        self.kept = np.unique(g[winnow(g, ok)])
        # words of a window, hashes, places, items: a second entry for k has windows whose hash another one has as well
        self.windows: list[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]] = []
        for k in np.unique(np.minimum(n[n > 0], WINDOW)).tolist():
            h, ok = w.grams(k)
            at = np.flatnonzero(ok & ((n == k) | (k == WINDOW))[item[: len(ok)]])
            at = at[np.argsort(h[at], kind="stable")]
            while len(at):
                key, lead = np.unique(h[at], return_index=True)
                same = same_words(w, at, w, np.repeat(at[lead], np.diff([*lead, len(at)])), k)
                of = np.repeat(np.arange(len(lead)), np.diff([*lead, len(at)]))[same]
                self.windows.append((k, key, at[lead], [np.unique(item[x]) for x in np.split(at[same], np.flatnonzero(np.diff(of)) + 1)]))
                at = at[~same]
        self.ids = np.array(ids, object)

    def hits(self, w: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words of w are hit, and the items found in each text that has any."""
        starts, ends, items = [], [], {}
        for k, key, at, lists in self.windows:
            h, ok = w.grams(k)
            if k == WINDOW:
                g, whole = w.grams(GRAM)
                p = winnow(g, whole)
                x = np.searchsorted(self.kept, g[p])
                p = p[self.kept[np.minimum(x, len(self.kept) - 1)] == g[p]] if len(self.kept) else p[:0]
                p = np.unique((p[:, None] - np.arange(KEEP)).ravel())
                p = p[(p >= 0) & (p < len(h))]
            else:
                p = np.arange(len(h))
            p = p[ok[p]]
            x = np.minimum(np.searchsorted(key, h[p]), len(key) - 1)
            found = key[x] == h[p]
            p, x = p[found], x[found]
            same = same_words(w, p, self.words, at[x], k)
            p, x = p[same], x[same]
            starts.append(p)
            ends.append(p + k)
            text = np.searchsorted(w.first, p, "right") - 1
            for t, y in np.unique(np.stack([text, x], 1), axis=0).tolist() if len(p) else ():
                items.setdefault(t, set()).update(self.ids[lists[y]])
        if not starts:
            return np.zeros(len(w), bool), items
        return covered(np.concatenate(starts), np.concatenate(ends), len(w)), items


def _pieces(texts: list[str], ids: list[str], most: int) -> Iterator[tuple[str, str]]:
    """(id, text) of items, those of over ``most`` bytes in pieces that overlap by WINDOW - 1 words."""
    for ident, text in zip(ids, texts):
        raw = text.encode()
        if len(raw) <= most:
            yield ident, text
            continue
        flat, start, end, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _TABLE)
        lo = 0
        while lo < len(start):
            hi = max(lo + WINDOW, int(np.searchsorted(end, start[lo] + most, "right")))
            hi = len(start) if hi + 1 >= len(start) else hi
            yield ident, raw[start[lo] : end[hi - 1]].decode()
            lo = len(start) if hi == len(start) else hi - WINDOW + 1


def blocks_of(benchmark: DataFrame, scratch: Scratch, block_bytes: int) -> list[list[tuple[str, str]]] | Iterator[list[tuple[str, str]]]:
    """The distinct items (item_id, text) in blocks of at most ``block_bytes``: a list of one, or each collected when its turn comes."""
    query = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = list(_pieces(piece.column("text").to_pylist(), piece.column("item_id").to_pylist(), max(1, block_bytes // 4)))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.string()) for j in (0, 1)], ["item_id", "text"])

    rows = scratch.keep(query.mapInArrow(cut, "item_id string, text string").distinct(), "items")
    weight = F.octet_length("text") + F.octet_length("item_id") + 64
    total, longest = rows.agg(F.sum(weight), F.max(weight)).first()
    blocks = max(1, -(-(total or 0) // block_bytes))
    place = lambda n: F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    # a number per block; more blocks until each fits (one word may be longer than a block, and then is a block)
    while blocks > 1 and rows.groupBy(place(blocks).alias("b")).agg(F.sum(weight).alias("w")).agg(F.max("w")).first()[0] > max(block_bytes, longest):
        blocks += -(-blocks // 4)
    found = ([(r.item_id, r.text) for r in rows.where(place(blocks) == b).collect()] for b in range(blocks))
    return list(found) if blocks == 1 else found


def hit_words(docs: DataFrame, benchmark: DataFrame, text: str = "text", ident: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items (sorted array of ids)``, a row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "decontaminate")
    base = docs.select(F.col(ident).alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = blocks_of(benchmark, scratch, block_bytes)
    kind = base.schema["doc_id"].dataType.simpleString()
    one = isinstance(blocks, list)

    def over(items: list[tuple[str, str]], every: bool) -> DataFrame:
        sent = spark.sparkContext.broadcast(([t for _, t in items], [i for i, _ in items]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*sent.value)
            for batch in batches:
                for piece in slices(batch, "text"):
                    w = Words(*column_bytes(piece.column("text")))
                    hit, items = index.hits(w)
                    n = np.diff(w.first)
                    total = np.concatenate([[0], np.cumsum(hit)])
                    cols = [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(total[w.first[1:]] - total[w.first[:-1]], pa.int64())]
                    cols.append(pa.array([sorted(items.get(i, ())) for i in range(len(n))], pa.list_(pa.string())))
                    names = ["doc_id", "n_words", "n_hit", "items"]
                    if not one:
                        cols += [piece.column("row"), pa.array([np.packbits(hit[a:b]).tobytes() if i in items else None for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:]))], pa.binary())]
                        names += ["row", "bits"]
                    out = pa.RecordBatch.from_arrays(cols, names)
                    yield out if every else out.filter(out.column("bits").is_valid())

        more = "" if one else ", row long, bits binary"
        return base.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, items array<string>{more}")

    if one:
        return over(blocks[0], True)
    base = scratch.keep(base.withColumn("row", F.monotonically_increasing_id()), "documents")  # a name for each row, fixed by writing it
    found = [scratch.keep(over(items, b == 0), f"block{b}") for b, items in enumerate(blocks)]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)

    @F.pandas_udf("long")
    def count_bits(lists):
        def count(masks) -> int:
            masks = [np.frombuffer(m, np.uint8) for m in masks if m is not None]
            return int(np.bitwise_count(np.bitwise_or.reduce(masks)).sum()) if masks else 0

        return lists.map(count)

    out = every.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_list("bits").alias("bits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return out.select("doc_id", "n_words", count_bits("bits").alias("n_hit"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, a row per document."""
    out = hit_words(docs, benchmark, **how)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs without any hit word; each block of the benchmark passes over what is left."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    query = benchmark.select(F.lit("").alias("item_id"), "text")
    for items in blocks_of(query, Scratch(spark, "decontaminated"), block_bytes):
        sent = spark.sparkContext.broadcast([t for _, t in items])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, [""] * len(sent.value))
            for batch in batches:
                for piece in slices(batch, text):
                    w = Words(*column_bytes(piece.column(text)))
                    total = np.concatenate([[0], np.cumsum(index.hits(w)[0])])
                    yield piece.filter(pa.array(total[w.first[1:]] == total[w.first[:-1]]))

        docs = docs.mapInArrow(run, kind)
    return docs


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``: a row for each document, null texts without words; empty tables give no rows or no hits."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS k, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT r, i, k, item_id FROM dw JOIN bw USING (k, g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
