"""SimHash near-dedup: Golay-code fuzzy hashing of fingerprint segments.

A 64-bit fingerprint is cut into four segments of 16 bits. Two fingerprints that differ in at
most 3 bits agree on one segment at least (pigeonhole); of the other three segments, with those
3 errors among them, two at least hold one error or none, so of any two of them one does. A key
is therefore an unchanged segment joined to a Golay codeword near another segment.

The binary Golay code [23, 12, 7] is perfect: every word has one codeword within distance 3.
A fingerprint is *filed* under that codeword alone and *asks* under every codeword within
distance 4 (one, or six if its own is at distance 3). If two segments differ in one bit, the
first one's codeword is within 3 + 1 of the second, so filing and asking meet. Candidates are
verified on all 64 bits.

Rows with a null doc_id have the component of the documents of their fingerprint (null, if none
has an id). Null or wordless texts have fingerprint zero, linked like any other. Repeated rows and equal
fingerprints are one node; a very long text is one fingerprint like any other; a table without
rows gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.graphs import components
from weftline.llm.scratch import Scratch, lookup, parts, small_batches, unused
from weftline.llm.textcode import SPACE, U, column_bytes, lower_table, ranges, slices, word_spans

WORDS = 3
ERRORS = 3
SEED = 42
#: Members of a key that one task compares at most; a larger key is dealt in pairs of blocks.
BLOCK = 20_000
#: Fingerprints whose keys are made at once.
KEYED = 4_000
_TABLE = lower_table(gap=b" \x09\x0a\x0b\x0c\x0d")
#: Each bit of a byte in a byte lane of its own.
_LANES = np.packbits(np.zeros((256, 64), np.uint8) | np.repeat(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1), 8, axis=1) * np.tile(np.array([0, 0, 0, 0, 0, 0, 0, 1], np.uint8), 8), axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each text over the XXH64 of its word shingles, repeats included."""
    flat, starts, ends, first = word_spans(data, off, _TABLE)
    n_words = np.diff(first)
    out = np.zeros(len(n_words), np.uint64)
    if not len(starts):
        return out
    # words joined by one space each, in one buffer, so that a shingle is one slice of it
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(at[-1], SPACE, np.uint8)
    joined[ranges(at[:-1], size)] = flat[ranges(starts, size)]
    some = np.flatnonzero(n_words)
    count = np.maximum(n_words[some] - WORDS + 1, 1)
    a = ranges(first[some], count)
    b = np.minimum(a + WORDS, np.repeat(first[some] + n_words[some], count))
    text, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    h = np.array([digest(text[i:j], SEED) for i, j in zip(at[a].tolist(), (at[b] - 1).tolist())], np.uint64)
    # sums of bits in byte lanes, over at most 255 hashes at a time
    runs = -(-count // 255)
    lead = np.concatenate([[0], np.cumsum(count)[:-1]])
    cut = np.repeat(lead, runs) + 255 * ranges(np.zeros(len(runs), np.int64), runs)
    of = np.concatenate([[0], np.cumsum(runs)[:-1]])
    bits = np.empty((len(some), 64), np.int64)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[(h >> U(8 * (7 - byte))) & U(255)], cut)
        each = lanes.astype(">u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        bits[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(each, of, axis=0)
    out[some] = np.packbits(bits * 2 > count[:, None], axis=1).view(">u8").ravel()
    return out


# --- the Golay code ---

#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code.
GENERATOR = 0b101011100011


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each 16-bit segment: its codeword's index, all indices within distance 4 and where those start."""
    words = np.zeros(4096, np.uint32)
    message = np.arange(4096, dtype=np.uint32)
    for i in range(12):
        words ^= np.where(message >> i & 1, np.uint32(GENERATOR << i), np.uint32(0))
    segment = np.arange(65536, dtype=np.uint32)
    own = np.zeros(65536, np.int64)
    near: list[np.ndarray] = []
    for lo in range(0, 65536, 1024):
        d = np.bitwise_count(segment[lo : lo + 1024, None] ^ words[None, :])
        own[lo : lo + 1024] = d.argmin(1)
        near.append(np.argwhere(d <= ERRORS + 1) + [lo, 0])
    near = np.concatenate(near)
    return own, near[:, 1], np.searchsorted(near[:, 0], np.arange(65537))


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fp, key, filed) of every key: filed ones, then those asked under."""
    own, near, lead = golay()
    seg = [(fp >> U(48 - 16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
    me = np.arange(len(fp))
    of, key, filed = [], [], []
    for i in range(4):
        for j in ((i + 1) % 4, (i + 2) % 4):
            base = ((i * 4 + j) << 28) | (seg[i] << 12)
            of.append(me)
            key.append(base | own[seg[j]])
            filed.append(np.ones(len(fp), bool))
            n = lead[seg[j] + 1] - lead[seg[j]]
            of.append(np.repeat(me, n))
            key.append(np.repeat(base, n) | near[ranges(lead[seg[j]], n)])
            filed.append(np.zeros(int(n.sum()), bool))
    return np.concatenate(of), np.concatenate(key), np.concatenate(filed)


def spanning(fp: np.ndarray, most: int = ERRORS) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest over fp within ``most`` bits; memory grows with len(fp) only."""
    left = np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            close = np.bitwise_count(fp[left] ^ fp[at]) <= most
            if close.any():
                for x in left[close]:
                    yield int(at), int(x)
                queue.extend(left[close])
                left = left[~close]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, id, filed) sorted by key -> links (a, b) between ids."""
    rest: list[pa.Table] = []

    def solve(t: pa.Table) -> pa.RecordBatch:
        key, fp, ident, filed = (t.column(c).to_numpy() for c in ("key", "fp", "id", "filed"))
        fp = fp.view(np.uint64)
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([cut, [len(key)]]))
        has = np.add.reduceat(filed.astype(np.int64), cut)
        a, b = [], []
        small = (size <= 64) & (has > 0) & (size > 1)
        # filed x asking within each small group
        group = np.repeat(np.arange(len(cut)), size)
        f = np.flatnonzero(filed & small[group])
        n = size[group[f]]
        left, right = np.repeat(f, n), ranges(cut[group[f]], n)
        ok = (fp[left] != fp[right]) & (np.bitwise_count(fp[left] ^ fp[right]) <= ERRORS)
        a.append(ident[left[ok]])
        b.append(ident[right[ok]])
        for g in np.flatnonzero((size > 64) & (has > 0)):
            each, at = np.unique(fp[cut[g] : cut[g] + size[g]], return_index=True)
            pairs = np.array(list(spanning(each)), np.int64).reshape(-1, 2)
            a.append(ident[cut[g] + at[pairs[:, 0]]])
            b.append(ident[cut[g] + at[pairs[:, 1]]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        key = t.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield solve(pa.concat_tables([*rest, t.slice(0, cut)]))
            rest = []
        rest.append(t.slice(cut))
    if rest:
        yield solve(pa.concat_tables(rest))


def fingerprint_rows(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                fp = fingerprints(*column_bytes(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def near_links(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) that span every component of ``nodes (id, fp)``, whose fp are distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, ident = (batch.column(c).to_numpy() for c in ("fp", "id"))
            for lo in range(0, len(fp), KEYED):
                of, key, filed = keys(fp[lo : lo + KEYED].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[lo + of]), pa.array(ident[lo + of]), pa.array(filed)], ["key", "fp", "id", "filed"])

    # few bytes, many keys: every task gets a share of the fingerprints
    rows = nodes.select("fp", "id").repartition(parts(nodes.sparkSession)).mapInArrow(run, "key long, fp long, id long, filed boolean")
    rows = scratch.keep(rows.repartition(parts(nodes.sparkSession), "key"), "keys")
    crowd = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    crowd = scratch.keep(crowd.select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), "crowd")
    if not crowd.isEmpty():
        # a crowded key: member i goes to block i % blocks, and every pair of blocks is a task's key
        most = F.col("blocks")
        block = F.pmod(F.xxhash64("fp"), most)
        other = F.explode(F.sequence(F.lit(0).cast("long"), most - 1))
        dealt = rows.join(crowd, "key").withColumn("mine", block).withColumn("other", other)
        dealt = dealt.withColumn("key", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))).select("key", "fp", "id", F.lit(True).alias("filed"))
        rows = rows.join(crowd, "key", "left_anti").select("key", "fp", "id", "filed").unionByName(dealt).repartition(parts(nodes.sparkSession), "key")
        rows = scratch.keep(rows, "dealt")
    return rows.repartition(parts(nodes.sparkSession), "key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    small_batches(spark)
    rows = scratch.keep(fingerprint_rows(docs, text, ident), "fingerprints")
    total = rows.count()
    nodes = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")), "nodes")
    links = scratch.keep(near_links(nodes.where("id is not null"), scratch).distinct(), "links")
    scratch.drop("keys")
    found = components(links, scratch)
    label = nodes.join(found, "id", "left").select("fp", "n", F.coalesce("component", "id").alias("component_id"))
    out = lookup(rows, label, "fp", F.xxhash64("doc_id"), "n", total)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The rows of docs that name their component; of rows with one doc_id there, all stay."""
    stay = unused("stay", docs)
    found = near_duplicates(docs, text, ident).where("doc_id <=> component_id").select(F.col("doc_id").alias(stay)).distinct()
    return docs.join(found, F.col(ident).cast("long").eqNullSafe(F.col(stay)), "left_semi")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, wordless ones as fingerprint zero: a row for each; an empty table gives none."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
