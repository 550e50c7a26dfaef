"""Exact dedup against immutable snapshots that static binary-fuse filters guard.

The rows of the table come in batches (by crc32 of doc_id); the first is taken as a snapshot:
its distinct digests are dealt into buckets by their first bytes, and each bucket gets one
static binary-fuse filter, stored beside it. A later batch's digests are screened by the filter
of their bucket. Digests that it lets pass join the exact buckets; those it stops are certainly
new and are grouped among themselves. Then the batch itself becomes part of what is known.

Digests only retrieve: rows of a digest that more than one row has are grouped by the bytes of
the text as well, so two texts of one digest would stay apart. The text of a row whose digest is
alone is never moved: up to FEW digests of several rows are broadcast to the rows; beyond that
the rows are dealt by digest. If bytes and digests disagree on a group's size, the run fails.

Null counts as empty text. Of equal texts the row with the largest doc_id stays, a null doc_id only
where all are null; repeated doc_ids count as rows (group_size), and rows equal in doc_id and text
are all ``kept`` by op5 while ``without_copies`` keeps one of them. Very long texts are hashed where
they are; an empty table gives no rows; extra columns, whatever their names, are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import Scratch, lookup, quoted, unused
from weftline.llm.textcode import U, mix

#: Digests that one filter holds, about; the number of buckets follows the snapshot's size.
BUCKET = 50_000
#: Batches that the query deals the table into; the first is the snapshot.
BATCHES = 2
#: Digests of several rows that are broadcast at most (some 10 MB); more of them are dealt with the texts.
FEW = 100_000


# --- binary-fuse filter (three-wise, 8-bit fingerprints) ---


def _places(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The three places of each key in consecutive segments, and its 8-bit fingerprint."""
    h = mix(keys + U(seed) * U(0x9E3779B97F4A7C15))
    g = mix(h ^ U(0xA24BAED4963EE407))
    base = ((h >> U(32)) * U(count) >> U(32)) * U(segment)
    m = U(segment - 1)
    at = np.stack([base + (g & m), base + U(segment) + (g >> U(21) & m), base + U(2 * segment) + (g >> U(42) & m)], 1)
    return at.astype(np.int64), ((h ^ g) & U(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments that a key may start in, table) of a set of 64-bit keys.

    Peeling goes in rounds: every place that one remaining key alone touches gives that key up;
    the keys are then assigned in the reverse order.
    """
    keys = np.unique(keys)
    n = len(keys)
    segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    size = int(max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3))) * n) + 8
    for seed in range(1, 200):
        count = max(1, -(-size // segment) - 2) + seed // 20
        at, mark = _places(keys, seed, segment, count)
        places = (count + 2) * segment
        degree = np.bincount(at.ravel(), minlength=places)
        which = np.zeros(places, np.int64)  # xor of the keys at a place
        for j in range(3):
            np.bitwise_xor.at(which, at[:, j], np.arange(n))
        order: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        lone = np.flatnonzero(degree == 1)
        while len(lone):
            key, first = np.unique(which[lone], return_index=True)
            order.append((key, lone[first]))
            taken += len(key)
            spots = at[key].ravel()
            np.subtract.at(degree, spots, 1)
            np.bitwise_xor.at(which, spots, np.repeat(key, 3))
            spots = np.unique(spots)
            lone = spots[degree[spots] == 1]
        if taken == n:
            table = np.zeros(places, np.uint8)
            for key, spot in reversed(order):
                a = at[key]
                table[spot] = 0
                table[spot] = mark[key] ^ table[a[:, 0]] ^ table[a[:, 1]] ^ table[a[:, 2]]
            return seed, segment, count, table.tobytes()
    raise ValueError("no filter found; are the keys hashes?")


def may_hold(flt: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    """False only for keys that the set doesn't hold."""
    seed, segment, count, table = flt
    at, mark = _places(keys, seed, segment, count)
    table = np.frombuffer(table, np.uint8)
    return (table[at[:, 0]] ^ table[at[:, 1]] ^ table[at[:, 2]]) == mark


# --- snapshots ---


def digests(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(doc_id, digest): SHA-256 of the text's UTF-8 bytes, as binary."""
    return docs.select(F.col(ident).cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)).alias("digest"))


def _key64(digest) -> F.Column:
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


class Snapshot:
    """An immutable set of digests: exact buckets and one filter for each.

    Buckets are counted from the larger of the snapshot and what comes in, so neither crowds one.
    """

    def __init__(self, groups: DataFrame, scratch: Scratch, name: str = "snapshot", incoming: int = 0):
        """groups: a row per digest with any further columns."""
        self.buckets = max(1, -(-max(groups.count(), incoming) // BUCKET))
        self.exact = scratch.keep(groups.withColumn("bucket", self.bucket()).repartition("bucket"), name)

        def build(key: tuple, rows: pa.Table) -> pa.Table:
            seed, segment, count, table = build_filter(rows.column("key").to_numpy().view(np.uint64))
            return pa.table({"bucket": [key[0].as_py()], "seed": [seed], "segment": [segment], "count": [count], "bytes": pa.array([table], pa.binary())})

        keys = self.exact.select("bucket", _key64("digest").alias("key"))
        self.filters = scratch.keep(keys.groupBy("bucket").applyInArrow(build, "bucket long, seed long, segment long, count long, bytes binary"), f"{name}-filters")

    def bucket(self) -> F.Column:
        return F.pmod(F.conv(F.hex(F.substring("digest", 9, 4)), 16, 10).cast("long"), F.lit(self.buckets)).cast("long")

    def screen(self, groups: DataFrame) -> DataFrame:
        """``groups`` with ``maybe``: whether a digest passes its bucket's filter.

        A group is one row per digest, so a bucket has about as many rows however skewed the texts are.
        """
        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields)
        rows = groups.withColumn("bucket", self.bucket()).withColumn("key", _key64("digest"))

        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if right.num_rows:
                flt = tuple(right.column(c)[0].as_py() for c in ("seed", "segment", "count", "bytes"))
                maybe = may_hold(flt, left.column("key").to_numpy().view(np.uint64))
            else:
                maybe = np.zeros(left.num_rows, bool)
            return left.drop_columns(["bucket", "key"]).append_column("maybe", pa.array(maybe))

        return rows.groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInArrow(run, f"{kind}, maybe boolean")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest; the map side has combined copies before they are dealt."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))


def digest_groups(rows: DataFrame, scratch: Scratch, batches: int = BATCHES) -> DataFrame:
    """``digest, top, n`` of all rows (doc_id, digest), found batch by batch through the filters."""
    batch = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(batches))
    known = scratch.keep(_groups(rows.where(batch == 0)), "known0")
    for b in range(1, batches):
        come = scratch.keep(_groups(rows.where(batch == b)), f"batch{b}")
        snapshot = Snapshot(known, scratch, f"snapshot{b}", come.count())
        fresh = scratch.keep(snapshot.screen(come), f"screened{b}")
        # positives meet the exact buckets; negatives are groups of their own
        old = snapshot.exact.select("digest", "top", "n")
        hits = fresh.where("maybe").select("digest", F.col("top").alias("top2"), F.col("n").alias("n2"))
        met = old.join(hits, "digest", "full").select("digest", F.greatest("top", "top2").alias("top"), (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"))
        known = scratch.keep(met.unionByName(fresh.where("not maybe").select("digest", "top", "n")), f"known{b}")
        for name in (f"known{b - 1}", f"batch{b}", f"snapshot{b}", f"snapshot{b}-filters", f"screened{b}"):
            scratch.drop(name)
    return known


class Copies:
    """Groups of equal texts of a table, with the bytes of all that share a digest compared.

    rows: (doc_id, digest) of every row; known: (digest, top, n) of every digest; several: those
    of more than one row; clash: digests that hold two texts (None: there are none) with
    apart, the groups (digest, text, top, n) of these.
    """

    def __init__(self, docs: DataFrame, text: str, ident: str, batches: int = BATCHES):
        scratch = Scratch(docs.sparkSession, "exactdedup")
        self.rows = scratch.keep(digests(docs, text, ident), "digests")
        self.total = self.rows.count()
        self.known = digest_groups(self.rows, scratch, batches)
        self.several = scratch.keep(self.known.where("n > 1"), "several")
        self.few = self.several.count() <= FEW
        body = F.coalesce(F.col(text).cast("string"), F.lit(""))
        self.whole = docs.select(F.col(ident).cast("long").alias("doc_id"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("digest"))
        # copies meet within each task first, so a text with many copies is dealt once per task
        texts = self._of_several(self.whole).groupBy("digest", "text").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
        checked = scratch.keep(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("rows")), "checked")
        off = self.several.join(checked, "digest", "full").where("not (n <=> rows)")
        if not off.isEmpty():
            raise RuntimeError("the groups of digests do not agree with the texts: did the table change while it was read?")
        clash = checked.where("texts > 1").select("digest")
        self.clash = None if clash.isEmpty() else clash
        self.apart = texts.join(clash, "digest", "left_semi")

    def _of_several(self, rows: DataFrame) -> DataFrame:
        """The rows (with ``digest``) of more than one row's digest; alone ones are not moved."""
        keys = self.several.select("digest")
        return rows.join(F.broadcast(keys) if self.few else keys, "digest", "left_semi")


def duplicate_groups(docs: DataFrame, text: str = "text", ident: str = "doc_id", batches: int = BATCHES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, a row per row of docs."""
    found = Copies(docs, text, ident, batches)
    salt = F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")
    out = lookup(found.rows, found.known, "digest", salt, "n", found.total)
    if found.clash is not None:  # two texts of one SHA-256
        out = out.join(found.clash, "digest", "left_anti")
        rows = found.whole.join(found.clash, "digest", "left_semi")
        out = out.unionByName(rows.join(found.apart, ["digest", "text"]).select("doc_id", "digest", "top", "n"))
    kept = F.col("doc_id").eqNullSafe(F.col("top"))
    return out.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The rows of docs that stay; of rows equal in doc_id and text, one.

    Rows whose text is alone pass; only those that stay of the others are dealt.
    """
    found = Copies(docs, text, ident)
    own, mark, size = (unused(name, docs) for name in ("digest", "group", "size"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn(own, F.unhex(F.sha2(body, 256)))
    groups = found.several.select(F.col("digest").alias(own), F.struct("top").alias(mark), F.col("n").alias(size))
    if found.clash is not None:  # told apart by their text as well
        text_of = unused("text_of", docs)
        groups = groups.join(found.clash.select(F.col("digest").alias(own)), own, "left_anti")
        apart = found.apart.select(F.col("digest").alias(own), F.col("text").alias(text_of), F.struct("top").alias(mark), F.col("n").alias(size))
        some = rows.join(found.clash.select(F.col("digest").alias(own)), own, "left_semi").withColumn(text_of, body)
        told = some.join(apart, [own, text_of], "left").where(F.col(ident).cast("long").eqNullSafe(F.col(mark)["top"])).dropDuplicates([own, text_of])
        rows = rows.join(found.clash.select(F.col("digest").alias(own)), own, "left_anti")
    if found.few:
        rows = rows.join(F.broadcast(groups), own, "left")
    else:
        rows = lookup(rows, groups, own, F.encode(F.coalesce(F.col(ident).cast("string"), F.lit("")), "UTF-8"), size, found.total)
    stays = rows.where(F.col(mark).isNull()).select(*map(quoted, docs.columns))
    tops = rows.where(F.col(mark).isNotNull() & F.col(ident).cast("long").eqNullSafe(F.col(mark)["top"])).dropDuplicates([own])
    stays = stays.unionByName(tops.select(*map(quoted, docs.columns)))
    return stays if found.clash is None else stays.unionByName(told.select(*map(quoted, docs.columns)))


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All rows of ``documents``, nulls as empty text: a row for each, dropped ones too; an empty table gives none."""
    return duplicate_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
