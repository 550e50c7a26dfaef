"""Token ids on disk: canonical length-limited Huffman coding in independent blocks.

Format. A folder with two Parquet containers, written by Spark's committers so that a lost
executor leaves no half file: ``codebook`` (id, length) and ``blocks`` (shard, block, start,
tokens, data). ``data`` is one block: magic, version, numbers of documents, tokens and
checkpoints; then doc_ids (i64), a null flag (u8) and ids (u32) per document, bit offsets (u64)
of every 128th id, and the bit string in big-endian words. The codes follow from the lengths in the
codebook, so a block needs nothing else: any reader can decode it, or start at a checkpoint.
Shards and blocks ascend with doc_id; ``start`` counts ids within the shard.

Codes come from the counts of ids in the whole table. Null text is empty and has the end id
alone; rows with a null doc_id come first; repeated doc_ids are rows of their own, in the order
of their texts. An empty table gives an empty file and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import huffman
from weftline.llm.scratch import Scratch, in_order, small_batches
from weftline.llm.textcode import slices
from weftline.llm.tokens import encoder

#: Text bytes of a block, about; a document is never cut, so a long one makes a long block.
BLOCK = 2_000_000
END = 2
_HEAD = struct.Struct("<4sIQQQ")
_MAGIC = b"WTOK"


def write_block(doc_ids: np.ndarray, null: np.ndarray, sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    bits, marks = huffman.pack(ids, lengths, codes)
    head = _HEAD.pack(_MAGIC, 1, len(doc_ids), len(ids), len(marks))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), null.astype("u1").tobytes(), sizes.astype("<u4").tobytes(), marks.astype("<u8").tobytes(), bits])


def read_block(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, null flags, ids of each document, and all ids."""
    magic, version, docs, tokens, marks = _HEAD.unpack_from(data)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a block of this format")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    null = np.frombuffer(data, "u1", docs, at := at + 8 * docs)
    sizes = np.frombuffer(data, "<u4", docs, at := at + docs).astype(np.int64)
    offsets = np.frombuffer(data, "<u8", marks, at := at + 4 * docs).astype(np.int64)
    counts = np.full(marks, huffman.STEP, np.int64)
    if marks:
        counts[-1] = tokens - (marks - 1) * huffman.STEP
    return doc_ids, null, sizes, huffman.unpack(data[at + 8 * marks :], offsets, counts, table)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int = END, text: str = "text", ident: str = "doc_id") -> None:
    """Encode every text and write codebook and blocks, in ascending order of doc_id, into folder."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokenfile")
    small_batches(spark)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        enc.room = 2
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        total = np.zeros(1, np.int64)
        for batch in batches:
            for piece in slices(batch, "text", BLOCK):
                ids, sizes = enc.encode(piece.column("text"), end)
                doc_ids = piece.column("doc_id")
                row = {
                    "shard": [shard], "block": [block], "start": [start], "tokens": [len(ids)], "width": [enc.width],
                    "doc_ids": [doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes()], "nulls": [doc_ids.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes()],
                    "sizes": [sizes.astype("<u4").tobytes()], "ids": [ids.tobytes()],
                }
                block, start = block + 1, start + len(ids)
                yield pa.RecordBatch.from_pydict(row | {"used": [None], "counts": [None]}, schema=_DRAFT)
                c = np.bincount(ids)
                if len(c) > len(total):
                    c, total = total, c
                total[: len(c)] += c
        if block:  # last a row with the counts of the partition's ids
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({f: [None] for f in _DRAFT.names} | {"used": [used.astype("<i8").tobytes()], "counts": [total[used].astype("<i8").tobytes()]}, schema=_DRAFT)

    base = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = in_order(base, "doc_id", "text")
    draft = ordered.mapInArrow(tokens, "shard int, block int, start long, tokens long, width int, doc_ids binary, nulls binary, sizes binary, ids binary, used binary, counts binary")
    draft.write.option("compression", "none").parquet(scratch.path("draft"))
    draft = spark.read.schema(draft.schema).parquet(scratch.path("draft"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in zip(batch.column("used"), batch.column("counts")):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), "<i8")) for x in pair], ["id", "n"])

    # a row per id of the vocabulary at most
    counts = draft.where("used IS NOT NULL").select("used", "counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(max([r.id for r in counts], default=0) + 1, np.int64)
    for r in counts:
        seen[r.id] = r.n
    lengths = huffman.code_lengths(seen)
    book = spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, length int")
    book.coalesce(1).write.parquet(f"{folder}/codebook")
    sent = spark.sparkContext.broadcast(lengths)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sent.value
        codes = huffman.canonical(size)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                doc_ids, null, sizes = (np.frombuffer(row[c].as_buffer(), k) for c, k in (("doc_ids", "<i8"), ("nulls", "u1"), ("sizes", "<u4")))
                data = write_block(doc_ids, null, sizes, np.frombuffer(row["ids"].as_buffer(), f"<u{row['width'].as_py()}"), size, codes)
                yield pa.RecordBatch.from_pydict({c: [row[c].as_py()] for c in ("shard", "block", "start", "tokens")} | {"data": [data]}, schema=_BLOCKS)

    coded = draft.where("used IS NULL").drop("used", "counts").mapInArrow(code, "shard int, block int, start long, tokens long, data binary")
    coded.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    scratch.drop("draft")


_DRAFT = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.binary()), ("nulls", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()), ("used", pa.binary()), ("counts", pa.binary())])
_BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("tokens", pa.int64()), ("data", pa.binary())])


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids array<int>``) of every document in the file."""
    book = spark.read.schema("id int, length int").parquet(f"{folder}/codebook").collect()  # as large as the vocabulary
    lengths = np.zeros(max([r.id for r in book], default=0) + 1, np.uint8)
    for r in book:
        lengths[r.id] = r.length
    sent = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.schema("shard int, block int, start long, tokens long, data binary").parquet(f"{folder}/blocks")
    # one total for each partition that wrote
    totals = {r.shard: r.n for r in blocks.groupBy("shard").agg(F.sum("tokens").alias("n")).collect()}
    before, run = {}, 0
    for shard in sorted(totals):
        before[shard], run = run, run + totals[shard]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decode_table(sent.value)
        for batch in batches:
            for shard, start, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "start", "data"))):
                doc_ids, null, sizes, ids = read_block(data, table)
                end = np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((end - sizes).tolist(), end.tolist())]
                cols = [pa.array(doc_ids, mask=null.astype(bool)), pa.array(end - sizes + start + before[shard]), pa.array(sizes), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(np.concatenate([[0], end]).astype(np.int32), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return blocks.select("shard", "start", "data").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op3_token_file(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, nulls as empty text, written and read back: a row for each; an empty table gives none."""
    folder = Scratch(spark, "tokens").path("file")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, folder)
