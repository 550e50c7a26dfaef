import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import huffman, tokenfile


def optimal_cost(counts, limit):
    """Cost of the best length-limited code by plain package-merge over lists of symbols."""
    items = sorted((c, (i,)) for i, c in enumerate(counts) if c)
    if len(items) == 1:
        return items[0][0]
    merged = []
    for _ in range(limit):
        pairs = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(merged[::2], merged[1::2])]
        merged = sorted(items + pairs)
    return sum(c for c, _ in merged[: 2 * len(items) - 2])


@pytest.mark.parametrize("n,limit", [(1, 3), (2, 1), (2, 4), (5, 3), (8, 3), (40, 6), (40, 18), (300, 9)])
def test_lengths_are_optimal(n, limit):
    rng = random.Random(n)
    counts = np.array([int(rng.paretovariate(0.5)) for _ in range(n)], np.int64)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths) <= 1
    assert int((lengths * counts).sum()) == optimal_cost(counts.tolist(), limit)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=3))
    bits, marks = huffman.pack(ids, lengths, huffman.canonical(lengths))
    counts = np.minimum(huffman.STEP, n - np.arange(len(marks)) * huffman.STEP)
    assert huffman.unpack(bits, marks, counts, huffman.decode_table(lengths)).tolist() == ids.tolist()


def test_file_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK", 700)
    rng = random.Random(2)
    rows = [(i * 3 % 97, " ".join(rng.choice(["the", "Zebra", "été", "\n", "x,"]) for _ in range(rng.randint(0, 90))), 1) for i in range(97)]
    rows += [(200, None, 1), (201, "", 1), (None, "null id", 1), (5, "again", 1), (5, "again", 1), (300, "long " * 5000, 1)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = f"file://{tmp_path}/tokens"
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, start int"), folder, path)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in tokenfile.read_tokens(spark, folder, True).collect())
    t = Tokenizer.from_file(path)
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(order)
    for (d, x, _), g in zip(order, got):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        assert g == (at, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)


def test_empty(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenfile.read_tokens(spark, folder).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3001])
def test_bits_are_those_of_single_codes(n):
    """Two codes are joined before they are placed; the bit string and its marks are those of one at a time."""
    rng = np.random.default_rng(n + 1)
    lengths = huffman.code_lengths(np.array([2 ** (30 - min(i, 30)) for i in range(40)], np.int64))
    codes, ids = huffman.canonical(lengths), rng.integers(0, 40, n)
    assert lengths.max() == huffman.LIMIT
    text = [f"{int(codes[i]):0{int(lengths[i])}b}" for i in ids]
    bits, marks = huffman.pack(ids, lengths, codes)
    got = "".join(f"{b:08b}" for b in bits)
    assert got.startswith("".join(text)) and "1" not in got[sum(map(len, text)) :]
    assert marks.tolist() == [sum(map(len, text[:k])) for k in range(0, n, huffman.STEP)]


def test_ids_are_counted_as_they_are_encoded(spark, tmp_path, monkeypatch):
    """The draft has the counts of its ids, so ids are read again for coding only."""
    kept = []
    monkeypatch.setattr(tokenfile.Scratch, "drop", lambda self, name: kept.append(self.path(name)))
    rows = [(i, None if i % 5 == 0 else f"word{i % 3} of a text " * (i % 4)) for i in range(40)]
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path), public_tokenizers.path("byte_bpe_50k.json"))
    ids, counts = [], {}
    for r in spark.read.parquet(kept[0]).collect():
        ids += np.frombuffer(r.ids, f"<u{r.width}").tolist() if r.used is None else []
        for i, n in zip(np.frombuffer(r.used or b"", "<i8").tolist(), np.frombuffer(r.counts or b"", "<i8").tolist()):
            counts[i] = counts.get(i, 0) + n
    assert counts == {i: ids.count(i) for i in ids} and counts[tokenfile.END] == 40
    assert len(tokenfile.read_tokens(spark, str(tmp_path)).collect()) == 40
