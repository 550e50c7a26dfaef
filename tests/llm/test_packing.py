import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import packing


def pad(n, most):
    return 0 if n & (n - 1) == 0 else most - n


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_cheapest(seed):
    rng = random.Random(seed)
    most = 16
    place = [0]
    while len(place) < 60:
        place.append(place[-1] + rng.randint(1, most))
    pen = [0] + [rng.choice([0, 2, 5]) for _ in place[1:]]
    best = [0.0] + [None] * (len(place) - 1)
    for i in range(1, len(place)):
        best[i] = pen[i] + min(best[j] + pad(place[i] - place[j], most) for j in range(i) if place[i] - place[j] <= most)
    got = packing.best_cuts(np.array(place), np.array(pen), most)
    assert got[0] == 0 and got[-1] == len(place) - 1
    assert sum(pad(place[b] - place[a], most) + pen[b] for a, b in zip(got, got[1:])) == best[-1]


@pytest.mark.parametrize("most,horizon", [(2048, 400_000), (64, 500)])
def test_every_id_in_one_piece(spark, most, horizon, monkeypatch):
    monkeypatch.setattr(packing.Packer.__init__, "__defaults__", (most, horizon))
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the.", "Zebra", "été", "why?", "x"]) for _ in range(rng.randint(0, 900)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "endless " * 9000), (3, "again"), (3, "again")]
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), path, most=most).collect()
    t = Tokenizer.from_file(path)
    want = {}
    for d, x in sorted(rows, key=lambda r: r[1] or ""):
        want.setdefault(d, []).append([*t.encode(x or "", add_special_tokens=False).ids, 1])
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    for d, lists in want.items():
        ps = sorted(pieces[d], key=lambda r: (r.sequence_id, r.offset))
        ids, i = sum(lists, []), 0
        at, own = 0, iter(lists)
        cur = next(own)
        for p in ps:
            if at == len(cur):
                cur, at = next(own), 0
            assert p.start == at and p.doc_tokens == len(cur)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[i : i + p.length], "<u4").tobytes())
            at, i = at + p.length, i + p.length
        assert i == len(ids)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    waste = 0
    for s in seqs.values():
        s.sort()
        assert all(o == sum(n for _, n in s[:k]) for k, (o, _) in enumerate(s))
        n = sum(x for _, x in s)
        assert n <= most
        waste += pad(n, most)
    total = sum(len(x) for v in want.values() for x in v)
    assert waste <= 0.03 * total + 4 * most  # (a piece of the table per partition ends unweighed)


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_texts_are_read_a_few_rows_at_once(spark):
    """Executors' heap grew with the reader's 4096 rows of whole texts."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.set(name, 4096)
    packing.packed(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
    assert int(spark.conf.get(name)) == 256
    spark.conf.set(name, 100)  # a lower one stays
    packing.packed(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
    assert int(spark.conf.get(name)) == 100
    spark.conf.unset(name)
