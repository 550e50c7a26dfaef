import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from weftline.llm import repeats
from weftline.llm.rlbwt import RunIndex


@pytest.mark.parametrize("seed", range(8))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(12)]
    strings += [strings[0], strings[3] + strings[4], b"a" * 40, b"a" * 25]
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), 64)
    got = index.statistics()
    for i, s in enumerate(strings):
        for a in range(len(s)):
            best = 0
            for j, t in enumerate(strings):
                for b in range(len(t)):
                    if (i, a) != (j, b):
                        k = 0
                        while a + k < len(s) and b + k < len(t) and s[a + k] == t[b + k]:
                            k += 1
                        best = max(best, k)
            assert got[index.first[i] + a] == best
    assert index.runs < len(index.text)


def brute(docs):
    n = repeats.LENGTH
    raw = [(t or "").encode() for _, t in docs]
    count = Counter(r[p : p + n] for r in raw for p in range(len(r) - n + 1))
    out = []
    for (d, _), r in zip(docs, raw):
        gone = bytearray(len(r))
        for p in range(len(r) - n + 1):
            if count[r[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(30, 90)) for _ in range(6)]
    docs = []
    for i in range(70):
        t = text(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 120)
            t += s[a : a + rng.randint(150, 400)] + text(rng.randint(0, 30))
        docs.append((i, t))
    docs += [(100, docs[5][1]), (101, docs[5][1]), (102, None), (103, ""), (104, "x" * 1500), (105, "ab " * 300), (106, "y" * 199), (107, "z" * 200), (108, "w" * 201), (109, shared[0] * 3)]
    for i in range(12):  # near copies
        t = docs[7 + i][1]
        p = rng.randrange(max(1, len(t)))
        docs.append((200 + i, t[:p] + "#" + t[p + 1 :]))
    return docs


@pytest.mark.parametrize("seed,hot,index", [(1, 20_000, 3_000_000), (2, 20_000, 4_000), (3, 3, 3_000_000), (4, 0, 3_000_000)])
def test_matches_brute_force(spark, seed, hot, index, monkeypatch):
    docs = corpus(seed)
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "INDEX_BYTES", index)
    got = repeats.without_repeats(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as lo", "'x' as open"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_repeated_and_null_ids(spark):
    docs = [(1, "a" * 250), (1, "b" * 150 + "c" * 100), (None, "b" * 150 + "c" * 100), (None, None)]
    got = repeats.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_kinds_over_batches(size):
    """Batches of any size give what all rows at once give."""
    rng = random.Random(size)
    rows = sorted((rng.randint(0, 12), rng.choice([0, 0, 1, 2]), rng.choice([1, 1, 2])) for _ in range(120))
    cols = [np.array(x, np.int64) for x in (range(120), [r[0] for r in rows], [r[1] for r in rows], [0] * 120, range(120), range(120), [r[2] for r in rows])]
    got = [tuple(r.values()) for b in repeats.classify(iter([repeats._items([c[i : i + size] for c in cols]) for i in range(0, 120, size)])) for r in b.to_pylist()]
    settled, open_ = {g[0] for g in got if g[6] == 0}, sorted((g[1], g[2]) for g in got if g[6] == 1)
    total, kinds = Counter(), {}
    for k, v, n in rows:
        total[k, v] += n
        kinds.setdefault(k, set()).add(v)
    assert settled == {i for i, (k, v, n) in enumerate(rows) if n == 1 and total[k, v] > 1}
    assert open_ == sorted(x for x in total if len(kinds[x[0]]) > 1)
    assert len(got) == len(settled) + len(open_)


def test_very_long_text(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    docs = [(1, long + long[100:900]), (2, "x" + long[30_000:31_000])]
    got = repeats.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)
