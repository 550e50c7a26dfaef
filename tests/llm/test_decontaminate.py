import hashlib
import random
import re

import pytest

from weftline.llm import decontaminate as dc


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for a in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[a : a + k]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if (s := wins.get(tuple(w[a : a + k]))) is not None:
                    hit.update(range(a, a + k))
                    found |= s
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def case(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ça", "été", "x1", "B", "zz", "q"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "\n", "&&&"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 30))) for i in range(30)] + [(30, None), (31, "..."), (5, "again the same id and ten words are in here now"), (None, "a null id with more than ten words in one single long row")]
    docs = []
    for i in range(60):
        t = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            t += " " + (rng.choice(items)[1] or "")[rng.randint(0, 10) :] + " " + text(rng.randint(0, 12))
        docs.append((i, t))
    docs += [(60, None), (61, ""), (62, "--"), (0, docs[0][1]), (63, items[-1][1].upper())]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 10**7), (2, 10**7), (3, 500)])
def test_matches_brute_force(spark, seed, block):
    docs, items = case(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, dc.contamination(d, b, block_bytes=block).collect())) == brute(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in dc.contamination(d, none).collect()] == [(1, 2, 0, 0)]
    assert dc.contamination(d.limit(0), none).count() == 0


def test_long_and_repeated_items(spark, monkeypatch):
    """Long items are cut without losing a window, copies of one row count once, and no block is larger than stated."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xyz") * rng.randint(0, 3) for _ in range(n))
    items = [(i, text(rng.choice([3, 12, 400]))) for i in range(20)] + [(99, text(30))] * 500
    docs = [(i, text(20) + " " + rng.choice(items)[1][-rng.randint(30, 900) :] + " " + text(20)) for i in range(40)]
    found = dc.blocks_of(spark.createDataFrame(items, "item_id long, text string"), dc.Scratch(spark, "test"), 600)
    seen = [sum(len(t.encode()) + len(i) + 64 for i, t in block) for block in found]
    assert len(seen) > 5 and max(seen) <= 600
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert sorted(map(tuple, dc.contamination(d, b, block_bytes=4000).collect())) == want
    kept = {r.doc_id for r in dc.decontaminated(d, b, block_bytes=4000).collect()}
    assert kept == {w[0] for w in want if not w[-1]}


def test_windows_of_one_hash(monkeypatch):
    """Windows that share a hash stay apart."""
    monkeypatch.setattr(dc.Words, "grams", lambda self, k: (lambda g: (g * 0 + 7, __import__("numpy").arange(len(g)) + k <= self.last[: len(g)]))(dc.grams(self.hash, k)))
    one, two = " ".join("abcdefghij"), " ".join("klmnopqrst")
    index = dc.Index([one, two], ["1", "2"])
    w = dc.Words(*dc.column_bytes(dc.pa.array([two + " z", "z " + one, "z"])))
    hit, items = index.hits(w)
    assert items == {0: {"2"}, 1: {"1"}} and hit.sum() == 20
