import random

import numpy as np
import xxhash
import pytest

from weftline.llm import simhash
from weftline.llm.textcode import column_bytes
import pyarrow as pa
import re


def brute(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = [None, "", " \t\n", "one", "one Two", "A b\tc\nd", "x\x1cy z", "É é ẞ ß  Ab", " ".join(str(i % 91) for i in range(3000)), "a b c", "A  B\x0bC"]


def test_fingerprints_match_definition():
    got = simhash.fingerprints(*column_bytes(pa.array(TEXTS)))
    assert [int(x) for x in got] == [brute(t) for t in TEXTS]


def test_golay_keys_meet_within_three_errors():
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(300)]
    near = [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for f in fps]
    of, key, filed = simhash.keys(np.array(fps, np.uint64))
    of2, key2, filed2 = simhash.keys(np.array(near, np.uint64))
    for i in range(300):
        assert set(key[(of == i) & filed]) & set(key2[(of2 == i) & ~filed2])


def brute_components(ids, fps):
    n = len(ids)
    best = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if bin(fps[i] ^ fps[j]).count("1") <= 3 and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


@pytest.mark.parametrize("block", [20_000, 5])
def test_components_match_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 9)) for _ in range(120)) for _ in range(8)]
    texts = list(TEXTS)
    for b in base:
        for _ in range(8):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    rows = [(100 - i, t, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string")).collect()}
    ids, fps = [r[0] for r in rows], [brute(r[1]) for r in rows]
    assert {i: got[i].fingerprint for i in ids} == {i: f"{f:016x}" for i, f in zip(ids, fps)}
    assert {i: got[i].component_id for i in ids} == dict(zip(ids, brute_components(ids, fps)))


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_spanning_of_many():
    rng = np.random.default_rng(0)
    fp = np.unique(np.concatenate([rng.integers(0, 2**63, 50, dtype=np.uint64) ^ np.uint64(1 << b) for b in range(4)]))
    pairs = list(simhash.spanning(fp))
    assert all(bin(int(fp[a] ^ fp[b])).count("1") <= 3 for a, b in pairs)
