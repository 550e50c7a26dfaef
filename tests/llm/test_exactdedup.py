import hashlib
import random

import numpy as np
import pytest

from weftline.llm import exactdedup as ed


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 60_000])
def test_filter_has_no_false_negatives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n, dtype=np.uint64)
    flt = ed.build_filter(keys)
    assert ed.may_hold(flt, keys).all()
    others = rng.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    assert ed.may_hold(flt, others).mean() < 0.02


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_groups(spark, batches):
    rng = random.Random(batches)
    texts = [None, "", "a", "A", "a ", "é", "x" * 100_000, *(f"t{i}" for i in range(20))]
    rows = [(i * 7 % 301, rng.choice(texts), 5) for i in range(200)] + [(0, "a", 5), (0, "a", 5)]
    got = ed.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string, n long"), batches=batches).collect()
    want = []
    for i, t, _ in rows:
        same = [j for j, u, _ in rows if (u or "") == (t or "")]
        want.append((i, max(same), len(same), i == max(same), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty(spark):
    assert ed.duplicate_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
