"""Counterparts in blocks against SQL, on copies, nulls and vectors without a direction."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.oracle import compare
from weftline.operators import similarity
from weftline.plans import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def both(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    return compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], str(folder))


@pytest.mark.parametrize("name", ["analogy_candidates", "analogy_pair_dedup"])
def test_blocks_equal_sql(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(similarity, "BLOCK", 40)
    made = np.random.default_rng(3).normal(size=(400, 6)).astype(np.float32)
    made[50:200] = made[50]  # more copies than a source may have counterparts
    made[200:210] *= 2
    rows = [(i, x, int(i % 5 == 0)) for i, x in enumerate(made.tolist())]
    rows += [(400, None, 0), (401, [0.0] * 6, 1), (402, [float("nan")] * 6, 1), (403, made[50].tolist(), None), (None, made[50].tolist(), 0), (-7, made[50].tolist(), 0)]
    assert both(spark, tmp_path, rows, name) > 5000


def test_null_is_the_largest_model(spark, tmp_path):
    rows = [(None, [1.0, 0.0], 0)] * 3 + [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0)]
    assert both(spark, tmp_path, rows, "analogy_candidates") == 0


def test_best_of_two_blocks():
    """More sources than a strip, any ids, a floor that all reach."""
    rng = np.random.default_rng(4)
    v, w = rng.normal(size=(300, 5)), rng.normal(size=(120, 5))
    w[60:] = w[:60]
    names = [f"d{i:03}" for i in rng.permutation(120)]
    a = pa.table({"role": ["r"] * 300, "src": range(300), "src_model": ["x"] * 299 + [None], "_a": v.tolist()})
    b = pa.table({"role": ["r"] * 120, "dst": names, "dst_model": ["y"] * 119 + ["x"], "_b": w.tolist()})
    cos = (v @ w.T) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(w, axis=1))
    want = {(s, d) for s in range(299) for _, d in sorted((-round(cos[s, j], 9), names[j]) for j in range(119))[:7]}
    got = similarity.nearest_of(a, b, -1.0, 7)
    assert set(zip(got["src"].to_pylist(), got["dst"].to_pylist())) == want and len(got) == 299 * 7
    assert similarity.nearest_of(a, b, 2.0, 7).num_rows == similarity.nearest_of(a, b[:0], 0, 7).num_rows == similarity.nearest_of(a[:0], b, 0, 7).num_rows == 0


def test_capped_pairs_have_a_cosine(spark, tmp_path):
    """Taken strongest first; vectors without a direction neither are ends nor use up a source's list."""
    made = np.random.default_rng(5).normal(size=(90, 4)).astype(np.float32).tolist()
    odd = [(1000 + 3 * i, [float("nan") if i % 2 else 0.0] * 4, 0) for i in range(60)]
    rows = [(3 * i + i % 2, x, i % 3) for i, x in enumerate(made)]
    spark.createDataFrame(rows + odd, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.src, r.dst): r.cosine for r in queries.QUERIES["analogy_capped"](spark, str(tmp_path)).collect()}
    pairs = []
    for s, v, role in rows:  # with the odd rows model 1 is the largest
        near = [(d, float(np.dot(np.float64(v), np.float64(w)) / np.linalg.norm(np.float64(v)) / np.linalg.norm(np.float64(w)))) for d, w, r in rows if r == role and d % 3 != s % 3]
        pairs += [(-c, s, d) for d, c in sorted(near, key=lambda x: -x[1])[:50] if c >= 0.3] if s % 3 == 0 else []
    out, into, want = {}, {}, {}
    for c, s, d in sorted(pairs):
        if out.get(s, 0) < 3 and into.get(d, 0) < 2:
            out[s], into[d], want[s, d] = out.get(s, 0) + 1, into.get(d, 0) + 1, -c
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_few_lists_of_a_source(spark, monkeypatch):
    """Targets of a block are more than its sources: fewer lists of each source are dealt and ranked."""
    monkeypatch.setattr(similarity, "BLOCK", 40)
    rows = [("r", i, x) for i, x in enumerate(np.random.default_rng(6).normal(size=(150, 4)).tolist())]
    a = spark.createDataFrame([(r, i, "x", v) for r, i, v in rows[:50]], "role string, src long, src_model string, _a array<double>")
    b = spark.createDataFrame([(r, i, "y", v) for r, i, v in rows], "role string, dst long, dst_model string, _b array<double>")
    assert similarity.nearest_in_blocks(a, b, -1.0, 5).count() == 50 * 5


def test_closer_than_single_precision():
    """What the matrix product can't tell apart is told apart by the exact sums."""
    rng = np.random.default_rng(7)
    angle = 0.3 + 1e-9 * rng.permutation(500)
    b = pa.table({"role": ["r"] * 500, "dst": range(500), "dst_model": ["y"] * 500, "_b": np.column_stack([np.cos(angle), np.sin(angle), np.zeros(500)]).tolist()})
    a = pa.table({"role": ["r"], "src": [0], "src_model": ["x"], "_a": [[2.0, 0.0, 0.0]]})
    got = similarity.nearest_of(a, b, 0.5, 9)
    assert got["dst"].to_pylist() == np.argsort(angle)[:9].tolist()
    floor = float(np.cos(angle[np.argsort(angle)[4]])) - 1e-12
    assert len(similarity.nearest_of(a, b, floor, 9)) == 5
