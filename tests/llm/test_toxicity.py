import random

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import toxicity as tx


def text(rng, n, stems=0):
    words = ["".join(rng.choice(["ba", "re", "ti", "on", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(stems):
        words[rng.randrange(n)] = rng.choice(["zorgu", "krezz"]) + rng.choice(["", "ti", "on", "ré"])
    return " ".join(words)


def sample(seed, n=400):
    rng = random.Random(seed)
    label = np.array([int(rng.random() < 0.3) for _ in range(n)])
    return [text(rng, rng.randint(20, 200), 3 * int(y)) for y in label], label


def test_gradients():
    rng = random.Random(0)
    t = tx._text([text(rng, 9), text(rng, 4), text(rng, 1), text(rng, 70)])
    net = tx.Network(np.sort(t.hash[::2]))
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    some = np.array([2, 0, 1, 4, 3])[: len(t.text)]
    down = np.linspace(-1, 1, len(some))
    cache = {}
    net.forward(t, some, cache)
    grad = net.backward(cache, down)
    for k, g in grad.items():
        x = net.p[k]
        for i in np.argsort(-np.abs(g).ravel())[:3]:
            at = np.unravel_index(i, x.shape)
            keep, e = x[at], 1e-3
            x[at] = keep + e
            hi = float(net.forward(t, some, {}).astype(np.float64) @ down)
            x[at] = keep - e
            lo = float(net.forward(t, some, {}).astype(np.float64) @ down)
            x[at] = keep
            assert abs((hi - lo) / (2 * e) - g[at]) < 2e-2 * max(0.05, abs(g[at])), k


def test_windows_cover_every_word():
    rng = random.Random(1)
    t = tx._text([text(rng, n) for n in (1, 63, 64, 65, 112, 113, 300)] + ["", "..."])
    for i in range(9):
        seen = set()
        for s, n in zip(t.start[t.text == i], t.size[t.text == i]):
            assert n <= tx.WINDOW
            seen.update(range(s, s + n))
        assert seen == set(range(t.first[i], t.first[i + 1]))


def test_unseen_texts():
    net = tx.fit_texts(*sample(1))
    texts, label = sample(2, 300)
    score = net.score(pa.array(texts))
    assert ((score >= tx.THRESHOLD) == label).mean() > 0.97
    assert net.score(pa.array([None, "", "--"])).tolist() == [0, 0, 0]
    one = np.array([net.score(pa.array([t]))[0] for t in texts[:20]])
    assert np.allclose(one, score[:20], atol=1e-5)


def test_query_shape(spark):
    texts, label = sample(3, 200)
    docs = spark.createDataFrame([(i, t, 0.1) for i, t in enumerate(texts)] + [(900, None, 0.2), (0, texts[0], 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(label)] + [(0, 1, int(label[0])), (5000, 0, 1), (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = tx.scored(docs, tx.train(docs, labels)).collect()
    assert len(got) == 202 and all(0 <= r.score <= 1 for r in got)
    none = tx.scored(docs, tx.train(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.0}
    assert tx.scored(docs.limit(0), tx.train(docs.limit(0), labels)).count() == 0


def test_curve_and_windows_come_from_whole_texts(spark, monkeypatch):
    """Toxic words stand anywhere in long texts: they are found, and the curve sees highest windows of whole texts."""
    rng = random.Random(5)
    label = np.array([int(rng.random() < 0.3) for _ in range(300)])
    texts = [text(rng, rng.randint(20, 700)) + " " + text(rng, 20, 4 * int(y)) + " " + text(rng, rng.randint(1, 700)) for y in label]
    seen = []
    curve = tx.Network.calibrate
    monkeypatch.setattr(tx.Network, "calibrate", lambda net, x, y, prior: seen.append((x, y)) or curve(net, x, y, prior))
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, h int, y string")
    net = tx.train(docs, spark.createDataFrame([(i, int(y)) for i, y in enumerate(label)], "doc_id long, toxic int"))
    (x, y), = seen
    high = net.highest(tx._text(texts))
    for v in (0, 1):
        assert all(np.abs(high[label == v] - a).min() < 1e-3 for a in x[y == v])
    assert ((net.score(pa.array(texts)) >= tx.THRESHOLD) == label).mean() > 0.95


@pytest.mark.parametrize("same", [False, True])
def test_sample_is_bounded(spark, monkeypatch, same):
    """One doc_id on very many rows is one label and at most ``negative`` texts; no row is collected whole."""
    seen = []
    monkeypatch.setattr(tx, "fit", lambda draw, highest, prior: seen.append(draw(None, 0)) or tx.Network(np.zeros(0, np.uint64)))
    rows = [(3, "one text" if same else f"text number {i} " + "word " * 300) for i in range(3000)] + [(i, f"other {i}") for i in range(100, 160)]
    labels = [(3, 0), (3, 0), *((i, i % 2) for i in range(100, 160))]
    tx.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), positive=10, negative=50)
    (windows, target), = seen
    assert len(windows) <= tx.EACH * 60 and target.sum() <= 10


def plain(net, raw):
    """The score by loops over windows, words and states, apart from the array code."""
    from weftline.llm.textcode import column_bytes, span_hashes

    p = {k: x.astype(float) for k, x in net.p.items()}
    low = bytes(tx._TABLE[c] for c in raw.encode())
    words = low.split()
    sig = lambda x: 1 / (1 + np.exp(-x))

    def enter(w):
        marked, rows = b"<" + w + b">", []
        for k in (3, 5):
            for i in range(len(marked) - k + 1):
                h = k
                for c in marked[i : i + k]:
                    h = (h * int(tx._GRAM[0]) + c) % 2**64
                rows.append(p["char"][(h * int(tx._GRAM[1]) % 2**64) >> (64 - (tx.CHAR_BUCKETS.bit_length() - 1))])
        data, off = column_bytes(pa.array([w.decode()]))
        own = np.flatnonzero(net.vocabulary == span_hashes(data, off[:1], off[1:])[0])
        return np.concatenate([p["word"][own[0] + 1 if len(own) else 0], np.mean(rows, 0)])

    best = -np.inf
    starts = [0]
    while starts[-1] + tx.WINDOW < len(words):
        starts.append(starts[-1] + tx.STRIDE)
    for a in starts:
        xs = [enter(w) for w in words[a : a + tx.WINDOW]]
        ways = []
        for way, seq in (("f", xs), ("b", xs[::-1])):
            h, out = np.zeros(tx.HIDDEN), []
            for x in seq:
                i, g = x @ p["x" + way] + p["c" + way], h @ p["u" + way]
                z, r = sig(i[: tx.HIDDEN] + g[: tx.HIDDEN]), sig(i[tx.HIDDEN : 2 * tx.HIDDEN] + g[tx.HIDDEN : 2 * tx.HIDDEN])
                new = np.tanh(i[2 * tx.HIDDEN :] + r * g[2 * tx.HIDDEN :])
                h = new + z * (h - new)
                out.append(h)
            ways.append(out if way == "f" else out[::-1])
        states = np.concatenate(ways, 1)
        e = np.exp(np.tanh(states @ p["a"] + p["ac"]) @ p["v"])
        best = max(best, float((e / e.sum()) @ states @ p["o"] + p["oc"][0]))
    return 1 / (1 + np.exp(-(net.slope * np.clip(best, -30, 30) + net.shift)))


def test_equals_plain_scorer():
    net = tx.fit_texts(*sample(1, 200))
    texts = [x for x in sample(4, 12)[0]] + ["Zorguti", "a b c " * 70, "é"]
    assert np.allclose(net.score(pa.array(texts)), [plain(net, x) for x in texts], atol=2e-3)


def test_curve_of_parted_logits():
    """Where logits part the labels, the curve's threshold lies between them, also far from zero."""
    rng = np.random.default_rng(6)
    for low, high in ((6.17, 7.31), (4.6, 7.5), (-9.0, -8.2), (20.0, 21.0)):
        x = np.concatenate([low - rng.exponential(1.5, 60), [low], high + rng.exponential(0.3, 25), [high]])
        label = np.arange(len(x)) > 60
        net = tx.Network(np.zeros(0, np.uint64))
        net.calibrate(x, label, float(label.mean()))
        score = 1 / (1 + np.exp(-(net.slope * x + net.shift)))
        assert ((score >= tx.THRESHOLD) == label).all(), (low, high)
