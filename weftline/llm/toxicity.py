"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text's lower-cased words are covered by overlapping windows of WINDOW words, STRIDE apart. A
word enters as its own embedding (words of the training sample's vocabulary) beside the mean of
hashed embeddings of its byte 3- and 5-grams, so unknown forms of a known stem are recognised.
Two gated recurrent passes, attention over their states and a linear layer score each window;
a text's score is that of its highest window through a logistic curve fitted on a part of the
sample that training doesn't see.

Labels belong to texts, so windows have to be found that bear them out. Executors draw EACH windows
of every sampled text, from its whole length: at random at first, later the one that the network
so far finds the likeliest beside others at random, of a positive text only such as it finds
likely. Only these windows reach the driver; the curve is fitted to highest windows of whole texts.

The sample is the only bound of the fit: at most POSITIVE and NEGATIVE labelled texts. Copies of
one doc_id and text count once; of two labels of one doc_id the greater holds.

Every window of every whole text is scored. Texts without words (null, empty) score 0. Repeated
rows score alike; null labels and null doc_ids are not learnt from; without labels of both kinds
all scores are the share of positives. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.langid import held_out
from weftline.llm.scratch import Scratch, parts, small_batches
from weftline.llm.textcode import U, column_bytes, constants, lower_table, ranges, slices, span_hashes, word_spans

WINDOW, STRIDE = 64, 48
HIDDEN, ATTENTION, WORD_DIM, CHAR_DIM = 8, 8, 8, 16
CHAR_BUCKETS = 1 << 15
#: Words kept as such, and in how many training windows a word must be for that.
VOCABULARY, SEEN = 4096, 8
#: The model is fitted on at most so many labelled texts of either kind.
POSITIVE, NEGATIVE = 1200, 3600
CALIBRATION = 0.2
#: Windows whose arrays are made at once.
PART = 1600
#: Windows of one text that train at a time, and how often they are drawn.
EACH, DRAWS = 4, 8
EPOCHS, BATCH, RATE, DECAY = 5, 128, 0.01, 1e-5
#: A small sample is gone over until so many steps are made.
STEPS = 250
THRESHOLD = 0.3
_WORD = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TABLE = lower_table(word=_WORD)
_GRAM = constants(6, 41)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


class Text:
    """Words of many texts: which distinct word stands at each place, and its character grams."""

    def __init__(self, data: np.ndarray, off: np.ndarray, window: int = WINDOW, stride: int = STRIDE):
        flat, start, end, self.first = word_spans(data, off, _TABLE)
        self.flat, self.begin, self.stop = flat, start, end
        self.hash, lead, self.word = np.unique(span_hashes(flat, start, end), return_index=True, return_inverse=True)
        start, end = start[lead], end[lead]
        # distinct words between marks, one after another
        size = end - start + 2
        at = np.concatenate([[0], np.cumsum(size)])
        buf = np.full(at[-1] + 5, 60, np.uint64)
        buf[at[1:] - 1] = 62
        buf[ranges(at[:-1] + 1, size - 2)] = flat[ranges(start, size - 2)]
        place = np.arange(at[-1])
        stop = np.repeat(at[1:], size)
        of = np.repeat(np.arange(len(size)), size)
        grams, owner = [], []
        for k in (3, 5):
            ok = place + k <= stop
            p = place[ok]
            h = np.full(len(p), k, np.uint64)
            for j in range(k):
                h = h * _GRAM[0] + buf[p + j]
            grams.append(h * _GRAM[1] >> U(64 - (CHAR_BUCKETS.bit_length() - 1)))
            owner.append(of[ok])
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        self.grams = np.concatenate(grams).astype(np.int64)[order]
        self.gram_first = np.searchsorted(owner[order], np.arange(len(size) + 1))
        # windows of each text: the last one ends where the text does
        n = np.diff(self.first)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - window) // stride)), 0)
        self.text = np.repeat(np.arange(len(n)), count)
        self.start = np.repeat(self.first[:-1], count) + stride * ranges(np.zeros(len(n), np.int64), count)
        self.size = np.minimum(window, np.repeat(self.first[1:], count) - self.start)

    def strings(self, some: np.ndarray) -> list[str]:
        """The words of these windows, as text."""
        raw = self.flat.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.begin[self.start[some]].tolist(), self.stop[self.start[some] + self.size[some] - 1].tolist())]


class Network:
    def __init__(self, vocabulary: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary  # sorted hashes; word 0 is any other
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        make = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"word": make(len(vocabulary) + 1, WORD_DIM, scale=0.05), "char": make(CHAR_BUCKETS, CHAR_DIM, scale=0.05)}
        for way in "fb":
            self.p |= {f"x{way}": make(d, 3 * h, scale=0.3), f"u{way}": make(h, 3 * h, scale=0.3), f"c{way}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": make(2 * h, ATTENTION, scale=0.3), "ac": np.zeros(ATTENTION, np.float32), "v": make(ATTENTION, scale=0.3), "o": make(2 * h, scale=0.3), "oc": np.zeros(1, np.float32)}
        self.slope, self.shift, self.floor = 1.0, 0.0, 0.0

    def index(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def forward(self, t: Text, some: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logits of the windows ``some``; cache: gets what backward needs."""
        p, h = self.p, HIDDEN
        order = np.argsort(-t.size[some], kind="stable")
        some = some[order]
        size, start = t.size[some], t.start[some]
        lead = np.concatenate([[0], np.cumsum(size)])
        words, token = np.unique(t.word[ranges(start, size)], return_inverse=True) if cache is not None else (np.arange(len(t.hash)), t.word[ranges(start, size)])
        known = self.index(t.hash[words])
        if cache is None:
            grams, first = t.grams, t.gram_first
            n = np.diff(first)
        else:
            n = t.gram_first[words + 1] - t.gram_first[words]
            grams, first = t.grams[ranges(t.gram_first[words], n)], np.concatenate([[0], np.cumsum(n)])
        mean = np.add.reduceat(p["char"][grams], first[:-1]) / n[:, None].astype(np.float32)
        x = np.concatenate([p["word"][known], mean], 1)
        states = np.empty((lead[-1], 2 * h), np.float32)
        longest = int(size[0])
        active = np.searchsorted(-size, -np.arange(longest), "left")  # windows longer than t
        steps: dict[str, list] = {"f": [], "b": []}
        for k, way in enumerate("fb"):
            inp = x @ p[f"x{way}"] + p[f"c{way}"]
            u = p[f"u{way}"]
            state = np.zeros((len(some), h), np.float32)
            for step in range(longest):
                m = active[step]
                at = lead[:m] + (step if way == "f" else size[:m] - 1 - step)
                a = inp[token[at]]
                g = state[:m] @ u
                gate = _sigmoid(a[:, : 2 * h] + g[:, : 2 * h])
                z, r = gate[:, :h], gate[:, h:]
                new = np.tanh(a[:, 2 * h :] + r * g[:, 2 * h :])
                old = state[:m]
                if cache is not None:
                    old = old.copy()
                    steps[way].append((at, z, r, new, g[:, 2 * h :], old))
                state[:m] = new + z * (old - new)
                states[at, k * h : k * h + h] = state[:m]
        hid = np.tanh(states @ p["a"] + p["ac"])
        e = hid @ p["v"]
        w = np.exp(e - np.repeat(np.maximum.reduceat(e, lead[:-1]), size))
        w /= np.repeat(np.add.reduceat(w, lead[:-1]), size)
        pooled = np.add.reduceat(states * w[:, None], lead[:-1])
        out = np.empty(len(some), np.float32)
        out[order] = pooled @ p["o"] + p["oc"]
        if cache is not None:
            cache |= {"order": order, "size": size, "lead": lead, "token": token, "known": known, "grams": grams, "first": first, "n": n, "x": x, "steps": steps, "states": states, "hid": hid, "w": w, "pooled": pooled}
        return out

    def backward(self, c: dict, down: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all parameters; down: those of the logits."""
        p, h = self.p, HIDDEN
        down = down[c["order"]].astype(np.float32)
        size, lead = c["size"], c["lead"]
        grad = {"o": c["pooled"].T @ down, "oc": down.sum(keepdims=True)}
        pooled = down[:, None] * p["o"]
        each = np.repeat(pooled, size, 0)
        states = each * c["w"][:, None]
        dw = (each * c["states"]).sum(1)
        de = c["w"] * (dw - np.repeat(np.add.reduceat(dw * c["w"], lead[:-1]), size))
        grad["v"] = c["hid"].T @ de
        dh = de[:, None] * p["v"] * (1 - c["hid"] ** 2)
        grad["a"], grad["ac"] = c["states"].T @ dh, dh.sum(0)
        states = states + dh @ p["a"].T
        dx = np.zeros_like(c["x"])
        for k, way in enumerate("fb"):
            u = p[f"u{way}"]
            du = np.zeros_like(u)
            inp = np.zeros((len(c["token"]), 3 * h), np.float32)  # of each place's projected input
            ds = np.zeros((len(size), h), np.float32)
            for at, z, r, new, gn, old in reversed(c["steps"][way]):
                m = len(at)
                d = ds[:m] + states[at, k * h : k * h + h]
                dz = d * (old - new) * z * (1 - z)
                dn = d * (1 - z) * (1 - new**2)
                dr = dn * gn * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r], 1)
                inp[at] = np.concatenate([dz, dr, dn], 1)
                du += old.T @ dg
                ds[:m] = d * z + dg @ u.T
            order = np.argsort(c["token"], kind="stable")
            per = np.add.reduceat(inp[order], np.searchsorted(c["token"][order], np.arange(len(c["x"]))))
            grad[f"u{way}"], grad[f"x{way}"], grad[f"c{way}"] = du, c["x"].T @ per, per.sum(0)
            dx += per @ p[f"x{way}"].T
        grad["word"] = np.zeros_like(p["word"])
        np.add.at(grad["word"], c["known"], dx[:, :WORD_DIM])
        grad["char"] = np.zeros_like(p["char"])
        order = np.argsort(c["grams"], kind="stable")
        bucket, at = np.unique(c["grams"][order], return_index=True)
        owner = np.repeat(np.arange(len(c["n"])), c["n"])[order]
        grad["char"][bucket] = np.add.reduceat((dx[:, WORD_DIM:] / c["n"][:, None].astype(np.float32))[owner], at)
        return grad

    def fit(self, windows: list[Text], targets: list[np.ndarray], draw: Callable[[Network, int], tuple[list[Text], list[np.ndarray]]], rng: np.random.Generator) -> Network:
        """Train on windows with their targets; ``draw`` gives others, found with the network so far. A batch comes from one part."""
        first = {k: np.zeros_like(x) for k, x in self.p.items()}
        second = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, turn = 0, 1
        epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, sum(len(t.text) for t in windows))))
        for epoch in range(epochs):
            # drawn anew from two fifths of the epochs on
            if turn < DRAWS and epoch * 5 * (DRAWS - 1) >= epochs * (2 * (DRAWS - 1) + 3 * (turn - 1)):
                windows, targets = draw(self, turn)
                turn += 1
            total = sum(len(y) for y in targets)
            share = min(max(sum(float(y.sum()) for y in targets) / total, 1e-3), 1 - 1e-3)
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in rng.permutation(len(windows)):
                order = rng.permutation(len(targets[k]))
                for lo in range(0, len(order), BATCH):
                    some = order[lo : lo + BATCH]
                    target = targets[k][some]
                    cache: dict = {}
                    out = self.forward(windows[k], some, cache)
                    weight = np.minimum(np.where(target > 0, 0.5 / share, 0.5 / (1 - share)), 5)
                    grad = self.backward(cache, (_sigmoid(out) - target) * weight / len(some))
                    step += 1
                    for name, g in grad.items():
                        g = g + DECAY * self.p[name] if name in ("word", "char") else g
                        first[name] += 0.1 * (g - first[name])
                        second[name] += 0.001 * (g * g - second[name])
                        self.p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        return self

    def windows(self, t: Text) -> np.ndarray:
        return self.forward(t, np.arange(len(t.text))) if len(t.text) else np.zeros(0, np.float32)

    def highest(self, t: Text) -> np.ndarray:
        """The logit of each text's highest window; -inf without words."""
        out = np.full(len(t.first) - 1, -np.inf)
        np.maximum.at(out, t.text, self.windows(t))
        return out

    def calibrate(self, x: np.ndarray, label: np.ndarray, prior: float) -> None:
        """Fit the logistic curve from highest logits to labels (Newton steps, a little shrinkage).

        prior: the share of positives among all labels, which the sample's differs from.
        """
        ok = np.isfinite(x)
        x, y = np.clip(x[ok], -30, 30), label[ok].astype(np.float64)
        if not len(x) or y.min() == y.max():
            return
        ab, middle, pull = np.array([1.0, 0.0]), np.array([0.5, 0.0]), np.array([1e-2, 1e-4])
        feature = np.stack([x, np.ones(len(x))], 1)

        def loss(ab: np.ndarray) -> float:
            z = feature @ ab
            return float((np.logaddexp(0, z) - y * z).sum() + (pull * (ab - middle) ** 2).sum() / 2)

        for _ in range(100):
            q = 1 / (1 + np.exp(-np.clip(feature @ ab, -35, 35)))
            hess = feature.T @ (feature * (q * (1 - q))[:, None]) + np.diag(pull)
            step, now = np.linalg.solve(hess, feature.T @ (q - y) + pull * (ab - middle)), loss(ab)
            # where logits part the labels wholly, a full step may lead away from the minimum
            share = next((s for s in 0.5 ** np.arange(30) if loss(ab - s * step) <= now), 0.0)
            ab = ab - share * step
        odds = lambda p: np.log(p / (1 - p))
        self.slope, self.shift = float(max(ab[0], 1e-3)), float(ab[1] + (odds(prior) - odds(y.mean()) if 0 < prior < 1 else 0.0))

    def score(self, col: pa.Array) -> np.ndarray:
        data, off = column_bytes(col)
        if not len(self.p):
            return np.full(len(off) - 1, self.floor)
        x = np.clip(self.highest(Text(data, off)), -30, 30)
        words = x > -30
        return np.where(words, 1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -35, 35))), self.floor)


def _text(texts: list[str]) -> Text:
    return Text(*column_bytes(pa.array(texts, pa.string())))


def drawn(t: Text, label: np.ndarray, seeds: np.ndarray, turn: int, net: Network | None) -> np.ndarray:
    """Windows of each text to train on: EACH at random, or with ``net`` the likeliest of the text
    and others at random, of a positive text those with a logit of 0 or more."""
    order = np.empty(len(t.text))
    for i, seed in enumerate(seeds.tolist()):
        a, b = np.searchsorted(t.text, [i, i + 1])
        order[a:b] = np.random.default_rng([seed & 0xFFFFFFFF, turn]).random(b - a)
    trust = np.ones(len(t.text), bool)
    if net is not None and len(t.text):
        score = net.windows(t)
        best = np.full(len(label), -np.inf)
        np.maximum.at(best, t.text, score)
        order[score >= best[t.text]] = -1
        trust = (label[t.text] == 0) | (score >= best[t.text]) | (score >= 0)
    pick = np.lexsort((order, t.text))
    pick = pick[np.arange(len(pick)) - np.searchsorted(t.text[pick], t.text[pick]) < EACH]
    return pick[trust[pick]]


def _parts(windows: list[str], target: np.ndarray, rng: np.random.Generator) -> tuple[list[Text], list[np.ndarray]]:
    """PART windows at a time, so that memory does not grow with the sample."""
    order = rng.permutation(len(windows))
    lists = [order[lo : lo + PART] for lo in range(0, len(order), PART)]
    return [_text([windows[i] for i in x]) for x in lists], [target[x].astype(np.float32) for x in lists]


def _vocabulary(parts: list[Text]) -> np.ndarray:
    """Hashes of the words that most windows have."""
    hashes, times = [], []
    for t in parts:
        place, window = t.word[ranges(t.start, t.size)], np.repeat(np.arange(len(t.size)), t.size)
        each = np.unique(place * len(t.size) + window) // max(1, len(t.size))
        hashes.append(t.hash)
        times.append(np.bincount(each, minlength=len(t.hash)))
    key, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, np.concatenate(times), len(key))
    often = np.lexsort((key, -total))[:VOCABULARY]
    return np.sort(key[often[total[often] >= SEEN]])


Draw = Callable[["Network | None", int], tuple[list[str], np.ndarray]]


def fit(draw: Draw, highest: Callable[[Network], tuple[np.ndarray, np.ndarray]], prior: float) -> Network:
    """draw: windows and targets that a network (None: at random) picks in a turn; highest: logits and labels to calibrate on."""
    net = Network(np.zeros(0, np.uint64))
    windows, target = draw(None, 0)
    if not len(windows) or target.min() == target.max():
        net.p, net.floor = {}, prior
        return net
    rng = np.random.default_rng(3)
    parts_, targets = _parts(windows, target, rng)
    net = Network(_vocabulary(parts_))
    net.fit(parts_, targets, lambda now, turn: _parts(*draw(now, turn), rng), rng)
    net.calibrate(*highest(net), prior)
    return net


def fit_texts(texts: list[str], label: np.ndarray) -> Network:
    """Fit on texts at hand."""
    late = np.random.default_rng(5).random(len(label)) < CALIBRATION
    if label[late].sum() < 5 or label[~late].sum() < 5:
        late[:] = False
    t, y = _text([x for x, out in zip(texts, late) if not out]), label[~late]
    rest = _text([x for x, out in zip(texts, late) if out]) if late.any() else t

    def draw(net: Network | None, turn: int) -> tuple[list[str], np.ndarray]:
        some = drawn(t, y, np.arange(len(y)), turn, net)
        return t.strings(some), y[t.text[some]]

    return fit(draw, lambda net: (net.highest(rest), label[late] if late.any() else y), float(label.mean()) if len(label) else 0.0)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", label: str = "toxic", positive: int = POSITIVE, negative: int = NEGATIVE) -> Network:
    """Fit on at most ``positive`` and ``negative`` labelled texts, none of them held out."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "toxicity")
    known = labels.select(F.col("doc_id").alias("i"), F.col(label).cast("int").alias("y")).where(F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out("i", 4, 2))
    known = known.groupBy("i").agg(F.max("y").alias("y"))  # repeated rows of a label count once
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {1: positive, 0: negative}
    rate = F.when(F.col("y") == 1, min(1.0, 1.25 * positive / counts.get(1, 1))).otherwise(min(1.0, 1.25 * negative / counts.get(0, 1)))
    draw_id = F.pmod(F.xxhash64("i", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    few = known.where(draw_id < rate)  # about 1.25 (positive + negative) rows at most
    base = docs.select(F.col(ident).alias("i"), F.col(text).cast("string").alias("t")).where(F.col("t").isNotNull()).withColumn("h", F.xxhash64("i", "t"))
    # which texts, by their hashes alone: a doc_id may stand on very many rows
    keys = base.select("i", "h").join(F.broadcast(few), "i").select("h", "y").distinct()
    keys = keys.withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy("h"))).where(F.col("r") <= F.when(F.col("y") == 1, most[1]).otherwise(most[0]))
    keys = scratch.keep(keys.select("h", "y").coalesce(1), "keys")
    sample = base.select("h", "t").join(F.broadcast(keys), "h").dropDuplicates(["h"])
    sample = scratch.keep(sample.repartition(parts(spark), "h").withColumn("late", F.pmod(F.xxhash64("h", F.lit("late")), F.lit(1000)) < int(1000 * CALIBRATION)), "sample")
    have = {(r.late, r.y): r.n for r in sample.groupBy("late", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    apart = have.get((True, 1), 0) >= 5 and have.get((False, 1), 0) >= 5
    seen = sample.where("not late") if apart else sample
    rest = sample.where("late") if apart else sample

    def draw(net: Network | None, turn: int) -> tuple[list[str], np.ndarray]:
        sent = spark.sparkContext.broadcast(net)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "t", 700_000):
                    t, y = Text(*column_bytes(piece.column("t"))), piece.column("y").to_numpy()
                    some = drawn(t, y, piece.column("h").to_numpy(), turn, sent.value)
                    yield pa.RecordBatch.from_arrays([pa.array(t.strings(some), pa.string()), pa.array(y[t.text[some]], pa.int32())], ["w", "y"])

        # at most EACH windows of WINDOW words for each text of the sample
        found = sorted((r.w, r.y) for r in seen.select("h", "t", "y").mapInArrow(run, "w string, y int").collect())
        return [w for w, _ in found], np.array([y for _, y in found], np.int64)

    def highest(net: Network) -> tuple[np.ndarray, np.ndarray]:
        sent = spark.sparkContext.broadcast(net)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, "t", 700_000):
                    high = sent.value.highest(Text(*column_bytes(piece.column("t"))))
                    yield pa.RecordBatch.from_arrays([pa.array(high, pa.float64()), piece.column("y")], ["x", "y"])

        found = sorted((r.x, r.y) for r in rest.select("t", "y").mapInArrow(run, "x double, y int").collect())
        return np.array([x for x, _ in found], np.float64), np.array([y for _, y in found], np.int64)

    net = fit(draw, highest, counts.get(1, 0) / max(1, sum(counts.values())))
    scratch.drop("sample")
    return net


def scored(docs: DataFrame, net: Network, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``doc_id, score``."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 700_000):
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sent.value.score(piece.column("text")), pa.float64())], ["doc_id", "score"])

    base = docs.select(F.col(ident).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, score double")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """All ``documents``: a row for each, wordless texts with score 0; an empty table gives none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
