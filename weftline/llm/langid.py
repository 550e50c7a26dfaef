"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's grams are the byte 2-, 3- and 4-grams around each letter of its lower-cased UTF-8 (what
is neither an ASCII letter nor a byte of a longer character parts words). Each is hashed to one
of BUCKETS embeddings; the mean over the whole text goes through a linear softmax. Both are
trained by stochastic gradient descent in numpy on whole texts: executors send how often each
gram stands in a text, at most BUCKETS numbers however long it is. A part of the sample that
training doesn't see fits a temperature, so that scores are probabilities, and the share of known
grams below which a text counts as foreign; the score is scaled down by how far a text falls short
of that share. ``reject_below`` is half the score that all but REJECT_RATE of that part reaches:
texts in several languages stay.

As the softmax is linear in the mean, embedding times softmax is one table of BUCKETS x
languages, and whole texts are scored by sums over it.

The sample is the only bound of the fit: at most ROWS different texts per language and ALL_ROWS in
all, those of least hash; copies of a text count once, whatever their ids, and ids, null or
repeated, only decide what is held out. Null texts and texts without a letter get ``und`` and score
0. Repeated rows are scored alike. Without labelled rows every text is ``und`` and ``accepted``
rejects none. Empty tables give no rows. Extra columns, whatever their names, are ignored or carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.scratch import quoted, small_batches, unused
from weftline.llm.textcode import U, column_bytes, constants, lower_table, ranges, slices

BUCKETS = 1 << 16
DIM = 16
#: The model is fitted on at most so many labelled texts of each language, and in all.
ROWS, ALL_ROWS = 400, 4000
#: Of those, the part that calibrates.
CALIBRATION = 0.25
EPOCHS, RATE, BATCH = 4, 0.5, 64
#: Embeddings learn so much faster than the softmax: a gram has a small share of a text.
FASTER = 300
#: A small sample is gone over until so many steps are made.
STEPS = 160
REJECT_RATE = 0.001
UNKNOWN = "und"
_LETTERS = bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TABLE = lower_table(word=_LETTERS)
_MIX = constants(4, 31)


def text_grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers, three per letter, and where each text's begin (n + 1 numbers)."""
    n = len(off) - 1
    size = np.diff(off)
    flat = np.full(len(data) + 2 * n + 4, 32, np.uint64)
    to = ranges(off[:-1] + 2 * np.arange(1, n + 1), size)
    flat[to] = _TABLE[data]
    at = to[flat[to] != 32]
    first = np.searchsorted(at, np.append(off[:-1] + 2 * np.arange(1, n + 1), len(flat)))
    b = [flat[at + d] for d in (-1, 0, 1, 2)]
    two = b[1] << U(8) | b[2]
    three = b[0] << U(16) | two
    four = three << U(8) | b[3]
    out = np.empty((len(at), 3), np.int64)
    shift = U(64 - (BUCKETS.bit_length() - 1))
    for j, (g, k) in enumerate(((two, 1), (three, 2), (four, 3))):
        out[:, j] = (g + U(k << 40)) * _MIX[k] >> shift
    return out.ravel(), 3 * first


class LanguageModel:
    def __init__(self, languages: list[str]):
        self.languages = languages
        rng = np.random.default_rng(7)
        self.embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.soft = np.zeros((DIM, len(languages)), np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.seen = np.zeros(BUCKETS, bool)
        self.heat, self.usual, self.reject_below = 1.0, 0.0, 0.0
        self.freeze()

    def freeze(self) -> None:
        self.table = np.ascontiguousarray((self.embed @ self.soft).T)

    def fit(self, grams: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray) -> LanguageModel:
        """grams, counts: the buckets of each text and how often it has them."""
        rng = np.random.default_rng(8)
        late = rng.random(len(labels)) < CALIBRATION
        if len(np.unique(labels[~late])) < len(np.unique(labels)):
            late[:] = False
        train = np.flatnonzero(~late)
        of = labels[train]
        grams, late_grams = [grams[i] for i in train], [grams[i] for i in np.flatnonzero(late)]
        share = [(counts[i] / counts[i].sum()).astype(np.float32) for i in train]
        for g in grams:
            self.seen[g] = True
        weight = (len(of) / np.maximum(np.bincount(of, minlength=len(self.languages)), 1)) ** 0.5
        weight /= weight[of].mean()
        epochs = max(EPOCHS, -(-STEPS * BATCH // len(of)))
        for epoch in range(epochs):
            order = rng.permutation(len(of))
            rate = RATE * (1 - epoch / epochs)
            for lo in range(0, len(order), BATCH):
                self._step(grams, share, order[lo : lo + BATCH], of, weight, rate)
        self.freeze()
        if late.any():
            part = [counts[i] / counts[i].sum() for i in np.flatnonzero(late)]
            raw = np.array([self.bias + self.table[:, g] @ x for g, x in zip(late_grams, part)])
            known = np.array([x[self.seen[g]].sum() for g, x in zip(late_grams, part)])
            self._calibrate(raw, known, labels[late])
        return self

    def _step(self, grams: list[np.ndarray], share: list[np.ndarray], some: np.ndarray, of: np.ndarray, weight: np.ndarray, rate: float) -> None:
        mean = np.stack([share[i] @ self.embed[grams[i]] for i in some])
        p = mean @ self.soft + self.bias
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(some)), of[some]] -= 1
        p = (p * weight[of[some]][:, None]).astype(np.float32)
        down = (rate * FASTER / len(some)) * (p @ self.soft.T)
        self.soft -= rate / len(some) * mean.T @ p
        self.bias -= rate / len(some) * p.sum(0)
        for i, d in zip(some, down.astype(np.float32)):  # a text's buckets are distinct
            self.embed[grams[i]] -= share[i][:, None] * d

    def raw_scores(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, the share of known grams, and the number of grams of each text."""
        grams, first = text_grams(data, off)
        count = np.diff(first)
        some = np.flatnonzero(count)
        out = np.tile(self.bias.astype(np.float64), (len(count), 1))
        known = np.zeros(len(count))
        if len(some):
            lead = first[some]
            for j, row in enumerate(self.table):
                out[some, j] += np.add.reduceat(row[grams].astype(np.float64), lead) / count[some]
            known[some] = np.add.reduceat(self.seen[grams].astype(np.int64), lead) / count[some]
        return out, known, count

    def _calibrate(self, raw: np.ndarray, known: np.ndarray, labels: np.ndarray) -> None:
        best = (np.inf, 1.0)
        for heat in np.geomspace(0.01, 5, 60):
            z = raw / heat
            z -= z.max(1, keepdims=True)
            loss = float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), labels]).mean())
            best = min(best, (loss, float(heat)))
        self.heat = best[1]
        self.usual = float(np.quantile(known, 0.01))
        self.reject_below = float(np.quantile(self._score(raw, known)[1], REJECT_RATE)) * 0.5

    def _score(self, raw: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = raw / self.heat
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        top = p.argmax(1)
        short = np.minimum(1.0, known / self.usual) if self.usual else np.ones(len(known))
        return top, p[np.arange(len(p)), top] * short

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        data, off = column_bytes(col)
        if not self.languages:
            return [UNKNOWN] * (len(off) - 1), np.zeros(len(off) - 1)
        raw, known, count = self.raw_scores(data, off)
        top, score = self._score(raw, known)
        # bytes of longer characters need not be letters: texts without ASCII letters are looked at
        ascii_letters = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))])
        lone = (count > 0) & (ascii_letters[off[1:]] == ascii_letters[off[:-1]])
        none = count == 0
        for i in np.flatnonzero(lone):
            none[i] = not any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
        return [UNKNOWN if x else self.languages[t] for t, x in zip(top.tolist(), none.tolist())], np.where(none, 0.0, np.clip(score, 0, 1))


def held_out(ident: str, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves that rest; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit(""))), F.lit(mod)) == rest


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (h, l, t) -> the buckets of each and how often it has them; texts without a letter give no row."""
    for batch in batches:
        for piece in slices(batch, "t"):
            grams, first = text_grams(*column_bytes(piece.column("t")))
            lists = [np.unique(grams[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
            cols = [piece.column("h"), piece.column("l"), pa.array([g.astype(np.int32) for g, _ in lists], pa.list_(pa.int32())), pa.array([n.astype(np.int32) for _, n in lists], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, ["h", "l", "grams", "counts"]).filter(pa.array(np.diff(first) > 0))


def train(docs: DataFrame, text: str = "text", label: str = "lang", ident: str = "doc_id", rows: int = ROWS, all_rows: int = ALL_ROWS) -> LanguageModel:
    """Fit on at most ``rows`` labelled texts per language and ``all_rows`` in all, none of them held out."""
    small_batches(docs.sparkSession)
    base = docs.select(F.col(ident).alias("i"), F.col(text).cast("string").alias("t"), F.col(label).cast("string").alias("l"))
    base = base.where(F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out("i", 3, 1) & (F.col("l") != UNKNOWN)).select("t", "l").withColumn("h", F.xxhash64("t", F.lit("sample")))
    counts = {r.l: r.n for r in base.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "l").limit(all_rows).collect()}  # a row per language
    if not counts:
        return LanguageModel([])
    each = max(1, min(rows, all_rows // len(counts)))
    rate = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.25 * each / n) if n > each else 1.0))]), F.col("l"))
    draw = F.pmod("h", F.lit(1 << 20)) / F.lit(float(1 << 20))
    # a little more than ``each``, a row for each text and language, of which those of least hash are taken
    few = base.where(F.col("l").isin(list(counts)) & (draw < rate)).mapInArrow(_histograms, "h long, l string, grams array<int>, counts array<int>").dropDuplicates(["h", "l"])
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("r") <= each)
    sample = few.select("l", "h", "grams", "counts").toArrow().sort_by([("l", "ascending"), ("h", "ascending")]).combine_chunks()
    if not sample.num_rows:
        return LanguageModel([])
    found = sample.column("l").to_pylist()
    languages = sorted(set(found))
    grams, counts = ([x.values.to_numpy() for x in sample.column(c)] for c in ("grams", "counts"))
    return LanguageModel(languages).fit([g.astype(np.int64) for g in grams], counts, np.array([languages.index(x) for x in found], np.int64))


def classify(docs: DataFrame, model: LanguageModel, text: str = "text", ident: str = "doc_id", keep: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; with ``keep`` (two names that docs hasn't) all its columns and these."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                lang, score = sent.value.predict(piece.column(text))
                cols = piece.columns if keep else [piece.column(ident)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(score)], [*(piece.schema.names if keep else ["doc_id"]), *(keep or ("lang_pred", "score"))])

    if keep:
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        return docs.mapInArrow(run, f"{kind}, `{keep[0]}` string, `{keep[1]}` double")
    base = docs.select(F.col(ident), F.col(text).cast("string").alias(text))
    return base.mapInArrow(run, f"doc_id {base.schema[ident].dataType.simpleString()}, lang_pred string, score double")


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose language is known well enough: not ``und``, and a score of ``reject_below`` or more.

    Where no language can be learnt (no labelled text with a letter) nothing is rejected.
    """
    model = train(docs, text)
    if not model.languages:
        return docs
    lang, score = unused("lang_pred", docs), unused("lang_score", docs)
    return classify(docs, model, text, keep=(lang, score)).where((quoted(lang) != UNKNOWN) & (quoted(score) >= model.reject_below)).drop(lang, score)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """All ``documents``: a row for each, ``und`` for null and letterless texts; an empty table gives none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = classify(docs, train(docs))
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
