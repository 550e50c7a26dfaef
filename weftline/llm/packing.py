"""Order-preserving packing of documents into sequences by dynamic programming.

Documents are laid end to end in ascending doc_id and cut into windows of at most ``most`` ids.
Windows may be cut at document ends, after sentence ends (a little dearer) and, in stretches of
more than WIDE ids that hold neither, at places in between (much dearer). Every window costs
something as well, so that a short one of a power of two, though it has no padding, is no way to
save a few padded ids. With f the least cost up to a cut at place p, f(p) = pen(p) + min over cuts
q in [p - most, p) of f(q) + padding(p - q), where the padding is most - (p - q), or nothing if
p - q is a power of two. The first kind is a minimum of f(q) + q over a sliding window, kept in a
monotone queue; the powers of two are looked up. So a step costs a constant however many cuts lie
in a window.

Partitions are ranges of doc_id; a partition's last window is the only one that isn't weighed
against what follows. Null text is empty (its end id alone); null doc_ids come first; repeated
rows are documents of their own, ties of doc_id in the order of their texts; a very long text goes
over as many windows as it takes; an empty table gives no rows. Extra columns are ignored.
Sequence ids are the partition's number times 2 ** 32 plus a count.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import in_order, short_reads, small_batches
from weftline.llm.textcode import ranges, slices
from weftline.llm.tokens import encoder

MOST = 2048
END = 1
#: Cost of a window, in padded ids, and what a cut after a document, after a sentence and elsewhere adds.
EACH = 200
DOCUMENT, SENTENCE, ELSEWHERE = 0, 8, 60
#: A stretch longer than WIDE between document and sentence ends can be cut every STRETCH ids.
WIDE, STRETCH = 256, 32
#: Ids weighed at once; a longer partition goes in such pieces, the open window carried over.
HORIZON = 400_000


def best_cuts(place: np.ndarray, penalty: np.ndarray, most: int = MOST) -> np.ndarray:
    """Indices of the cheapest cuts. place ascends from 0, no step above ``most``; the last is taken."""
    n = len(place)
    # for each place, the places that lie a power of two before it
    index = np.full(int(place[-1]) + 1, -1, np.int32)
    index[place] = np.arange(n)
    ends, starts = [], []
    for b in range(most.bit_length()):
        if 1 << b <= most:
            later = np.searchsorted(place, 1 << b)
            j = index[place[later:] - (1 << b)]
            ok = j >= 0
            ends.append(np.flatnonzero(ok) + later)
            starts.append(j[ok])
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    lead = np.searchsorted(ends[order], np.arange(n + 1)).tolist()
    exact = starts[order].tolist()
    p, pen = place.tolist(), penalty.tolist()
    f, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # f(q) + q, ascending
    for i in range(1, n):
        here = p[i]
        while p[queue[0][1]] < here - most:
            queue.popleft()
        value, j = queue[0]
        cost = value + most - here
        for q in exact[lead[i] : lead[i + 1]]:
            if f[q] < cost:
                cost, j = f[q], q
        cost += pen[i]
        f[i], back[i] = cost, j
        value = cost + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    out = [n - 1]
    while out[-1]:
        out.append(back[out[-1]])
    return np.array(out[::-1])


def cut_places(doc_ends: np.ndarray, sentence_ends: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Where cuts may be (0 first) and their penalties."""
    wide_from, stretch = min(WIDE, most), min(STRETCH, most)
    total = int(doc_ends[-1])
    kind = np.zeros(total + 1, np.uint8)  # of each place: 0 none, 1 elsewhere, 2 sentence, 3 document
    kind[sentence_ends] = 2
    kind[doc_ends] = 3
    kind[0] = 3
    place = np.flatnonzero(kind)
    gap = np.diff(place)
    wide = np.flatnonzero(gap > wide_from)
    if len(wide):
        more = (gap[wide] - 1) // stretch
        kind[np.repeat(place[wide], more) + stretch * (ranges(np.zeros(len(wide), np.int64), more) + 1)] = 1
        place = np.flatnonzero(kind)
    return place, np.array([0, EACH + ELSEWHERE, EACH + SENTENCE, EACH + DOCUMENT])[kind[place]]


def sentence_ids(tokenizer: str) -> np.ndarray:
    """Whether each id ends a sentence: its token is closing punctuation."""
    enc = encoder(tokenizer)
    out = np.zeros(enc.tokenizer.get_vocab_size(), bool)
    for token, i in enc.tokenizer.get_vocab().items():
        body = token.replace("</w>", "")
        out[i] = bool(body) and body[-1] in ".!?" and not any(c.isalnum() for c in body)
    return out


class Packer:
    """Takes documents in order, gives pieces (document, start, length, crc, size, sequence, offset)."""

    def __init__(self, ends: np.ndarray, first: int, most: int = MOST, horizon: int = HORIZON):
        self.closes, self.sequence, self.most, self.horizon = ends, first, most, horizon
        self.docs: list = []  # what waits: ids of documents, their sizes, and the first one's ids that went before
        self.sizes = np.zeros(0, np.int64)
        self.gone = 0
        self.stream = np.zeros(0, np.int64)

    def add(self, docs: list, sizes: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
        self.docs = self.docs + docs
        self.sizes = np.concatenate([self.sizes, sizes])
        self.stream = np.concatenate([self.stream, ids]) if len(self.stream) else ids
        while len(self.stream) >= 2 * self.horizon:  # a part of what waits, up to a document's end
            yield from self.pack(False)
        if len(self.stream) >= self.horizon:
            yield from self.pack(False)

    def pack(self, last: bool) -> Iterator[tuple]:
        """Cut what waits, but for the open window at its end."""
        if not len(self.docs):
            return
        ends = np.cumsum(self.sizes) - self.gone
        upto = len(ends) if last else min(len(ends), int(np.searchsorted(ends, self.horizon)) + 1)
        if last and ends[-1] > 2 * self.horizon:
            yield from self.pack(False)
            yield from self.pack(True)
            return
        ends = ends[:upto]
        stream = self.stream[: ends[-1]]
        place, penalty = cut_places(ends, np.flatnonzero(self.closes[stream]) + 1, self.most)
        cuts = place[best_cuts(place, penalty, self.most)]
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]  # the open window waits for what follows
        cut = int(cuts[-1])
        # pieces: cut at windows and at documents' ends
        edges = np.union1d(cuts, ends[ends < cut])
        a, size = edges[:-1], np.diff(edges)
        doc = np.searchsorted(ends, a, "right")
        window = np.searchsorted(cuts, a, "right") - 1
        begin = np.concatenate([[-self.gone], ends[:-1]])[doc]
        raw = memoryview(stream[:cut].astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), edges[1:].tolist())]
        yield from zip([self.docs[i] for i in doc.tolist()], (a - begin).tolist(), size.tolist(), crc, self.sizes[doc].tolist(), (self.sequence + window).tolist(), (a - cuts[window]).tolist())
        self.sequence += len(cuts) - 1
        done = int(np.searchsorted(ends, cut, "right"))
        before = int(ends[done - 1]) if done else -self.gone
        self.docs, self.sizes, self.stream, self.gone = self.docs[done:], self.sizes[done:], self.stream[cut:], cut - before


_OUT = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def packed(docs: DataFrame, tokenizer: str, end: int = END, text: str = "text", ident: str = "doc_id", most: int = MOST) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, a row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        packer = Packer(sentence_ids(tokenizer), TaskContext.get().partitionId() << 32, most)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, k) for c, (_, k) in zip(cols[1:], _OUT))], ["doc_id", *(n for n, _ in _OUT)])

        for batch in batches:
            for piece in slices(batch, "text", 2_000_000):
                ids, sizes = enc.encode(piece.column("text"), end)
                yield out(list(packer.add(piece.column("doc_id").to_pylist(), sizes, ids)))
        yield out(list(packer.pack(True)))

    small_batches(docs.sparkSession)
    short_reads(docs.sparkSession)
    base = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = in_order(base, "doc_id", "text")
    return ordered.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, nulls as empty text: a row per piece; an empty table gives none."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
