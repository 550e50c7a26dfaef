"""Chunks, postings, BM25 and rank fusion."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expressions import words
from weftline.functions.lineage import settled

K1, B = 1.2, 0.75
#: The constant of reciprocal rank fusion.
FUSION = 60


def chunks(docs: DataFrame, size: int = 1200, overlap: int = 0, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, chunk_order_index, tokens, content)``: windows of ``size`` blank-parted words.

    The order index starts at 0 in every document; a document without words has no chunk.
    """
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    rows = docs.select(F.col(ident), parts.alias("_words")).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - 1 - overlap, F.lit(0)), F.lit(size - overlap))
    rows = rows.select(ident, "_words", F.posexplode(starts).alias("chunk_order_index", "_from"))
    content = F.slice("_words", F.col("_from") + 1, F.lit(size))
    return rows.select(ident, "chunk_order_index", F.size(content).alias("tokens"), F.array_join(content, " ").alias("content"))


def postings(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(term, doc_id, tf, length)``."""
    rows = docs.select(F.col(ident), words(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    return rows.select(ident, F.size("_w").alias("length"), F.explode("_w").alias("term")).groupBy("term", ident, "length").agg(F.count(F.lit(1)).alias("tf"))


def bm25(docs: DataFrame, query: list[str], ident: str = "doc_id", text: str = "text", k1: float = K1, b: float = B) -> DataFrame:
    """``(doc_id, score)`` of documents that hold a query term.

    Term counts come from the words of each document as it is read: only the query's terms leave
    the scan, and the corpus counts are one aggregate.
    """
    terms = sorted(set(query))
    rows = docs.select(F.col(ident), words(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    times = [F.size("_w") - F.size(F.array_remove("_w", t)) for t in terms]
    # a few numbers per document, read for the statistics and for the scores
    rows = settled(rows.select(ident, F.size("_w").alias("length"), *[n.alias(f"_tf{i}") for i, n in enumerate(times)]))
    stats = rows.agg(F.count(F.lit(1)).alias("_n"), F.avg("length").alias("_avg"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))])
    rows = rows.where(F.greatest(F.lit(0), *[F.col(f"_tf{i}") for i in range(len(terms))]) > 0).crossJoin(F.broadcast(stats))  # one row of statistics
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"_tf{i}").cast("double"), F.col(f"_df{i}")
        idf = F.log(1 + (F.col("_n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / F.col("_avg")))
    return rows.select(ident, score.alias("score"))


def top(ranked: DataFrame, k: int, score: str = "score", ident: str = "doc_id") -> DataFrame:
    """The k best with their rank from 1, ties by id."""
    best = ranked.orderBy(F.col(score).desc(), F.col(ident)).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col(score).desc(), F.col(ident))))  # k rows


def fuse(*rankings: DataFrame, ident: str = "doc_id", k: int = FUSION) -> DataFrame:
    """Reciprocal rank fusion of rankings (id, rank): the sum of 1 / (k + rank) over those that list an id."""
    every = None
    for r in rankings:
        part = r.select(ident, (F.lit(1.0) / (F.col("rank") + k)).alias("part"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(ident).agg(F.sum("part").alias("rrf_score"))


def evidence(context: str, chars: int = 700, find: str | None = None) -> tuple[str, int]:
    """``chars`` characters of a context without its empty lines, and where they start.

    They start with the context, or with the last line that begins a quarter of ``chars`` or more
    before the first ``find``. ('', -1) where ``find`` doesn't occur.
    """
    lines = [line for line in context.strip().split("\n") if line]
    whole = "\n".join(lines)
    found = whole.find(find) if find else 0
    if found < 0:
        return "", -1
    begins = list(accumulate((len(line) + 1 for line in lines), initial=0))[: len(lines) or 1]
    start = begins[bisect_right(begins, max(0, found - chars // 4)) - 1]
    return whole[start : start + chars], start


def contains_any(column: Column, *parts: str) -> Column:
    """Whether a text holds one of the parts, upper and lower case alike."""
    out = F.lit(False)
    for p in parts:
        out = out | F.lower(column).contains(p.lower())
    return out
