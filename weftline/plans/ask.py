"""Questions over a graph: planned queries with one corrective retry, and retrieval with citations."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.expressions import cosine
from weftline.operators import text as txt
from weftline.operators import traverse, vector
from weftline.plans.guard import is_query, provenance_gap, writes

TOP_K = 40
#: Plans that are tried for one question until one runs.
ATTEMPTS = 5
SCOPES = ("local", "global", "unified")
#: Reports less similar to a question than this say nothing about it.
SIMILAR = 0.25


@dataclass
class Answer:
    question: str
    answer: str = ""
    sql: str | None = None
    rows: list[dict] = field(default_factory=list)
    context: str = ""
    error: str | None = None
    retrieved: str = ""
    note: str = ""

    @property
    def ok(self) -> bool:
        return self.error is None

    def evidence(self, chars: int = 700, find: str | None = None) -> str:
        window, start = txt.evidence(self.context, chars, find)
        return window if start >= 0 else f"({find!r} does not occur in what was retrieved)"

    def show(self, rows: int = 6) -> str:
        parts = [f"Q  {self.question}", *([self.sql] if self.sql else []), *([f"!! {self.error}"] if self.error else []), *([f"({self.note})"] if self.note else []), *([self.retrieved] if self.retrieved else [])]
        return "\n".join([*parts, *(str(r) for r in self.rows[:rows]), f"A  {self.answer}"])


class Planner(Protocol):
    def plan(self, question: str, schema: str, correction: str = "") -> tuple[str, dict]: ...


class TemplatePlanner:
    """Plans without a model: the first template whose pattern is found in the question; groups are the query's arguments."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        """templates: (pattern, sql, sql after a correction)."""
        self.templates = [(re.compile(p, re.I), a, b) for p, a, b in templates]

    def plan(self, question: str, schema: str, correction: str = "") -> tuple[str, dict]:
        for pattern, sql, corrected in self.templates:
            if m := pattern.search(question):
                return corrected if correction else sql, m.groupdict()
        raise LookupError("no template fits the question")


def schema_of(spark: SparkSession, tables: tuple[str, ...] = ("entities", "relations", "documents", "chunks", "communities")) -> str:
    """Names and types of the graph's views."""
    have = {t.name for t in spark.catalog.listTables()}
    return "\n".join(f"{t}({spark.table(t).schema.simpleString()[7:-1]})" for t in tables if t in have)


def ask(spark: SparkSession, planner: Planner, question: str, top_k: int = TOP_K, render: Callable[[list[dict]], str] | None = None) -> Answer:
    """Plan, guard, run and answer; a provenance gap gets one retry, kept only if it closes the gap.

    A plan that doesn't run is planned anew with its error, ATTEMPTS times at most and no plan twice;
    one that is refused is not.
    """

    def attempt(correction: str = "") -> Answer:
        try:
            sql, args = planner.plan(question, schema_of(spark), correction)
        except LookupError as e:
            return Answer(question, error=str(e))
        if word := writes(sql):
            return Answer(question, sql=sql, error=f"refused: the query writes ({word})")
        try:
            if not is_query(spark, sql):
                return Answer(question, sql=sql, error="refused: not a query")
            rows = [r.asDict(True) for r in spark.sql(sql, args=args).limit(top_k).collect()]
        except Exception as e:  # what a planner wrote may be wrong in any way; the answer says how
            return Answer(question, sql=sql, error=f"{type(e).__name__}: {str(e).splitlines()[0]}")
        return Answer(question, (render or plain)(rows), sql, rows)

    first, tried = attempt(), set()
    while not first.ok and first.sql and not first.error.startswith("refused") and first.sql not in tried and len(tried) + 1 < ATTEMPTS:
        tried.add(first.sql)
        first = attempt(first.error)
    gap = provenance_gap(first.sql) if first.ok else ""
    if gap:
        second = attempt(gap)
        if second.ok and not provenance_gap(second.sql):
            second.note = "asked again: " + gap
            return second
        first.note = gap
    return first


def plain(rows: list[dict]) -> str:
    if not rows:
        return "nothing found"
    if len(rows) == 1 and len(rows[0]) == 1:
        return str(next(iter(rows[0].values())))
    return "; ".join(", ".join(f"{k}={v}" for k, v in r.items()) for r in rows)


class Retriever:
    """Hybrid retrieval: exact vector search and BM25, fused by reciprocal rank."""

    def __init__(self, entities: DataFrame, edges: DataFrame, chunks: DataFrame, documents: DataFrame, communities: DataFrame, embed: Callable[[DataFrame, str], DataFrame] = vector.embed):
        """entities (id, entity_name, description, embedding), chunks (id, doc_id, content, embedding), documents (id, citable_url)."""
        self.entities, self.edges, self.chunks, self.documents, self.communities, self.embed = entities, edges, chunks, documents, communities, embed

    def vector_of(self, question: str) -> list[float]:
        spark = self.entities.sparkSession
        row = self.embed(spark.createDataFrame([(question,)], "text string"), "text").first()
        return list(row.embedding or [])

    def hybrid(self, rows: DataFrame, question: str, content: str, k: int, search: int = 50) -> DataFrame:
        """(id, rrf_score) of the k best by both rankings."""
        q = self.vector_of(question)
        lexical = txt.top(txt.bm25(rows, re.findall("[a-z0-9]+", question.lower()), "id", content), search, ident="id")
        rankings = [lexical]
        if q:
            rankings.append(txt.top(vector.nearest(rows.select("id", "embedding"), q, search, ident="id").select("id", "score"), search, ident="id"))
        return txt.fuse(*rankings, ident="id").orderBy(F.col("rrf_score").desc(), "id").limit(k)

    def local(self, question: str, k: int = 8) -> DataFrame:
        """The k entities nearest to a question and their relations, analogies first, then by weight."""
        best = self.hybrid(self.entities, question, "description", k)
        found = traverse.neighbors(best, self.edges, traverse.ANY)
        return found.orderBy(F.col("rrf_score").desc(), "id", F.col("order").asc_nulls_last(), F.col("weight").desc_nulls_last(), "to")

    def wide(self, question: str, level: int = 1, floor: float = SIMILAR) -> DataFrame:
        """Community reports of a level that resemble the question, best rated first."""
        q = F.array(*[F.lit(float(x)) for x in self.vector_of(question)] or [F.lit(0.0)])
        scored = self.communities.where(F.col("level") == level).withColumn("score", cosine(F.col("embedding"), q))
        return scored.where(F.col("score") >= floor).orderBy(F.col("report_json.rating").desc(), F.col("score").desc(), "_key")

    def points(self, question: str, k: int = TOP_K, level: int = 1, floor: float = SIMILAR) -> DataFrame:
        """(point, rating, score, reports): findings of those reports, equal ones once with their ratings added, the k best rated."""
        each = self.wide(question, level, floor).select("_key", "score", F.col("report_json.rating").alias("rating"), F.explode("report_json.findings").alias("finding"))
        one = each.groupBy("_key", F.col("finding.summary").alias("point")).agg(F.max("rating").alias("rating"), F.max("score").alias("score"))
        found = one.groupBy("point").agg(F.sum("rating").alias("rating"), F.max("score").alias("score"), F.count(F.lit(1)).alias("reports"))
        return found.orderBy(F.col("rating").desc(), F.col("score").desc(), "point").limit(k)

    def passages(self, question: str, k: int = 8) -> DataFrame:
        """The k best chunks with their document's address and a citation number."""
        best = self.hybrid(self.chunks, question, "content", k).join(self.chunks.select("id", "doc_id", "content"), "id")
        cited = best.join(self.documents.select(F.col("id").alias("doc_id"), "citable_url"), "doc_id", "left")
        return cited.orderBy(F.col("rrf_score").desc(), "id")

    def ask(self, question: str, scope: str = "local", k: int = 8) -> Answer:
        if scope not in SCOPES:
            raise ValueError(f"scope is one of {', '.join(SCOPES)}")
        rows: list[dict] = []
        if scope == "global":
            rows = [{"tag": "report", "text": f"{r.report_json.title}: {r.report_json.summary}", "url": None} for r in self.wide(question).limit(TOP_K).collect()]
            rows += [{"tag": "point", "text": r.point, "url": None} for r in self.points(question).collect()]
        if scope in ("local", "unified"):
            names = self.entities.select(F.col("id").alias("to"), "entity_name")
            found = self.local(question, k).join(names, "to", "left").limit(TOP_K)
            rows += [{"tag": "graph", "text": f"{r.id} {r.direction} {r.relationship_type or r.type} {r.entity_name or r.to}", "url": None} for r in found.collect()]
        if scope == "unified":
            rows += [{"tag": "passage", "text": r.content, "url": r.citable_url} for r in self.passages(question, k).collect()]
        context, urls = cite(rows)
        summary = ", ".join(f"{sum(r['tag'] == t for r in rows)} {t}" for t in dict.fromkeys(r["tag"] for r in rows)) or "nothing"
        return Answer(question, context.split("\n")[0] if rows else "nothing found", rows=urls, context=context, retrieved=f"retrieved {summary}")


def cite(rows: list[dict]) -> tuple[str, list[dict]]:
    """Context lines with [CITE:n] marks, and the address of each n, ordered as text."""
    number: dict[str, int] = {}
    lines = []
    for r in rows:
        mark = f" [CITE:{number.setdefault(r['url'], len(number) + 1)}]" if r.get("url") else ""
        lines.append(r["text"] + mark)
    cited = sorted(({"cite": str(n), "url": u} for u, n in number.items()), key=lambda c: c["cite"])
    return "\n".join(lines), cited
