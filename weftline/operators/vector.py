"""Exact vector search and a deterministic text embedder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.expressions import cosine, words

DIMENSION = 64


def nearest(rows: DataFrame, query: list[float], k: int, where: Column | None = None, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """The k rows most similar to a vector, with ``score``; ``where`` is applied before any score is computed."""
    if where is not None:
        rows = rows.where(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.withColumn("score", cosine(F.col(vector), q)).where("score is not null")
    return scored.orderBy(F.col("score").desc(), F.col(ident)).limit(k)


def embed(rows: DataFrame, text: str = "text", dimension: int = DIMENSION, output: str = "embedding") -> DataFrame:
    """Adds a unit vector per text: words hashed to signed dimensions. Null for a text without words."""
    w = words(F.coalesce(F.col(text), F.lit("")))
    signed = F.transform(w, lambda x: F.struct(F.pmod(F.xxhash64(x), F.lit(dimension)).alias("d"), F.when(F.pmod(F.shiftright(F.xxhash64(x), 32), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("s")))
    axis = F.sequence(F.lit(0), F.lit(dimension - 1))
    raw = F.transform(axis, lambda d: F.aggregate(F.filter(signed, lambda x: x["d"] == d), F.lit(0.0), lambda a, x: a + x["s"]))
    rows = rows.withColumn("_raw", raw)
    length = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("_len", length).withColumn(output, F.when(F.col("_len") > 0, F.transform("_raw", lambda x: (x / F.col("_len")).cast("float")))).drop("_raw", "_len")


def search_relations(edges: DataFrame, ends: DataFrame, query: list[float], k: int = 8, relation: str | None = None) -> DataFrame:
    """The k edges nearest to a vector, of one kind if given: ``description, relation, at, score``."""
    usable = edges.where((F.col("type") == "RELATED_TO") & F.col("embedding").isNotNull())
    if relation is not None:
        usable = usable.where(F.col("relationship_type") == relation)
    best = nearest(usable, query, k, ident="src")
    files = ends.select(F.col("id").alias("src"), F.col("files").alias("at"))
    return best.join(files, "src", "left").select("description", F.col("relationship_type").alias("relation"), "at", "score")
