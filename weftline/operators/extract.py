"""Entities and relations from prose, by rules: the offline stand-in for a language model.

An entity is an identifier that prose names: a quoted name or a word with an inner capital or
digit. Two that stand in one chunk are related. What is off the vocabularies is dropped, and rows
of one name within a model are merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.schema import KINDS, RELATIONS

#: (chunks (id, model, content)) -> mentions (id, model, name, kind, description)
Extractor = Callable[[DataFrame], DataFrame]

_IDENTIFIER = r"'([^'\n]{2,60})'|\b([A-Z][a-z0-9]+(?:[A-Z][A-Za-z0-9]*)+|[A-Z]+[0-9-]+[A-Z0-9-]*)\b"


def identifiers(chunks: DataFrame) -> DataFrame:
    """(id, model, name, kind, description): identifiers of each chunk, of the kind that stands before them."""
    found = F.concat(F.regexp_extract_all("content", F.lit(_IDENTIFIER), F.lit(1)), F.regexp_extract_all("content", F.lit(_IDENTIFIER), F.lit(2)))
    rows = chunks.select("id", "model", "content", F.explode(F.array_distinct(F.filter(found, lambda x: x != ""))).alias("name"))
    # the keyword that stands right before the name, if there is one
    lead = F.expr("regexp_replace(substr(content, 1, instr(content, name) - 1), '(def|<[^>]*>|[\\\\s\\'])+$', '')")
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.nullif(F.regexp_extract(lead, r"(\w+)$", 1), F.lit(""))), F.lit("item"))
    sentence = F.substring("content", 1, 200)
    return rows.select("id", "model", F.upper("name").alias("name"), kind.alias("kind"), sentence.alias("description"))


def extract(chunks: DataFrame, extractor: Extractor = identifiers) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, RELATED_TO edges and MENTIONED_IN edges of chunks (id, model, content)."""
    named = extractor(chunks).where(F.col("kind").isin(*KINDS.values()))
    entities = merged(named)
    key = F.concat_ws("/", "model", "name")
    mentions = named.select(key.alias("src"), F.col("id").alias("dst"), F.lit("MENTIONED_IN").alias("type")).distinct()
    # a chunk has a bounded number of words, so its pairs of names are bounded too
    lists = named.groupBy("id", "model").agg(F.array_sort(F.collect_set("name")).alias("names"))
    left = lists.select("id", "model", F.explode("names").alias("a"), "names")
    pairs = left.select("model", "a", F.explode(F.filter("names", lambda b: b > F.col("a"))).alias("b")).groupBy("model", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    related = pairs.select(F.concat_ws("/", "model", "a").alias("src"), F.concat_ws("/", "model", "b").alias("dst"), F.lit("RELATED_TO").alias("type"), F.lit("dependson").alias("relationship_type"), F.col("n").cast("double").alias("weight"))
    return entities, on_vocabulary(related), mentions


def merged(named: DataFrame) -> DataFrame:
    """One row per model and name: the most frequent kind, descriptions joined by a space; models stay apart."""
    kinds = named.groupBy("model", "name", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("model", "name").agg(F.max_by("kind", F.struct("n", "kind")).alias("entity_type"))
    prose = named.groupBy("model", "name").agg(F.array_join(F.array_sort(F.collect_set("description")), " ").alias("description"))
    rows = kinds.join(prose, ["model", "name"])
    return rows.select(F.concat_ws("/", "model", "name").alias("id"), F.col("name").alias("entity_name"), "entity_type", "description", F.array("model").alias("models"))


def on_vocabulary(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("relationship_type").isin(*RELATIONS))


def off_vocabulary(edges: DataFrame) -> DataFrame:
    """(relationship_type, n) of what the vocabulary doesn't know."""
    return edges.where(~F.col("relationship_type").isin(*RELATIONS)).groupBy("relationship_type").agg(F.count(F.lit(1)).alias("n"))
