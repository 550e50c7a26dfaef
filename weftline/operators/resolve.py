"""References to declarations: suffixes, nearest scopes, inherited features, aliases and merges."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expressions import alias_key
from weftline.functions.lineage import settled


def upper_path(reference: Column) -> Column:
    """A written path (dots or colons) in upper case, its segments joined by ``::``."""
    return F.upper(F.regexp_replace(F.regexp_replace(F.trim(reference), "^['\"]+|['\"]+$", ""), r"\s*[.:]+\s*", "::"))


def suffixes(elements: DataFrame) -> DataFrame:
    """(model, suffix, qualified): a row for every trailing part of every qualified name."""
    segments = F.split(F.upper("qualified"), "::")
    starts = F.sequence(F.lit(1), F.size(segments))
    every = F.transform(starts, lambda i: F.array_join(F.slice(segments, i, F.size(segments)), "::"))
    return elements.select("model", F.explode(every).alias("suffix"), F.col("qualified").alias("hit"))


def shared_prefix(a: Column, b: Column) -> Column:
    """The number of leading segments that two upper-case paths share."""
    same = F.zip_with(F.split(a, "::"), F.split(b, "::"), lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    return F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda s, x: F.struct((s["n"] + F.when(s["go"] & x, 1).otherwise(0)).alias("n"), (s["go"] & x).alias("go")), lambda s: s["n"])


def nearest(references: DataFrame, index: DataFrame, ident: str = "ref_id") -> DataFrame:
    """``(ref_id, hit)`` for references (ref_id, model, reference, source): the declaration each one names.

    One declaration of that suffix is it. Of several, the one that shares most leading segments
    with ``source``, then the shallowest; an exact tie names none.
    """
    asked = references.select(ident, "model", upper_path(F.col("reference")).alias("suffix"), F.upper(F.coalesce("source", F.lit(""))).alias("_here"))
    hits = asked.join(index, ["model", "suffix"])
    there = F.upper("hit")
    hits = hits.withColumn("_order", F.struct((-shared_prefix(F.col("_here"), there)).alias("near"), F.size(F.split(there, "::")).alias("depth")))
    best = hits.groupBy(ident).agg(F.min("_order").alias("_best"), F.count(F.lit(1)).alias("_n"))
    top = hits.join(best, ident).where((F.col("_n") == 1) | (F.col("_order") == F.col("_best")))
    return top.groupBy(ident).agg(F.count(F.lit(1)).alias("n"), F.min("hit").alias("hit")).where("n = 1").select(ident, "hit")


def scopes(elements: DataFrame, depth: int = 5) -> DataFrame:
    """``(model, qualified, scope, step)``: where features of an element can be declared, nearest first.

    Its own body, then the definitions that type it and that those specialise, ``depth`` levels
    in all; step orders them breadth first.
    """
    index = suffixes(elements)
    typed = F.when(F.length(F.coalesce("typed", F.lit(""))) > 0, F.array("typed")).otherwise(F.array().cast("array<string>"))
    up = elements.select("model", F.col("qualified").alias("source"), F.posexplode(F.concat(typed, F.coalesce("specializes", F.array().cast("array<string>")))).alias("nth", "reference"))
    up = up.withColumn("ref_id", F.struct("model", "source", "nth"))
    found = nearest(up, index).select("ref_id.*", "hit")
    links = found.select("model", F.col("source").alias("scope"), "nth", F.col("hit").alias("next"))
    start = elements.select("model", "qualified", F.col("qualified").alias("scope"), F.array(F.lit(0)).alias("way"))
    out = level = start
    for _ in range(depth - 1):
        level = level.join(links, ["model", "scope"]).select("model", "qualified", F.col("next").alias("scope"), F.concat("way", F.array("nth")).alias("way"))
        out = out.unionByName(level)
    first = F.struct(F.size("way").alias("level"), "way")
    out = out.groupBy("model", "qualified", "scope").agg(F.min(first).alias("_first"))
    order = Window.partitionBy("model", "qualified").orderBy("_first")
    return out.select("model", "qualified", "scope", F.row_number().over(order).alias("step"))


def follow(references: DataFrame, elements: DataFrame, ident: str = "ref_id") -> DataFrame:
    """``(ref_id, hit)`` for dotted feature paths: each segment is a feature of a scope of the one before."""
    parts = F.filter(F.split(F.regexp_replace(F.trim("reference"), "^['\"]+|['\"]+$", ""), r"\."), lambda s: s != "")
    paths = references.withColumn("_parts", parts).where(F.size("_parts") >= 2)
    owner = F.regexp_replace(F.upper("qualified"), "::[^:]*$", "")
    children = settled(elements.where(F.col("qualified").contains("::")).groupBy("model", owner.alias("_scope"), F.element_at(F.split(F.upper("qualified"), "::"), -1).alias("_name")).agg(F.max("qualified").alias("_child")))
    around = settled(scopes(elements).select("model", F.col("qualified").alias("hit"), F.upper("scope").alias("_scope"), "step"))
    heads = paths.select(ident, "model", F.col("_parts")[0].alias("reference"), "source")
    at = nearest(heads, suffixes(elements), ident).join(paths.select(ident, "model", "_parts"), ident)
    done = None
    for i in count(1):  # until the longest path has ended
        here = at.where(F.size("_parts") > i).withColumn("_name", F.upper(F.col("_parts")[i]))
        step = here.join(around, ["model", "hit"]).join(children, ["model", "_scope", "_name"])
        at = settled(step.groupBy(ident).agg(F.min_by("_child", "step").alias("hit")).join(paths.select(ident, "model", "_parts"), ident))
        ended = at.where(F.size("_parts") == i + 1).select(ident, "hit")
        done = ended if done is None else done.unionByName(ended)
        if at.where(F.size("_parts") > i + 1).isEmpty():
            break
    return done


def merges(rows: DataFrame, declarations: DataFrame) -> DataFrame:
    """``(id, into)``: rows that are a second, short name of one declared row.

    rows: (id, name, model). declarations: (id, name, short, model), ids of rows. An alias of
    one character, or one that several declarations of a model claim, merges nothing.
    """
    written = F.array(F.col("short"), F.concat_ws(" ", "short", "name"))
    claims = declarations.where(F.length(F.coalesce("short", F.lit(""))) > 0).select("model", F.col("id").alias("into"), F.explode(written).alias("_written"))
    claims = claims.select("model", "into", alias_key(F.col("_written")).alias("alias")).where(F.length("alias") > 1)
    sole = claims.groupBy("model", "alias").agg(F.countDistinct("into").alias("n"), F.min("into").alias("into")).where("n = 1").drop("n")
    free = rows.join(declarations.select("id").distinct(), "id", "left_anti")
    return free.select("id", "model", alias_key(F.col("name")).alias("alias")).join(sole, ["model", "alias"]).groupBy("id").agg(F.max_by("into", "model").alias("into"))
