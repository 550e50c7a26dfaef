"""Walks over an edge table (src, dst, ...).

Predicates on the whole path prune while the walk expands: a step joins only the allowed edges.
Reachability keeps one row per (start, vertex), so the rows of a step are bounded by pairs
reached rather than by paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.lineage import settled

OUT, IN, ANY = "outbound", "inbound", "any"


def oriented(edges: DataFrame, direction: str = OUT) -> DataFrame:
    """Edges as (at, to, direction, ...): as written, reversed, or both (a loop only once)."""
    forward = edges.withColumnRenamed("src", "at").withColumnRenamed("dst", "to").withColumn("direction", F.lit("outgoing"))
    back = edges.select(F.col("dst").alias("at"), F.col("src").alias("to"), *[c for c in edges.columns if c not in ("src", "dst")]).withColumn("direction", F.lit("incoming"))
    if direction == OUT:
        return forward
    if direction == IN:
        return back
    return forward.unionByName(back.where("at <> to"))


def neighbors(starts: DataFrame, edges: DataFrame, direction: str = ANY, start: str = "id") -> DataFrame:
    """Starts joined to their edges, one hop."""
    return starts.join(oriented(edges, direction), F.col(start) == F.col("at")).drop("at")


def reach(starts: DataFrame, edges: DataFrame, least: int = 1, most: int = 6, direction: str = OUT, where: Column | None = None, last: Column | None = None, start: str = "id") -> DataFrame:
    """``(start, vertex, depth)``: vertices reached in ``least`` to ``most`` steps, each at its least depth.

    where: holds for every edge of the path (the walk is pruned). last: holds for the last edge
    only, which earlier steps may violate. A pair that was reached before isn't expanded again (with
    ``least`` above 1 it may have to be), and the walk ends where a step finds nothing new.
    """
    steps = oriented(edges if where is None else edges.where(where), direction)
    every = steps.select("at", "to").distinct()
    if most > 2:  # every step reads the edges
        every = settled(every)
    final = every if last is None else steps.where(last).select("at", "to").distinct()
    front = starts.select(F.col(start).alias("start")).distinct().withColumn("vertex", F.col("start")).withColumn("depth", F.lit(0))
    out = seen = front if least == 0 else None
    once = most > 2 and least <= 1
    for depth in range(1, most + 1):
        before = front

        def moved(by: DataFrame, before: DataFrame = before, depth: int = depth) -> DataFrame:
            return before.join(by, before.vertex == by.at).select("start", F.col("to").alias("vertex")).distinct().withColumn("depth", F.lit(depth))

        if depth < most or last is None:
            front = moved(every)
            if once and seen is not None:
                front = front.join(seen.select("start", "vertex"), ["start", "vertex"], "left_anti")
            if most > 2 and depth < most:  # else every step would compute all those before it again
                front = settled(front)
            if once:
                seen = front if seen is None else seen.unionByName(front)
        if depth >= least:
            found = front if last is None else moved(final)
            out = found if out is None else out.unionByName(found)
        if most > 2 and depth < most and front.isEmpty():
            break
    if once and last is None:  # no pair occurs twice
        return out
    if out is None:  # the walk ended before ``least`` steps
        out = front
    return out.groupBy("start", "vertex").agg(F.min("depth").alias("depth"))


def paths(starts: DataFrame, edges: DataFrame, least: int = 1, most: int = 6, direction: str = OUT, where: Column | None = None, unique: str = "vertices", start: str = "id") -> DataFrame:
    """``(start, vertex, depth, path)`` of every path; no vertex (or no edge) occurs twice on one."""
    steps = oriented(edges if where is None else edges.where(where), direction).select("at", "to")
    front = starts.select(F.col(start).alias("start"), F.col(start).alias("vertex"), F.array(start).alias("path"))
    out = front.withColumn("depth", F.lit(0)) if least == 0 else None
    for depth in range(1, most + 1):
        moved = front.join(steps, front.vertex == steps.at)
        if unique == "vertices":
            moved = moved.where(~F.array_contains("path", F.col("to")))
        else:
            hops = F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("a"), F.slice("path", 2, F.size("path")).alias("b"))
            moved = moved.where(~F.exists(hops, lambda h: (h["a"] == F.col("vertex")) & (h["b"] == F.col("to"))))
        front = moved.select("start", F.col("to").alias("vertex"), F.concat("path", F.array("to")).alias("path"))
        if depth >= least:
            found = front.withColumn("depth", F.lit(depth))
            out = found if out is None else out.unionByName(found)
    return out


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, degree)``: the number of edge ends at each vertex."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def dependency_tree(edges: DataFrame, root: str) -> DataFrame:
    """``(vertex, parent, depth, way, label)`` of an import tree from one root.

    Paths expand in the order of names; a vertex on its own path is a ``cycle`` and ends there.
    Of all other places of a vertex the first in depth-first order is its ``first`` and is
    expanded, later ones are ``seen`` and are not.
    """
    every = edges.select("src", "dst").distinct()
    front = edges.sparkSession.range(1).select(F.lit(root).alias("vertex"), F.lit(None).cast("string").alias("parent"), F.array(F.lit(root)).alias("way"), F.lit(False).alias("cycle"))
    out = front
    while True:  # a path ends where it meets itself
        front = front.where("not cycle").join(every, F.col("vertex") == F.col("src"))
        front = settled(front.select(F.col("dst").alias("vertex"), F.col("src").alias("parent"), F.concat("way", F.array("dst")).alias("way"), F.array_contains("way", F.col("dst")).alias("cycle")))
        if front.isEmpty():
            break
        out = out.unionByName(front)
    # places below a place that isn't its vertex's first are not expanded; parents are settled before children
    out = settled(out.withColumn("depth", F.size("way") - 1))
    first = out.where("not cycle").groupBy("vertex").agg(F.min("way").alias("first_way"))
    kept = out.alias("o")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size("way") - 1, F.lit(1))), lambda i: F.slice("way", F.lit(1), i))
    above = out.where("depth > 0").select("way", F.explode(prefixes).alias("above")).withColumn("v", F.element_at("above", -1))
    hidden = above.join(first, (above.v == first.vertex) & (above.above != first.first_way)).select(F.col("way").alias("h")).distinct()
    kept = out.join(hidden, out.way == hidden.h, "left_anti")
    again = first.select(F.col("vertex").alias("fv"), "first_way")
    label = F.when(F.col("cycle"), "cycle").when(F.col("way") == F.col("first_way"), "first").otherwise("seen")
    return kept.join(again, kept.vertex == again.fv, "left").select("vertex", "parent", "depth", F.array_join("way", ">").alias("way"), label.alias("label"))
