"""Communities of a graph, their members and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.lineage import settled


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every edge end; component is the least id reachable.

    Every round a vertex takes the least label among its own and its neighbours', and then the
    label of that label's vertex, which halves the distances. Labels are cut from their lineage
    by a checkpoint in the shared folder.
    """
    both = settled(edges.select(F.col("src").alias("id"), F.col("dst").alias("other")).unionByName(edges.select(F.col("dst").alias("id"), F.col("src").alias("other"))).distinct())
    labels = settled(both.groupBy("id").agg(F.min("other").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), F.col("component").alias("_c")), "other").groupBy("id").agg(F.min("_c").alias("_c"))
        new = labels.join(near, "id").select("id", F.least("component", "_c").alias("component"))
        jump = new.select(F.col("id").alias("component"), F.col("component").alias("_j"))
        new = settled(new.join(jump, "component").select("id", F.least("component", "_j").alias("component")))
        changed = new.join(labels.withColumnRenamed("component", "_old"), "id").where(F.col("component") != F.col("_old"))
        if changed.isEmpty():
            return new
        labels = new


def label_propagation(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """``(id, community)``: each round a vertex takes the label most of its neighbours have (ties: the least)."""
    both = settled(edges.select(F.col("src").alias("id"), F.col("dst").alias("other")).unionByName(edges.select(F.col("dst").alias("id"), F.col("src").alias("other"))).distinct())
    labels = both.select("id").distinct().withColumn("community", F.col("id"))
    for _ in range(rounds):
        votes = both.join(labels.select(F.col("id").alias("other"), "community"), "other").groupBy("id", "community").agg(F.count(F.lit(1)).alias("n"))
        labels = settled(votes.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "community")).alias("b")).select("id", F.col("b.community").alias("community")))
    return labels


def hierarchy(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """``(id, level, cluster)``: level 0 are components, level 1 the propagated communities within them."""
    coarse = components(edges).select("id", F.lit(0).alias("level"), F.col("component").cast("string").alias("cluster"))
    fine = label_propagation(edges, rounds).select("id", F.lit(1).alias("level"), F.col("community").cast("string").alias("cluster"))
    return coarse.unionByName(fine)


def nested(levels: DataFrame) -> DataFrame:
    """``(cluster, within)``: the component that each propagated community lies in."""
    fine = levels.where("level = 1").select("id", "cluster")
    return fine.join(levels.where("level = 0").select("id", F.col("cluster").alias("within")), "id").select("cluster", "within").distinct()


def reports(members: DataFrame, corpus_size: int) -> DataFrame:
    """A report per (level, cluster) of members (id, level, cluster, entity_name, entity_type): title, occurrence, findings."""
    kinds = members.groupBy("level", "cluster", "entity_type").agg(F.count(F.lit(1)).alias("n"), F.min("entity_name").alias("example"))
    out = kinds.groupBy("level", "cluster").agg(
        F.sum("n").alias("size"),
        F.min("example").alias("title"),
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.concat(F.col("n").cast("string"), F.lit(" x "), "entity_type").alias("summary"), F.concat(F.lit("for example "), "example").alias("explanation")))).alias("_f"),
    )
    findings = F.transform("_f", lambda f: F.struct(f["summary"].alias("summary"), f["explanation"].alias("explanation")))
    summary = F.array_join(F.transform("_f", lambda f: f["summary"]), ", ")
    occurrence = F.col("size") / F.lit(float(max(1, corpus_size)))
    rating = F.least(F.lit(10.0), F.log2(F.col("size") + 1))
    return out.select("level", "cluster", "title", occurrence.alias("occurrence"), "size", F.struct("title", summary.alias("summary"), rating.alias("rating"), F.lit("by size").alias("rating_explanation"), findings.alias("findings")).alias("report_json"))


def normalised_findings(column: str):
    """Findings given as bare strings become ``{summary, explanation: null}``."""
    return F.transform(column, lambda s: F.struct(s.alias("summary"), F.lit(None).cast("string").alias("explanation")))
