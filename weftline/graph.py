"""A graph of five tables: built from model files, saved, loaded, and queried by SQL views."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.expressions import model_of
from weftline.functions.lineage import settled
from weftline.operators import communities as com
from weftline.operators import extract, reconcile, text, vector
from weftline.schema import ATTRIBUTES
from weftline.sources import reader

TABLES = ("documents", "chunks", "entities", "communities", "relations")


@dataclass
class Graph:
    documents: DataFrame
    chunks: DataFrame
    entities: DataFrame
    communities: DataFrame
    relations: DataFrame

    def save(self, folder: str) -> None:
        """Write all tables, replacing what was there; relations by type, and sorted by kind so that row groups can be skipped."""
        for f in fields(self):
            df: DataFrame = getattr(self, f.name)
            if f.name == "relations" and "relationship_type" in df.columns:
                df = df.sortWithinPartitions("type", "relationship_type", "src")
            writer = df.write.mode("overwrite")
            (writer.partitionBy("type") if f.name == "relations" else writer).parquet(f"{folder}/{f.name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Graph:
        return cls(**{t: spark.read.parquet(f"{folder}/{t}") for t in TABLES})

    @staticmethod
    def drop(spark: SparkSession, folder: str) -> bool:
        """Delete a saved graph's tables, nothing else in the folder; whether there was one."""
        place = spark._jvm.org.apache.hadoop.fs.Path
        fs = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        return any([fs.delete(place(f"{folder}/{t}"), True) for t in TABLES])

    def register(self) -> None:
        """Views of the tables' names."""
        for t in TABLES:
            getattr(self, t).createOrReplaceTempView(t)

    def summary(self) -> DataFrame:
        """(collection, rows)."""
        out = None
        for t in TABLES:
            one = getattr(self, t).agg(F.lit(t).alias("collection"), F.count(F.lit(1)).alias("rows"))
            out = one if out is None else out.unionByName(one)
        return out

    def sql(self, query: str, **args) -> DataFrame:
        self.register()
        return self.documents.sparkSession.sql(query, args=args)


def build(spark: SparkSession, root: str, chunk: int = 1200, extractor: extract.Extractor = extract.identifiers, create: bool = True, strict: bool = False) -> Graph:
    """Read every model file below root: documents, chunks, prose entities, then the stated layer over them, communities, vectors."""
    files = reader.sources(spark, root)
    numbers = settled(reader.models(files))
    documents = settled(reader.documents(files).withColumn("id", F.col("_key")))
    parts = text.chunks(documents.select("id", F.col("content").alias("text"), F.col("files")[0].alias("path")), chunk, ident="id")
    of = documents.select(F.col("id").alias("full_doc_id"), "files", "models")
    chunks = parts.withColumnRenamed("id", "full_doc_id").join(of, "full_doc_id").withColumn("id", F.concat(F.lit("chunk-"), F.sha1(F.concat_ws(":", "full_doc_id", F.col("chunk_order_index").cast("string")))))
    chunks = settled(vector.embed(chunks, "content"))
    named, related, mentions = extract.extract(chunks.select("id", F.col("models")[0].alias("model"), "content"), extractor)
    stamps = reconcile.stamp(named, mentions, chunks.select(F.col("id").alias("src"), F.col("full_doc_id").alias("dst")), documents.select("id", "file_name", "models"))
    null = lambda kind: F.lit(None).cast(kind)
    named = named.drop("models").join(stamps, "id").select(
        "id", "entity_name", "entity_type", "description", "models", "files", F.create_map().cast(ATTRIBUTES).alias("attributes"), null("string").alias("short_name"),
        null("string").alias("source_file"), null("int").alias("source_line"), null("boolean").alias("stated"),
    )
    related = related.select("src", "dst", "type", "relationship_type", F.lit("").alias("description"), null("boolean").alias("stated"), null("string").alias("source_file"), null("int").alias("source_line"))
    elements, stated = reader.read(files, strict)
    entities, edges = reconcile.apply(settled(elements), settled(stated), numbers, settled(named), settled(related), create)
    entities = settled(vector.embed(entities, "description"))
    edges = settled(vector.embed(edges, "description").withColumn("weight", F.lit(1.0)).withColumn("order", F.lit(1)))
    levels = com.hierarchy(edges.select("src", "dst"))
    members = settled(levels.join(entities.select("id", "entity_name", "entity_type"), "id"))
    reports = com.reports(members, entities.count()).withColumn("_key", F.concat_ws("-", F.col("level").cast("string"), F.sha1("cluster")))
    reports = vector.embed(reports.withColumn("report_string", F.concat_ws(": ", "title", "report_json.summary")), "report_string")
    belongs = members.select(F.col("id").alias("src"), F.concat_ws("-", F.col("level").cast("string"), F.sha1("cluster")).alias("dst"), F.lit("IN_COMMUNITY").alias("type"))
    key = lambda level, cluster: F.concat_ws("-", F.lit(level), F.sha1(cluster))
    within = com.nested(levels).select(key("1", "cluster").alias("src"), key("0", "within").alias("dst"), F.lit("SUB_COMMUNITY_OF").alias("type"))
    parts_of = chunks.select(F.col("id").alias("src"), F.col("full_doc_id").alias("dst"), F.lit("PART_OF").alias("type"))
    kept = mentions.join(entities.select(F.col("id").alias("src")), "src", "left_semi")
    relations = edges.unionByName(belongs.unionByName(within).unionByName(parts_of).unionByName(kept), allowMissingColumns=True)
    return Graph(documents, chunks, entities, reports, relations)


def model_files(documents: DataFrame) -> DataFrame:
    """(model, files) of a graph's documents."""
    return documents.select(F.explode("files").alias("path")).groupBy(model_of(F.col("path")).alias("model")).agg(F.count(F.lit(1)).alias("files"))
