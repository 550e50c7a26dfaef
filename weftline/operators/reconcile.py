"""One graph out of read declarations and extracted names: the stated layer wins.

The order matters and is fixed: merge second names, annotate, create what is missing, merge
again, make short names searchable, resolve edges, drop old stated edges, add the new ones, drop
loops, drop inferred edges of declared kinds, drop inferred twins of stated edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expressions import entity_key, is_stated, model_of
from weftline.functions.lineage import settled
from weftline.operators import resolve
from weftline.operators.naming import disambiguate
from weftline.schema import ATTRIBUTES, DECLARED


def repoint(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges (src, dst, ...) with merged ids replaced; loops go, and of equal edges one stays (the least by all columns)."""
    a = merged.select(F.col("id").alias("src"), F.col("into").alias("_a"))
    b = merged.select(F.col("id").alias("dst"), F.col("into").alias("_b"))
    out = edges.join(a, "src", "left").join(b, "dst", "left").withColumn("src", F.coalesce("_a", "src")).withColumn("dst", F.coalesce("_b", "dst")).drop("_a", "_b")
    return one_of_equal(without_loops(out)).select(edges.columns)


def without_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src") != F.col("dst"))


def one_of_equal(edges: DataFrame, keys: tuple[str, ...] = ("src", "dst", "type", "relationship_type")) -> DataFrame:
    rest = [c for c in edges.columns if c not in keys and not isinstance(edges.schema[c].dataType, type(ATTRIBUTES))]
    order = [F.col(c).asc_nulls_last() for c in rest] or [F.lit(1)]
    return edges.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def supersede(edges: DataFrame) -> DataFrame:
    """Drop inferred edges of declared kinds, and inferred edges that have a stated twin."""
    stated = edges.where(is_stated()).select("src", "dst", "relationship_type").distinct()
    inferred = edges.where(~is_stated() & (F.col("type") == "RELATED_TO"))
    kept = inferred.where(~F.coalesce(F.col("relationship_type").isin(*DECLARED), F.lit(False))).join(stated, ["src", "dst", "relationship_type"], "left_anti")
    return edges.where(is_stated() | (F.col("type") != "RELATED_TO")).unionByName(kept.select(edges.columns))


def described(element: str = "name") -> F.Column:
    """What a declaration is, in one line: kind, name, its type and where it stands."""
    typed = F.when(F.length(F.coalesce("typed", F.lit(""))) > 0, F.concat(F.lit(" : "), "typed"))
    return F.concat_ws("", F.initcap("kind"), F.lit(" "), element, typed, F.lit(" ("), "qualified", F.lit("; "), "file", F.lit(" line "), F.col("line").cast("string"), F.lit(")"))


def searchable(entities: DataFrame) -> DataFrame:
    """The short name is added to the description, once."""
    missing = F.col("short_name").isNotNull() & ~F.coalesce(F.col("description").contains(F.col("short_name")), F.lit(False))
    return entities.withColumn("description", F.when(missing, F.concat_ws(" ", "description", F.concat(F.lit("["), "short_name", F.lit("]")))).otherwise(F.col("description")))


def stated_edges(relations: DataFrame, elements: DataFrame) -> DataFrame:
    """Relations as written -> ``(src, dst, type)`` between qualified names; unresolved and ambiguous ones are dropped.

    Both ends are looked up with the relation's own source as the scope.
    """
    rows = relations.withColumn("model", model_of(F.col("file"))).withColumn("ref_id", F.struct("model", "from", "to", "type", "file", "line", "seq"))
    index = resolve.suffixes(elements)

    def end(column: str) -> DataFrame:
        asked = rows.select("ref_id", "model", F.col(column).alias("reference"), F.col("from").alias("source"))
        near = resolve.nearest(asked, index)
        far = resolve.follow(asked, elements).join(near, "ref_id", "left_anti")
        return near.unionByName(far)

    a = end("from").withColumnRenamed("hit", "src")
    b = end("to").withColumnRenamed("hit", "dst")
    found = rows.join(a, "ref_id").join(b, "ref_id").where(F.col("src") != F.col("dst"))
    last = Window.partitionBy("model", "src", "dst", "type").orderBy(F.col("file").desc(), F.col("seq").desc())
    return found.withColumn("_n", F.row_number().over(last)).where("_n = 1").select("model", "src", "dst", "type", "from", "to", "file", "line")


def apply(elements: DataFrame, relations: DataFrame, numbers: DataFrame, entities: DataFrame, edges: DataFrame, create: bool = True) -> tuple[DataFrame, DataFrame]:
    """The reconciled (entities, edges).

    elements and relations come from the reader, numbers is (model, import_number), entities and
    edges are what extraction made: (id, entity_name, entity_type, description, models, files,
    attributes, short_name, source_file, source_line, stated) and (src, dst, type,
    relationship_type, description, stated, source_file, source_line).
    """
    named = disambiguate(elements.withColumn("model", model_of(F.col("file"))))
    named = settled(named.join(numbers, "model"))
    sole = F.col("display") == F.upper("name")

    def known(rows: DataFrame) -> DataFrame:
        """(model, lookup, id): extracted rows by their name and its last segment, one per model and name."""
        forms = F.array_distinct(F.array(F.upper("entity_name"), F.element_at(F.split(F.upper("entity_name"), "::"), -1)))
        each = rows.select("id", forms.alias("_f"), F.explode("models").alias("model")).select("id", "model", F.explode("_f").alias("lookup"))
        return each.groupBy("model", "lookup").agg(F.min("id").alias("id"))

    def second_names(rows: DataFrame, ids: DataFrame) -> DataFrame:
        of = ids.select("id", "name", "short", "model")
        return resolve.merges(rows.select("id", F.col("entity_name").alias("name"), F.explode("models").alias("model")), of)

    def fold(rows: DataFrame, links: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        merged = settled(second_names(rows, ids))
        prose = merged.join(rows.select("id", F.col("description").alias("_d")), "id").groupBy("into").agg(F.min("_d").alias("_d"))
        rows = rows.join(merged.select("id"), "id", "left_anti").join(prose.withColumnRenamed("into", "id"), "id", "left")
        rows = rows.withColumn("description", F.when(is_stated() & F.col("_d").isNotNull(), F.col("_d")).otherwise(F.col("description"))).drop("_d")
        return settled(rows), settled(repoint(links, merged))

    def identified(rows: DataFrame) -> DataFrame:
        """Elements with the id of the row that is theirs, null if there is none."""
        ids = known(rows).withColumnRenamed("model", "_km")
        match = (F.col("model") == F.col("_km")) & (F.col("display") == F.col("lookup")) & sole
        return named.join(ids, match, "left").drop("_km", "lookup")

    entities, edges = fold(entities, edges, identified(entities).where("id is not null"))
    mine = settled(identified(entities))
    notes = mine.where("id is not null").groupBy("id").agg(*[F.max_by(c, F.struct("file", "line")).alias(f"_{c}") for c in ("file", "line", "attributes", "short")])
    entities = entities.join(notes, "id", "left")
    entities = entities.withColumn("source_file", F.coalesce("_file", "source_file")).withColumn("source_line", F.coalesce("_line", "source_line"))
    entities = entities.withColumn("attributes", F.when(F.size(F.coalesce(F.map_keys("_attributes"), F.array())) > 0, F.col("_attributes")).otherwise(F.col("attributes")))
    entities = entities.withColumn("short_name", F.coalesce(F.nullif("_short", F.lit("")), "short_name")).drop("_file", "_line", "_attributes", "_short")
    own = entity_key(F.col("display"), F.col("import_number"))
    if create:
        made = mine.where("id is null").groupBy(own.alias("id")).agg(
            F.first("display").alias("entity_name"), F.max_by("kind", "line").alias("entity_type"), F.max_by(described(), "line").alias("description"), F.array(F.first("model")).alias("models"),
            F.array(F.max_by("file", "line")).alias("files"), F.max_by("attributes", "line").alias("attributes"), F.nullif(F.max_by("short", "line"), F.lit("")).alias("short_name"), F.max_by("file", "line").alias("source_file"),
            F.max("line").alias("source_line"), F.lit(True).alias("stated"),
        )
        entities = settled(entities.unionByName(made.select(entities.columns)))
        entities, edges = fold(entities, edges, identified(entities).where("id is not null"))
    entities = searchable(entities)
    keyed = identified(entities).select("model", "qualified", F.coalesce("id", own).alias("id"))
    written = stated_edges(relations, named)
    for column in ("src", "dst"):
        written = written.join(keyed.select("model", F.col("qualified").alias(column), F.col("id").alias(f"_{column}")), ["model", column])
    new = written.select(
        F.col("_src").alias("src"), F.col("_dst").alias("dst"), F.lit("RELATED_TO").alias("type"), F.col("type").alias("relationship_type"),
        F.concat("from", F.lit(" "), "type", F.lit(" "), "to").alias("description"), F.lit(True).alias("stated"), F.col("file").alias("source_file"), F.col("line").alias("source_line"),
    )
    edges = edges.where(~is_stated()).select(new.columns).unionByName(one_of_equal(without_loops(new)))
    return entities, supersede(without_loops(edges))


def upsert(old: DataFrame, new: DataFrame, key: str, mode: str = "update") -> DataFrame:
    """Rows of both by key. ``update``: a column that the new row leaves null keeps its old value; ``replace``: the new row as it is."""
    if mode == "replace":
        return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True).select(old.columns)
    fresh = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key])
    both = old.join(fresh, F.col(key) == F.col("_k"), "full")
    cols = [F.coalesce("_k", key).alias(key) if c == key else F.coalesce(f"_n_{c}", c).alias(c) if c in new.columns else F.col(c) for c in old.columns]
    return both.select(cols)


def stamp(entities: DataFrame, mentions: DataFrame, chunk_of: DataFrame, documents: DataFrame) -> DataFrame:
    """(id, files, models): sorted distinct provenance of entities through their chunks' documents."""
    hops = mentions.select(F.col("src").alias("id"), F.col("dst").alias("chunk")).join(chunk_of.select(F.col("src").alias("chunk"), F.col("dst").alias("document")), "chunk")
    named = hops.join(documents.select(F.col("id").alias("document"), "file_name", "models"), "document")
    files = F.array_sort(F.collect_set("file_name")).alias("files")
    models = F.array_sort(F.array_distinct(F.flatten(F.collect_set("models")))).alias("models")
    return entities.select("id").join(named.groupBy("id").agg(files, models), "id", "left").select("id", F.coalesce("files", F.array().cast("array<string>")).alias("files"), F.coalesce("models", F.array().cast("array<string>")).alias("models"))
