"""The relational tables seen as a property graph.

Vertices are the rows of region, nation, customer, supplier, part and orders, and one vertex per
brand; edges are their keys. Everything stays lazy: a query that asks for one kind of vertex or
edge reads that table only, since the other branches of the union fold away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.schema import ATTRIBUTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _value(value=None, unit=None, text=None, expression=None) -> Column:
    return F.struct(
        (F.lit(None) if value is None else value).cast("double").alias("value"), (F.lit(None) if text is None else text).cast("string").alias("text"),
        F.lit(unit).cast("string").alias("unit"), (F.lit(None) if expression is None else F.lit(expression)).cast("string").alias("expression"),
    )


def _map(*pairs: tuple[str, Column]) -> Column:
    if not pairs:
        return F.lit(None).cast(ATTRIBUTES)
    return F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices with ``id`` = table/key. One in ten has no source file, one in three is in two files."""

    def make(name: str, key: str, title: Column, models: Column, attributes: Column, short: Column | None = None) -> DataFrame:
        t = table(spark, sf_dir, name)
        k = F.col(key).cast("long")
        file = F.lit(f"{name}.tbl")
        return t.select(
            F.concat(F.lit(f"{name}/"), k.cast("string")).alias("id"),
            k.alias("key"),
            F.upper(title).alias("entity_name"),
            F.lit(name).alias("entity_type"),
            F.concat(title, F.lit(" is a "), F.lit(name)).alias("description"),
            attributes.alias("attributes"),
            (F.lit(None).cast("string") if short is None else short).alias("short_name"),
            F.when(k % 10 != 0, file).alias("source_file"),
            F.when(k % 10 != 0, k + 1).cast("int").alias("source_line"),
            F.when(k % 3 == 0, F.array(file, F.lit("shared.tbl"))).otherwise(F.array(file)).alias("files"),
            models.alias("models"),
        )

    sales, supply = F.array(F.lit("sales")), F.array(F.lit("supply"))
    both = F.array(F.lit("sales"), F.lit("supply"))
    part_map = _map(("retailPrice", _value(F.col("p_retailprice"), "$")), ("size", _value(F.col("p_size"))), ("finish", _value(text=F.col("p_type"))), ("netCost", _value(expression="retailPrice * 0.8")))
    out = make("region", "r_regionkey", F.col("r_name"), sales, _map())
    for other in (
        make("nation", "n_nationkey", F.col("n_name"), F.when(F.col("n_nationkey") % 4 == 0, both).otherwise(sales), _map()),
        make("customer", "c_custkey", F.col("c_name"), sales, _map(("acctbal", _value(F.col("c_acctbal"), "$"))), F.concat(F.lit("ID-"), F.col("c_custkey").cast("string"))),
        make("supplier", "s_suppkey", F.col("s_name"), supply, _map(("acctbal", _value(F.col("s_acctbal"), "$")))),
        make("part", "p_partkey", F.col("p_name"), supply, part_map, F.concat(F.lit("P-"), F.col("p_partkey").cast("string"))),
        make("orders", "o_orderkey", F.concat(F.lit("ID-"), F.col("o_orderkey").cast("string")), sales, _map(("totalPrice", _value(F.col("o_totalprice"), "$")))),
    ):
        out = out.unionByName(other)
    return out


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges (src, dst, type, relationship_type, stated): owns, connects, satisfies and typedby."""

    def vertex(name: str, key: str) -> Column:
        return F.concat(F.lit(f"{name}/"), F.col(key).cast("string"))

    def make(df: DataFrame, src: Column, dst: Column, kind: str, stated: Column) -> DataFrame:
        return df.select(src.alias("src"), dst.alias("dst"), F.lit("RELATED_TO").alias("type"), F.lit(kind).alias("relationship_type"), stated.alias("stated"))

    yes, absent = F.lit(True), F.lit(None).cast("boolean")
    t = lambda name: table(spark, sf_dir, name)
    out = make(t("nation"), vertex("region", "n_regionkey"), vertex("nation", "n_nationkey"), "owns", yes)
    out = out.unionByName(make(t("customer"), vertex("nation", "c_nationkey"), vertex("customer", "c_custkey"), "owns", yes))
    out = out.unionByName(make(t("supplier"), vertex("nation", "s_nationkey"), vertex("supplier", "s_suppkey"), "owns", yes))
    out = out.unionByName(make(t("orders"), vertex("customer", "o_custkey"), vertex("orders", "o_orderkey"), "owns", yes))
    pairs = t("lineitem").select("l_orderkey", "l_partkey").distinct()
    out = out.unionByName(make(pairs, vertex("orders", "l_orderkey"), vertex("part", "l_partkey"), "connects", absent))
    supplied = t("lineitem").where("l_linenumber = 1 and l_quantity > 40").groupBy("l_suppkey", "l_partkey").agg(F.max(F.col("l_returnflag") != "R").alias("kept"))
    out = out.unionByName(make(supplied, vertex("supplier", "l_suppkey"), vertex("part", "l_partkey"), "satisfies", F.when(F.col("kept"), F.lit(True))))
    return out.unionByName(make(t("part"), vertex("part", "p_partkey"), F.concat(F.lit("brand/"), F.col("p_brand")), "typedby", yes))


# The same graph as DuckDB common table expressions, for the oracle. ``attrs`` is the attribute map, a row per entry.


def _entity_sql(name: str, key: str, title: str, models: str, short: str = "NULL") -> str:
    return f"""SELECT '{name}/' || {key} AS id, CAST({key} AS BIGINT) AS key, upper({title}) AS entity_name, '{name}' AS entity_type, {title} || ' is a {name}' AS description,
  CAST({short} AS VARCHAR) AS short_name, CASE WHEN {key} % 10 <> 0 THEN '{name}.tbl' END AS source_file, CASE WHEN {key} % 10 <> 0 THEN CAST({key} + 1 AS INTEGER) END AS source_line,
  CASE WHEN {key} % 3 = 0 THEN ['{name}.tbl', 'shared.tbl'] ELSE ['{name}.tbl'] END AS files, {models} AS models FROM {name}"""


def _attr_sql(name: str, key: str, attr: str, value: str = "NULL", unit: str = "NULL", text: str = "NULL", expression: str = "NULL") -> str:
    return f"SELECT '{name}/' || {key} AS id, '{attr}' AS name, CAST({value} AS DOUBLE) AS value, CAST({text} AS VARCHAR) AS text, CAST({unit} AS VARCHAR) AS unit, CAST({expression} AS VARCHAR) AS expression FROM {name}"


ENTITIES_SQL = "\nUNION ALL ".join(
    [
        _entity_sql("region", "r_regionkey", "r_name", "['sales']"),
        _entity_sql("nation", "n_nationkey", "n_name", "CASE WHEN n_nationkey % 4 = 0 THEN ['sales', 'supply'] ELSE ['sales'] END"),
        _entity_sql("customer", "c_custkey", "c_name", "['sales']", "'ID-' || c_custkey"),
        _entity_sql("supplier", "s_suppkey", "s_name", "['supply']"),
        _entity_sql("part", "p_partkey", "p_name", "['supply']", "'P-' || p_partkey"),
        _entity_sql("orders", "o_orderkey", "('ID-' || o_orderkey)", "['sales']"),
    ]
)
ATTRS_SQL = "\nUNION ALL ".join(
    [
        _attr_sql("customer", "c_custkey", "acctbal", "c_acctbal", "'$'"),
        _attr_sql("supplier", "s_suppkey", "acctbal", "s_acctbal", "'$'"),
        _attr_sql("part", "p_partkey", "retailPrice", "p_retailprice", "'$'"),
        _attr_sql("part", "p_partkey", "size", "p_size"),
        _attr_sql("part", "p_partkey", "finish", text="p_type"),
        _attr_sql("part", "p_partkey", "netCost", expression="'retailPrice * 0.8'"),
        _attr_sql("orders", "o_orderkey", "totalPrice", "o_totalprice", "'$'"),
    ]
)


def _edge_sql(source: str, src: str, dst: str, kind: str, stated: str) -> str:
    return f"SELECT {src} AS src, {dst} AS dst, 'RELATED_TO' AS type, '{kind}' AS relationship_type, CAST({stated} AS BOOLEAN) AS stated FROM {source}"


RELATIONS_SQL = "\nUNION ALL ".join(
    [
        _edge_sql("nation", "'region/' || n_regionkey", "'nation/' || n_nationkey", "owns", "true"),
        _edge_sql("customer", "'nation/' || c_nationkey", "'customer/' || c_custkey", "owns", "true"),
        _edge_sql("supplier", "'nation/' || s_nationkey", "'supplier/' || s_suppkey", "owns", "true"),
        _edge_sql("orders", "'customer/' || o_custkey", "'orders/' || o_orderkey", "owns", "true"),
        _edge_sql("(SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)", "'orders/' || l_orderkey", "'part/' || l_partkey", "connects", "NULL"),
        _edge_sql("(SELECT l_suppkey, l_partkey, bool_or(l_returnflag <> 'R') AS kept FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 40 GROUP BY ALL)", "'supplier/' || l_suppkey", "'part/' || l_partkey", "satisfies", "CASE WHEN kept THEN true END"),
        _edge_sql("part", "'part/' || p_partkey", "'brand/' || p_brand", "typedby", "true"),
    ]
)
GRAPH_SQL = f"entities AS ({ENTITIES_SQL}),\nattrs AS ({ATTRS_SQL}),\nrelations AS ({RELATIONS_SQL})"
