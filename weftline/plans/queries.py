"""The query collection over the tables' graph, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.expressions import alias_key, attribute, cosine, declared, ends_as, exact_total, has_attributes, is_stated, location, model_of, quantity
from weftline.operators import communities, naming, reconcile, resolve, similarity, text, traverse, vector
from weftline.plans import profile
from weftline.sources import reader, utilities
from weftline.sources.tables import GRAPH_SQL, entities, relations, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def counted(name: str):
    """The number of rows."""
    return F.count(F.lit(1)).alias(name)


def query(sql: str | None = None, graph: bool = True):
    """Register a query under its function's name; ``graph`` puts the graph's tables before the SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            body = sql.strip()
            if graph:
                body = f"WITH RECURSIVE {GRAPH_SQL}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {GRAPH_SQL}\n{body}"
            ORACLES[f.__name__] = body
        return f

    return register


# --- walks and rollups ---


@query("""
WITH n AS (SELECT r.src AS region, n.dst AS nation FROM relations r JOIN relations n ON n.src = r.src AND n.relationship_type = 'owns' WHERE r.relationship_type = 'owns' AND r.src LIKE 'region/%' GROUP BY ALL),
c AS (SELECT region, dst AS customer FROM n JOIN relations ON src = nation AND relationship_type = 'owns'),
o AS (SELECT region, dst AS ord FROM c JOIN relations ON src = customer AND relationship_type = 'owns')
SELECT e.entity_name AS region, count(*) AS n_orders, CAST(sum(CAST(a.value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM o JOIN entities e ON e.id = o.region JOIN attrs a ON a.id = o.ord AND a.name = 'totalPrice' GROUP BY e.entity_name
""")  # fmt: skip
def rollup_region_totalprice(spark, sf_dir):
    """Order value below each region by containment alone."""
    e = entities(spark, sf_dir)
    starts = e.where("entity_type = 'region'").select("id", "entity_name")
    below = traverse.reach(starts, relations(spark, sf_dir), 1, 3, where=F.col("relationship_type") == "owns")
    values = e.where("entity_type = 'orders'").select(F.col("id").alias("vertex"), attribute("totalPrice").alias("value"))
    found = below.join(values.where("value is not null"), "vertex").join(starts, F.col("start") == F.col("id"))
    return found.groupBy(F.col("entity_name").alias("region")).agg(counted("n_orders"), exact_total(F.col("value")).alias("total"))


@query("""
SELECT 'last' AS filter, count(*) AS reached FROM (
  SELECT DISTINCT a.src AS s, b.dst AS d FROM relations a JOIN relations b ON b.src = a.dst WHERE a.src LIKE 'supplier/%' AND b.relationship_type = 'typedby'
  UNION SELECT src, dst FROM relations WHERE src LIKE 'supplier/%' AND relationship_type = 'typedby')
UNION ALL SELECT 'all', count(*) FROM (SELECT DISTINCT src, dst FROM relations WHERE src LIKE 'supplier/%' AND relationship_type = 'typedby')
""")  # fmt: skip
def rollup_last_edge_trap(spark, sf_dir):
    """A filter on the last edge admits paths that a filter on all edges refuses."""
    e, r = entities(spark, sf_dir).where("entity_type = 'supplier'").select("id"), relations(spark, sf_dir)
    kind = F.col("relationship_type") == "typedby"
    loose = traverse.reach(e, r, 1, 2, last=kind).agg(F.lit("last").alias("filter"), counted("reached"))
    return loose.unionByName(traverse.reach(e, r, 1, 2, where=kind).agg(F.lit("all").alias("filter"), counted("reached")))


@query("""
SELECT e.entity_name AS name, r.relationship_type, 'outgoing' AS direction, r.dst AS other, coalesce(r.stated, false) AS stated FROM entities e JOIN relations r ON r.src = e.id WHERE e.entity_type = 'nation'
UNION ALL SELECT e.entity_name, r.relationship_type, 'incoming', r.src, coalesce(r.stated, false) FROM entities e JOIN relations r ON r.dst = e.id WHERE e.entity_type = 'nation'
""")  # fmt: skip
def neighbors_any(spark, sf_dir):
    """All neighbours of the nations, both directions told apart."""
    starts = entities(spark, sf_dir).where("entity_type = 'nation'").select("id", F.col("entity_name").alias("name"))
    found = traverse.neighbors(starts, relations(spark, sf_dir), traverse.ANY)
    return found.select("name", "relationship_type", "direction", F.col("to").alias("other"), is_stated().alias("stated"))


@query("""
WITH w AS (SELECT e.id AS s, e.id AS v, 0 AS d FROM entities e WHERE e.entity_type = 'supplier'
  UNION SELECT w.s, r.dst, w.d + 1 FROM w JOIN relations r ON r.src = w.v AND r.relationship_type IN ('satisfies', 'typedby') WHERE w.d < 4)
SELECT s AS start, count(*) AS reached, max(d) AS depth FROM (SELECT s, v, min(d) AS d FROM w WHERE d > 0 GROUP BY ALL) GROUP BY s
""")  # fmt: skip
def path_all_in(spark, sf_dir):
    """What suppliers reach over satisfies and typedby edges only."""
    starts = entities(spark, sf_dir).where("entity_type = 'supplier'").select("id")
    found = traverse.reach(starts, relations(spark, sf_dir), 1, 4, where=F.col("relationship_type").isin("satisfies", "typedby"))
    return found.groupBy("start").agg(counted("reached"), F.max("depth").alias("depth"))


@query("""
SELECT id AS start, id AS vertex, 0 AS depth FROM entities WHERE entity_type = 'region'
UNION ALL SELECT src, dst, 1 FROM relations WHERE relationship_type = 'owns' AND src LIKE 'region/%'
UNION ALL SELECT a.src, b.dst, 2 FROM relations a JOIN relations b ON b.src = a.dst AND b.relationship_type = 'owns' WHERE a.relationship_type = 'owns' AND a.src LIKE 'region/%'
""")  # fmt: skip
def zero_hop_included(spark, sf_dir):
    """A walk from 0 includes the element it starts from."""
    starts = entities(spark, sf_dir).where("entity_type = 'region'").select("id")
    return traverse.reach(starts, relations(spark, sf_dir), 0, 2, where=F.col("relationship_type") == "owns")


@query("""
SELECT a.src AS start, c.dst AS vertex, 3 AS depth FROM relations a JOIN relations b ON b.src = a.dst AND b.relationship_type = 'owns' JOIN relations c ON c.src = b.dst AND c.relationship_type = 'owns'
WHERE a.src LIKE 'region/%' AND a.relationship_type = 'owns'
""")  # fmt: skip
def simple_paths(spark, sf_dir):
    """Containment paths of three steps on which no vertex repeats."""
    starts = entities(spark, sf_dir).where("entity_type = 'region'").select("id")
    return traverse.paths(starts, relations(spark, sf_dir), 3, 3, where=F.col("relationship_type") == "owns").select("start", "vertex", "depth")


@query("""
WITH w AS (SELECT id AS s, id AS v, 0 AS d FROM entities WHERE entity_type = 'nation' AND contains(entity_name, replace(upper('nation _1'), ' ', ''))
  UNION SELECT w.s, r.dst, w.d + 1 FROM w JOIN relations r ON r.src = w.v AND r.relationship_type IN ('owns', 'redefines', 'typedby') WHERE w.d < 5)
SELECT o.entity_name AS occurrence, a.id AS element, a.name AS attribute, round(a.value, 4) AS value
FROM (SELECT DISTINCT s, v FROM w WHERE d > 0) JOIN entities o ON o.id = s JOIN attrs a ON a.id = v WHERE a.value IS NOT NULL
""")  # fmt: skip
def occurrence_values(spark, sf_dir):
    """Values of what stands one to five steps below an occurrence that a phrase names."""
    e = entities(spark, sf_dir)
    starts = e.where("entity_type = 'nation'").where(F.col("entity_name").contains(F.replace(F.upper(F.lit("nation _1")), F.lit(" "), F.lit("")))).select("id", "entity_name")
    below = traverse.reach(starts, relations(spark, sf_dir), 1, 5, where=F.col("relationship_type").isin("owns", "redefines", "typedby"))
    values = e.where(has_attributes()).select(F.col("id").alias("vertex"), F.explode("attributes").alias("attribute", "a"))
    found = below.join(values, "vertex").join(starts, F.col("start") == F.col("id")).where("a.value is not null")
    return found.select(F.col("entity_name").alias("occurrence"), F.col("vertex").alias("element"), "attribute", F.round("a.value", 4).alias("value"))


@query("""
WITH s AS (SELECT src AS s, dst AS v FROM relations WHERE relationship_type = 'satisfies' AND stated),
w AS (SELECT s, v FROM s UNION SELECT s, dst FROM s JOIN relations ON src = v AND relationship_type = 'typedby')
SELECT e.entity_name AS supplier, count(*) FILTER (v LIKE 'brand/%') AS types, count(*) FILTER (a.value IS NOT NULL) AS parts, CAST(coalesce(sum(CAST(a.value AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
FROM w JOIN entities e ON e.id = s LEFT JOIN attrs a ON a.id = v AND a.name = 'retailPrice' GROUP BY e.id, e.entity_name
""")  # fmt: skip
def rollup_with_types(spark, sf_dir):
    """What stands below each supplier, the types of parts included: their number and the sum of one attribute."""
    e, r = entities(spark, sf_dir), relations(spark, sf_dir)
    starts = e.where("entity_type = 'supplier'").select("id", "entity_name")
    below = traverse.reach(starts, r, 1, 2, where=(F.col("relationship_type") == "typedby") | (F.col("relationship_type") == "satisfies") & is_stated())
    values = e.where("entity_type = 'part'").select(F.col("id").alias("vertex"), attribute("retailPrice").alias("value"))
    found = below.join(starts, F.col("start") == F.col("id")).join(values, "vertex", "left")
    return found.groupBy("id", F.col("entity_name").alias("supplier")).agg(F.count_if(F.col("vertex").startswith("brand/")).alias("types"), F.count("value").alias("parts"), exact_total(F.col("value")).alias("total")).drop("id")


@query("""
SELECT id, degree, dense_rank() OVER (ORDER BY degree DESC, id) AS place FROM
  (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM relations UNION ALL SELECT dst FROM relations) GROUP BY id) QUALIFY place <= 8
""")  # fmt: skip
def degree_top8(spark, sf_dir):
    """The eight vertices with most edge ends."""
    best = traverse.degrees(relations(spark, sf_dir)).orderBy(F.col("degree").desc(), "id").limit(8)
    return best.select("id", "degree", F.dense_rank().over(Window.orderBy(F.col("degree").desc(), "id")).cast("long").alias("place"))


@query("""
SELECT r.relationship_type, count(*) AS n FROM relations r JOIN entities a ON a.id = r.src JOIN entities b ON b.id = r.dst WHERE len(list_intersect(a.models, b.models)) = 0 GROUP BY ALL
""")
def cross_boundary_edges(spark, sf_dir):
    """Edges whose ends share no model, by kind."""
    e = entities(spark, sf_dir)
    a, b = e.select(F.col("id").alias("src"), F.col("models").alias("_a")), e.select(F.col("id").alias("dst"), F.col("models").alias("_b"))
    return relations(spark, sf_dir).join(a, "src").join(b, "dst").where(~F.arrays_overlap("_a", "_b")).groupBy("relationship_type").agg(counted("n"))


# --- anti-joins, semi-joins and counts ---

_UNSATISFIED = "entity_type = 'part' AND list_contains(models, 'supply') AND source_file IS NOT NULL AND id NOT IN (SELECT dst FROM relations WHERE relationship_type = 'satisfies' AND stated)"


def _unsatisfied(spark, sf_dir):
    met = relations(spark, sf_dir).where((F.col("relationship_type") == "satisfies") & is_stated()).select(F.col("dst").alias("id"))
    wanted = (F.col("entity_type") == "part") & F.array_contains("models", "supply") & declared()
    return entities(spark, sf_dir).where(wanted).join(met, "id", "left_anti")


@query(f"SELECT id, entity_name AS element, source_file || ':' || source_line AS at FROM entities WHERE {_UNSATISFIED}")
def anti_unsatisfied(spark, sf_dir):
    """Declared parts that no stated edge satisfies."""
    return _unsatisfied(spark, sf_dir).select("id", F.col("entity_name").alias("element"), location().alias("at"))


@query(f"SELECT count(*) AS total, coalesce(array_to_string(list_slice(list(id ORDER BY id), 1, 10), ','), '') AS examples FROM entities WHERE {_UNSATISFIED}")
def total_and_examples(spark, sf_dir):
    """The size of a set and ten of it, in one row."""
    rows = _unsatisfied(spark, sf_dir).select("id")
    few = rows.orderBy("id").limit(10).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return rows.agg(counted("total")).join(F.broadcast(few))  # one row each


@query("SELECT id, entity_name FROM entities WHERE entity_type IN ('supplier', 'part') AND source_file IS NOT NULL AND id NOT IN (SELECT src FROM relations WHERE relationship_type = 'satisfies' AND stated UNION SELECT dst FROM relations WHERE relationship_type = 'satisfies' AND stated)")
def anti_either_direction(spark, sf_dir):
    """Declared suppliers and parts at neither end of a stated satisfies edge."""
    r = relations(spark, sf_dir).where((F.col("relationship_type") == "satisfies") & is_stated())
    ends = r.select(F.explode(F.array("src", "dst")).alias("id"))
    return entities(spark, sf_dir).where(F.col("entity_type").isin("supplier", "part") & declared()).join(ends, "id", "left_anti").select("id", "entity_name")


@query("""
SELECT i.src, i.dst FROM (SELECT DISTINCT 'supplier/' || l_suppkey AS src, 'part/' || l_partkey AS dst FROM lineitem WHERE l_returnflag = 'R') i
WHERE EXISTS (SELECT 1 FROM relations s WHERE s.src = i.src AND s.dst = i.dst AND s.relationship_type = 'satisfies' AND s.stated)
""")  # fmt: skip
def semi_superseded(spark, sf_dir):
    """Inferred edges that have a stated twin."""
    inferred = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("supplier/"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("dst")).distinct()
    stated = relations(spark, sf_dir).where((F.col("relationship_type") == "satisfies") & is_stated()).select("src", "dst")
    return inferred.join(stated, ["src", "dst"], "left_semi")


@query("SELECT id, entity_name, coalesce(n, 0) AS n FROM entities LEFT JOIN (SELECT src, count(DISTINCT dst) AS n FROM relations WHERE relationship_type = 'satisfies' AND stated GROUP BY src) ON src = id WHERE entity_type = 'supplier'")
def satisfier_counts(spark, sf_dir):
    """How many parts each supplier satisfies, none counting as 0."""
    n = relations(spark, sf_dir).where((F.col("relationship_type") == "satisfies") & is_stated()).groupBy(F.col("src").alias("id")).agg(F.countDistinct("dst").alias("n"))
    return entities(spark, sf_dir).where("entity_type = 'supplier'").join(n, "id", "left").select("id", "entity_name", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
SELECT a.entity_name AS satisfier, b.entity_name AS requirement, r.src, r.dst, array_to_string(a.files, ',') AS files FROM relations r JOIN entities a ON a.id = r.src JOIN entities b ON b.id = r.dst
WHERE r.relationship_type = 'satisfies' AND r.stated
""")  # fmt: skip
def satisfier_pairs(spark, sf_dir):
    """Both ends of the stated satisfies edges; dangling ends drop out."""
    e = entities(spark, sf_dir)
    a = e.where("entity_type = 'supplier'").select(F.col("id").alias("src"), F.col("entity_name").alias("satisfier"), "files")
    b = e.where("entity_type = 'part'").select(F.col("id").alias("dst"), F.col("entity_name").alias("requirement"))
    r = relations(spark, sf_dir).where((F.col("relationship_type") == "satisfies") & is_stated()).select("src", "dst")
    return r.join(a, "src").join(b, "dst").select("satisfier", "requirement", "src", "dst", F.array_join("files", ",").alias("files"))


@query("SELECT entity_type AS type, count(*) AS n FROM entities WHERE list_contains(models, 'sales') AND source_file IS NOT NULL GROUP BY ALL ORDER BY n DESC, type LIMIT 10")
def count_by_type_topn(spark, sf_dir):
    """Declared elements of a model by kind, ten largest."""
    rows = entities(spark, sf_dir).where(F.array_contains("models", "sales") & declared())
    return rows.groupBy(F.col("entity_type").alias("type")).agg(counted("n")).orderBy(F.col("n").desc(), "type").limit(10)


@query("SELECT m AS model, coalesce(r.stated, false) AS read, r.relationship_type, count(*) AS n FROM relations r JOIN (SELECT id, unnest(models) AS m FROM entities) e ON e.id = r.src GROUP BY ALL")
def relations_by_model_provenance(spark, sf_dir):
    """Relations by model of their source, and whether they were read or inferred."""
    m = entities(spark, sf_dir).select(F.col("id").alias("src"), F.explode("models").alias("model"))
    return relations(spark, sf_dir).join(m, "src").groupBy("model", is_stated().alias("read"), "relationship_type").agg(counted("n"))


@query("""
SELECT count(*) FILTER (id IN (SELECT id FROM attrs)) AS with_attributes, count(short_name) AS with_short_name, count(source_file) AS declared,
  count(*) FILTER (len(models) > 1) AS in_two_models, count(*) FILTER (len(files) > 1) AS in_two_files FROM entities
""")
def fields_filled(spark, sf_dir):
    """How many entities have which fields."""
    return entities(spark, sf_dir).agg(
        F.count_if(has_attributes()).alias("with_attributes"), F.count("short_name").alias("with_short_name"), F.count("source_file").alias("declared"),
        F.count_if(F.size("models") > 1).alias("in_two_models"), F.count_if(F.size("files") > 1).alias("in_two_files"),
    )


@query("SELECT array_to_string(files, ',') AS files, count(*) AS n FROM entities WHERE len(files) > 1 GROUP BY ALL")
def multi_file_entities(spark, sf_dir):
    """Entities of several files, by those files."""
    return entities(spark, sf_dir).where(F.size("files") > 1).groupBy(F.array_join("files", ",").alias("files")).agg(counted("n"))


@query("SELECT id, entity_name, entity_type, array_to_string(models, ',') AS models FROM entities WHERE len(models) > 1")
def multi_model_entities(spark, sf_dir):
    """Entities that belong to several models."""
    return entities(spark, sf_dir).where(F.size("models") > 1).select("id", "entity_name", "entity_type", F.array_join("models", ",").alias("models"))


@query("SELECT type, coalesce(stated, false) AS stated, count(*) AS n, count(DISTINCT relationship_type) AS kinds FROM relations GROUP BY ALL")
def survey_edge_kinds(spark, sf_dir):
    """Edges by type and provenance."""
    return relations(spark, sf_dir).groupBy("type", is_stated().alias("stated")).agg(counted("n"), F.countDistinct("relationship_type").alias("kinds"))


# --- attribute maps ---


@query("SELECT id, name AS attribute, round(value, 4) AS value, unit FROM attrs WHERE unit = '$' AND value IS NOT NULL ORDER BY attrs.value DESC, id LIMIT 15")
def attr_rank_top15(spark, sf_dir):
    """The fifteen largest values of one unit, whatever the attribute."""
    rows = entities(spark, sf_dir).where(has_attributes()).select("id", F.explode("attributes").alias("attribute", "a")).where("a.unit = '$' and a.value is not null")
    return rows.orderBy(F.col("a.value").desc(), "id").limit(15).select("id", "attribute", F.round("a.value", 4).alias("value"), "a.unit")


@query("""
SELECT name AS attribute, count(*) AS n, coalesce(string_agg(DISTINCT unit, ',' ORDER BY unit), '') AS units, count(expression) AS formulas, count(text) AS texts, min(id) AS example FROM attrs GROUP BY name
""")
def attr_map_explode(spark, sf_dir):
    """Attribute names with units and what kinds of values they have."""
    rows = entities(spark, sf_dir).select("id", F.explode("attributes").alias("attribute", "a"))
    return rows.groupBy("attribute").agg(
        counted("n"), F.array_join(F.array_sort(F.collect_set("a.unit")), ",").alias("units"), F.count("a.expression").alias("formulas"), F.count("a.text").alias("texts"), F.min("id").alias("example"),
    )


@query("SELECT id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM attrs WHERE lower(name) LIKE '%price%' AND value IS NOT NULL GROUP BY id")
def attr_pattern_sum(spark, sf_dir):
    """The sum of all attributes of an element whose name holds a word; formulas are not summed."""
    rows = entities(spark, sf_dir).select("id", F.explode(F.map_filter("attributes", lambda k, v: F.lower(k).like("%price%") & v["value"].isNotNull())).alias("k", "v"))
    return rows.groupBy("id").agg(exact_total(F.col("v.value")).alias("total"), counted("n"))


@query("SELECT id, entity_name, round(value, 4) AS value, dense_rank() OVER (ORDER BY round(value, 4) DESC) AS place FROM entities JOIN attrs USING (id) WHERE name = 'acctbal' AND entity_type = 'supplier' AND source_file IS NOT NULL")
def attr_path_rank(spark, sf_dir):
    """Declared suppliers ranked by one attribute."""
    rows = entities(spark, sf_dir).where((F.col("entity_type") == "supplier") & declared()).select("id", "entity_name", F.round(attribute("acctbal"), 4).alias("value")).where("value is not null")
    # a rank over all rows: numbered over the distinct values, which the aggregate has combined
    places = rows.groupBy("value").agg(counted("_n")).select("value", F.dense_rank().over(Window.orderBy(F.col("value").desc())).cast("long").alias("place"))
    return rows.join(places, "value").select("id", "entity_name", "value", "place")


@query(r"""
SELECT raw, CASE WHEN regexp_full_match(raw, '-?\d+(\.\d+)?([eE][-+]?\d+)?\s*(\[\s*[^\]]+?\s*\])?') THEN CAST(regexp_extract(raw, '^(-?\d+(\.\d+)?([eE][-+]?\d+)?)', 1) AS DOUBLE) END AS value,
  nullif(replace(trim(list_extract(string_split(regexp_extract(raw, '\[\s*([^\]]+?)\s*\]$', 1), '::'), -1)), '''', ''), '') AS unit,
  CASE WHEN NOT regexp_full_match(raw, '-?\d+(\.\d+)?([eE][-+]?\d+)?\s*(\[\s*[^\]]+?\s*\])?') THEN raw END AS expression, n
FROM (SELECT CASE p_size % 4 WHEN 0 THEN p_size || ' [SI::kg]' WHEN 1 THEN '-' || p_size || '.5E2 [''km/h'']' WHEN 2 THEN CAST(p_size AS VARCHAR) ELSE 'mass * ' || p_size END AS raw, count(*) AS n FROM part GROUP BY 1)
""", graph=False)  # fmt: skip
def parse_quantity(spark, sf_dir):
    """Written values split into number and unit, or kept as expressions."""
    size = F.col("p_size").cast("string")
    raw = F.when(F.col("p_size") % 4 == 0, F.concat(size, F.lit(" [SI::kg]"))).when(F.col("p_size") % 4 == 1, F.concat(F.lit("-"), size, F.lit(".5E2 ['km/h']")))
    raw = raw.when(F.col("p_size") % 4 == 2, size).otherwise(F.concat(F.lit("mass * "), size))
    rows = table(spark, sf_dir, "part").groupBy(raw.alias("raw")).agg(counted("n")).withColumn("q", quantity(F.col("raw")))
    return rows.select("raw", "q.value", "q.unit", "q.expression", "n")


# --- names ---


@query("SELECT id, entity_name AS name, short_name AS short, CASE WHEN short_name = 'ID-77' THEN 'its short name' ELSE 'its name' END AS role FROM entities WHERE short_name = 'ID-77' OR entity_name = 'ID-77'")
def identifier_two_fields(spark, sf_dir):
    """An identifier may be one row's short name and another's name; both are found."""
    wanted = F.upper(F.lit("id-77"))
    rows = entities(spark, sf_dir).where((F.col("short_name") == wanted) | (F.col("entity_name") == wanted))
    role = F.when(F.col("short_name") == wanted, "its short name").otherwise("its name")
    return rows.select("id", F.col("entity_name").alias("name"), F.col("short_name").alias("short"), role.alias("role"))


@query("""
SELECT id, entity_name, rung FROM (SELECT id, entity_name, CASE WHEN entity_name = 'SMALLRING' THEN 1 WHEN entity_name = 'SMALL RING' THEN 2 WHEN ends_with(entity_name, '_SMALL RING') THEN 3 WHEN contains(entity_name, 'SMALL RING') THEN 4 END AS rung FROM entities WHERE entity_type = 'part')
WHERE rung IS NOT NULL QUALIFY rung = min(rung) OVER ()
""")  # fmt: skip
def name_ladder(spark, sf_dir):
    """A phrase resolved rung by rung, each only where those above find nothing."""
    wanted = F.upper(F.lit("small ring"))
    squashed = F.replace(wanted, F.lit(" "), F.lit(""))
    name = F.col("entity_name")
    rung = F.when(name == squashed, 1).when(name == wanted, 2).when(name.endswith(F.concat(F.lit("_"), wanted)), 3).when(name.contains(wanted), 4)
    rows = entities(spark, sf_dir).where("entity_type = 'part'").select("id", "entity_name", rung.alias("rung")).where("rung is not null")
    return rows.join(F.broadcast(rows.agg(F.min("rung").alias("rung"))), "rung", "left_semi").select("id", "entity_name", "rung")  # one row


@query("""
SELECT 'strict' AS mode, count(*) AS n FROM entities WHERE entity_type = 'customer' AND (entity_name = '000000007' OR ends_with(replace(entity_name, '#', '_'), '_000000007'))
UNION ALL SELECT 'loose', count(*) FROM entities WHERE entity_type = 'customer' AND (entity_name = '00000007' OR (ends_with(replace(entity_name, '#', '_'), '00000007') AND length(entity_name) > 8))
""")  # fmt: skip
def suffix_match(spark, sf_dir):
    """Owner-prefixed names: an underscore that is one, and one that stands for any character."""
    rows = entities(spark, sf_dir).where("entity_type = 'customer'").withColumn("name", F.replace("entity_name", F.lit("#"), F.lit("_")))
    strict = rows.agg(F.lit("strict").alias("mode"), F.count_if(ends_as(F.col("name"), F.lit("000000007"))).alias("n"))
    return strict.unionByName(rows.agg(F.lit("loose").alias("mode"), F.count_if(ends_as(F.col("name"), F.lit("00000007"), strict=False)).alias("n")))


@query("SELECT id, entity_name, entity_type FROM entities WHERE contains(entity_name, 'RING') OR contains(lower(description), 'ring')")
def vague_search(spark, sf_dir):
    """A vague noun in name or description."""
    return entities(spark, sf_dir).where(text.contains_any(F.col("entity_name"), "ring") | text.contains_any(F.col("description"), "ring")).select("id", "entity_name", "entity_type")


@query("SELECT alias, count(*) AS n, count(DISTINCT p_name) AS names FROM (SELECT p_name, regexp_replace(upper(list_extract(string_split(p_brand || '::' || p_name, '::'), -1)), '[^A-Z0-9]', '', 'g') AS alias FROM part) GROUP BY alias", graph=False)
def alias_normalise(spark, sf_dir):
    """Names reduced to letters and digits of their last segment."""
    rows = table(spark, sf_dir, "part").select("p_name", alias_key(F.concat("p_brand", F.lit("::"), "p_name")).alias("alias"))
    return rows.groupBy("alias").agg(counted("n"), F.countDistinct("p_name").alias("names"))


def _resolved(spark, sf_dir, parts: DataFrame) -> DataFrame:
    """The declarations that the names of these parts mean."""
    index = resolve.suffixes(_declarations(spark, sf_dir).select("model", F.upper("qualified").alias("qualified")).distinct())
    asked = parts.select(F.col("p_partkey").alias("ref_id"), F.lit("supply").alias("model"), F.col("p_name").alias("reference"), F.concat_ws("::", "p_brand", "p_type", "p_name").alias("source"))
    return resolve.nearest(asked, index).select(F.col("ref_id").alias("p_partkey"), "hit")


_QUALIFIED = "p_brand || '::' || p_type || '::' || p_name"


def _declarations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.lit("supply").alias("model"), F.col("p_name").alias("name"), F.concat_ws("::", "p_brand", "p_type", "p_name").alias("qualified"))


@query(f"""
WITH q AS (SELECT p_partkey, upper(p_name) AS bare, upper({_QUALIFIED}) AS full_name, upper(p_type || '_' || p_name) AS s1, upper(p_brand || '_' || p_type || '_' || p_name) AS s2, count(*) OVER (PARTITION BY upper(p_name)) AS n0 FROM part),
a AS (SELECT *, count(*) OVER (PARTITION BY bare, s1) AS n1 FROM q),
b AS (SELECT *, count(*) FILTER (n0 > 1 AND n1 > 1) OVER (PARTITION BY bare, s2) AS n2 FROM a)
SELECT p_partkey, CASE WHEN n0 = 1 THEN bare WHEN n1 = 1 THEN s1 WHEN n2 = 1 THEN s2 ELSE full_name END AS display FROM b
""", graph=False)  # fmt: skip
def disambiguate_names(spark, sf_dir):
    """Part names made unique by as many owner segments as it takes."""
    return naming.disambiguate(_declarations(spark, sf_dir)).select("p_partkey", "display")


@query(f"""
WITH d AS (SELECT DISTINCT upper({_QUALIFIED}) AS hit, upper(p_brand) AS b, upper(p_type) AS t, upper(p_name) AS n FROM part),
r AS (SELECT p_partkey, upper(p_name) AS ref, upper(p_brand) AS b, upper(p_type) AS t FROM part),
c AS (SELECT p_partkey, hit, CASE WHEN r.b <> d.b THEN 0 WHEN r.t <> d.t THEN 1 ELSE 3 END AS shared FROM r JOIN d ON d.n = r.ref)
SELECT p_partkey, min(hit) AS hit FROM (SELECT *, max(shared) OVER (PARTITION BY p_partkey) AS best, count(*) OVER (PARTITION BY p_partkey) AS n FROM c) WHERE n = 1 OR shared = best GROUP BY p_partkey HAVING count(*) = 1
""", graph=False)  # fmt: skip
def suffix_index_resolution(spark, sf_dir):
    """References by bare name resolved to the nearest declaration; ties name nothing."""
    return _resolved(spark, sf_dir, table(spark, sf_dir, "part"))


@query("""
WITH e AS (SELECT DISTINCT p_brand AS q, p_type AS up FROM part), first AS (SELECT q, min(up) AS up FROM e GROUP BY q)
SELECT q AS qualified, q AS scope, 1 AS step FROM first UNION ALL SELECT q, up, 2 FROM first UNION ALL SELECT DISTINCT up, up, 1 FROM first
""", graph=False)  # fmt: skip
def scope_bfs(spark, sf_dir):
    """Scopes of brands: their own body, then the type that each specialises."""
    up = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_type").alias("up"))
    plain = lambda df, q, s: df.select(F.lit("supply").alias("model"), F.col(q).alias("qualified"), F.lit("").alias("typed"), s.alias("specializes"))
    elements = plain(up, "p_brand", F.array("up")).unionByName(plain(up.select("up").distinct(), "up", F.array().cast("array<string>")))
    return resolve.scopes(elements).select("qualified", "scope", "step")


# --- edge maintenance ---


@query("SELECT src, dst, relationship_type, n FROM (SELECT 'orders/' || l_orderkey AS src, 'part/' || l_partkey AS dst, 'connects' AS relationship_type, count(*) AS n FROM lineitem GROUP BY ALL) WHERE n > 1", graph=False)
def duplicate_edges(spark, sf_dir):
    """Edges that are written more than once."""
    r = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("orders/"), F.col("l_orderkey").cast("string")).alias("src"), F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("dst"), F.lit("connects").alias("relationship_type"))
    return r.groupBy("src", "dst", "relationship_type").agg(counted("n")).where("n > 1")


@query("SELECT l_orderkey AS src, l_partkey AS dst, min(l_linenumber) AS line FROM lineitem GROUP BY ALL", graph=False)
def dedupe_edges(spark, sf_dir):
    """One of equal edges, the least by its other columns."""
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.lit("RELATED_TO").alias("type"), F.lit("connects").alias("relationship_type"), F.col("l_linenumber").alias("line"))
    return reconcile.one_of_equal(r).select("src", "dst", "line")


def _repointed(spark, sf_dir) -> DataFrame:
    """Edges from nations of suppliers to nations of customers, after the merge."""
    of = lambda name, key: table(spark, sf_dir, name).select(F.col(key).cast("long").alias("n_nationkey")).distinct()
    a = of("supplier", "s_nationkey").withColumnRenamed("n_nationkey", "src")
    b = of("customer", "c_nationkey").withColumnRenamed("n_nationkey", "dst")
    edges = a.join(F.broadcast(b)).select("src", "dst", F.lit("RELATED_TO").alias("type"), F.lit("trades").alias("relationship_type"))  # keys of nations only
    merged = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id")).where("id % 7 = 0 and id > 0").withColumn("into", F.col("id") - 7)
    return reconcile.repoint(edges, merged).select(F.col("src").cast("int").alias("src"), F.col("dst").cast("int").alias("dst"))


_MERGED = "CASE WHEN x % 7 = 0 AND x > 0 THEN x - 7 ELSE x END"


@query(f"""
WITH m AS (SELECT DISTINCT {_MERGED.replace('x', 's_nationkey')} AS src, {_MERGED.replace('x', 'c_nationkey')} AS dst FROM (SELECT DISTINCT s_nationkey FROM supplier) CROSS JOIN (SELECT DISTINCT c_nationkey FROM customer))
SELECT src, dst FROM m WHERE src <> dst
""", graph=False)  # fmt: skip
def repoint_merge(spark, sf_dir):
    """Edges moved off merged vertices; loops and repeats that arise are dropped."""
    return _repointed(spark, sf_dir)


@query("SELECT s_nationkey AS src, c_nationkey AS dst, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE s_nationkey <> c_nationkey GROUP BY ALL", graph=False)
def self_edge_removal(spark, sf_dir):
    """Trade between nations without the edges from a nation to itself."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("lineitem").join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey")).join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return reconcile.without_loops(rows.select(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst"))).groupBy("src", "dst").agg(counted("n"))


@query("""
SELECT relationship_type, coalesce(stated, false) AS stated, count(*) AS n FROM relations r
WHERE stated OR (relationship_type NOT IN ('owns', 'typedby', 'specializes', 'redefines') AND NOT EXISTS (SELECT 1 FROM relations s WHERE s.stated AND s.src = r.src AND s.dst = r.dst AND s.relationship_type = r.relationship_type)) GROUP BY ALL
""")  # fmt: skip
def supersede_edges(spark, sf_dir):
    """Edges left once stated ones have replaced what was inferred."""
    return reconcile.supersede(relations(spark, sf_dir)).groupBy("relationship_type", is_stated().alias("stated")).agg(counted("n"))


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN coalesce(CASE WHEN s_suppkey % 4 = 0 THEN 0.0 END, s_acctbal) ELSE s_acctbal END AS s_acctbal FROM supplier UNION ALL SELECT -1, 'new', 1.0", graph=False)
def upsert_rows(spark, sf_dir):
    """Rows updated by key: nulls of the new rows keep what was there, unknown keys are added."""
    old = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    new = old.where("s_suppkey % 2 = 0").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, 0.0).alias("s_acctbal"))
    added = spark.createDataFrame([(-1, "new", 1.0)], "s_suppkey long, s_name string, s_acctbal double")
    return reconcile.upsert(reconcile.upsert(old, new, "s_suppkey"), added, "s_suppkey", "replace")


# --- documents, chunks, retrieval ---


@query(r"""
SELECT doc_id, CAST(i // 100 AS INTEGER) AS chunk_order_index, CAST(len(c) AS INTEGER) AS tokens, md5(array_to_string(c, ' ')) AS digest
FROM (SELECT doc_id, i, w[i + 1:i + 100] AS c FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1, 100)) AS i
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents) WHERE len(w) > 0))
""", graph=False)  # fmt: skip
def chunk_words(spark, sf_dir):
    """Documents cut into windows of a hundred words, numbered from 0 in each."""
    return text.chunks(table(spark, sf_dir, "documents"), 100).select("doc_id", "chunk_order_index", "tokens", F.md5("content").alias("digest"))


@query(r"""
SELECT source, count(DISTINCT doc_id) AS docs, count(*) AS chunks, sum(tokens) AS tokens FROM (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS n FROM documents) d,
  LATERAL (SELECT least(100, n - i) AS tokens FROM (SELECT unnest(generate_series(0, n - 1, 100)) AS i)) c GROUP BY source
""", graph=False)  # fmt: skip
def provenance_two_hop(spark, sf_dir):
    """From a source over its documents to their chunks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    parts = text.chunks(docs, 100)
    return parts.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.countDistinct("doc_id").alias("docs"), counted("chunks"), F.sum("tokens").alias("tokens"))


@query("""
SELECT v.vec_id, d.doc_id, CAST(len(v.embedding) AS INTEGER) AS width, round(list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE) * x)), 4) AS norm2 FROM embeddings v JOIN documents d ON d.doc_id = v.vec_id
""", graph=False)
def chunk_vector_by_id(spark, sf_dir):
    """Vectors joined by id, never by position."""
    v, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents").select("doc_id")
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return v.join(d, F.col("doc_id") == F.col("vec_id")).select("vec_id", "doc_id", F.size("embedding").alias("width"), F.round(norm2, 4).alias("norm2"))


_TERMS = ["the", "passage", "ing"]
_BM25 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
s AS (SELECT count(*) AS n, avg(len(w)) AS a FROM w),
t AS (SELECT doc_id, len(w) AS len, term, len(list_filter(w, lambda x: x = term)) AS tf FROM w, (SELECT unnest({_TERMS!r}) AS term)),
f AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM t GROUP BY term),
b AS (SELECT doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))) AS score FROM t JOIN f USING (term), s GROUP BY doc_id HAVING max(tf) > 0)
"""


@query(_BM25 + "SELECT doc_id, round(score, 6) AS score FROM b ORDER BY b.score DESC, doc_id LIMIT 20", graph=False)
def bm25_topk(spark, sf_dir):
    """The twenty documents that match some words best."""
    scored = text.bm25(table(spark, sf_dir, "documents"), _TERMS)
    return scored.orderBy(F.col("score").desc(), "doc_id").limit(20).select("doc_id", F.round("score", 6).alias("score"))


_QUERY_VECTOR = [round(((i * 37) % 64 - 31.5) / 32, 6) for i in range(64)]
_COSINE = f"list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST({_QUERY_VECTOR} AS DOUBLE[]))"


@query(f"SELECT vec_id, label, round({_COSINE}, 6) AS score FROM embeddings ORDER BY {_COSINE} DESC, vec_id LIMIT 10", graph=False)
def cosine_topk(spark, sf_dir):
    """The ten vectors nearest to one, exactly."""
    return vector.nearest(table(spark, sf_dir, "embeddings"), _QUERY_VECTOR, 10).select("vec_id", "label", F.round("score", 6).alias("score"))


@query(f"SELECT vec_id, label, round({_COSINE}, 6) AS score FROM embeddings WHERE label = 3 ORDER BY {_COSINE} DESC, vec_id LIMIT 10", graph=False)
def cosine_topk_filtered(spark, sf_dir):
    """The ten nearest of one kind: the filter stands before the score."""
    return vector.nearest(table(spark, sf_dir, "embeddings"), _QUERY_VECTOR, 10, where=F.col("label") == 3).select("vec_id", "label", F.round("score", 6).alias("score"))


@query(_BM25 + f""",
l AS (SELECT doc_id AS id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM b QUALIFY rank <= 50),
v AS (SELECT vec_id AS id, row_number() OVER (ORDER BY {_COSINE} DESC, vec_id) AS rank FROM embeddings QUALIFY rank <= 50)
SELECT id, round(sum(1.0 / (60 + rank)), 8) AS rrf_score FROM (SELECT * FROM l UNION ALL SELECT * FROM v) GROUP BY id
""", graph=False)  # fmt: skip
def rrf_fuse(spark, sf_dir):
    """A lexical and a vector ranking fused."""
    lexical = text.top(text.bm25(table(spark, sf_dir, "documents"), _TERMS).withColumnRenamed("doc_id", "id"), 50, ident="id")
    near = text.top(vector.nearest(table(spark, sf_dir, "embeddings"), _QUERY_VECTOR, 50).select(F.col("vec_id").alias("id"), "score"), 50, ident="id")
    return text.fuse(lexical, near, ident="id").select("id", F.round("rrf_score", 8).alias("rrf_score"))


# --- counterparts and communities ---


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("role"), (F.col("vec_id") % 3).cast("string").alias("model"), "embedding")


_FLOOR = 0.3
_PAIRS = f"""
WITH v AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS role, CAST(vec_id % 3 AS VARCHAR) AS model, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
big AS (SELECT model FROM v GROUP BY model ORDER BY count(*) DESC, model LIMIT 1),
p AS (SELECT a.id AS src, b.id AS dst, a.role, a.model AS src_model, b.model AS dst_model, list_cosine_similarity(a.e, b.e) AS cosine FROM v a JOIN v b ON a.role = b.role AND a.model <> b.model WHERE a.model NOT IN (SELECT model FROM big)),
c AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY cosine DESC, dst) AS rank FROM p QUALIFY rank <= 50),
f AS (SELECT * FROM c WHERE cosine >= {_FLOOR})
"""


@query(_PAIRS + "SELECT src, dst, role, src_model, dst_model, round(cosine, 6) AS cosine FROM f", graph=False)
def analogy_candidates(spark, sf_dir):
    """Counterparts of the same role in other models above a floor."""
    return similarity.candidates(_vectors(spark, sf_dir), floor=_FLOOR).select("src", "dst", "role", "src_model", "dst_model", F.round("cosine", 6).alias("cosine"))


@query(_PAIRS + "SELECT least(src, dst) AS a, greatest(src, dst) AS b, round(max(cosine), 6) AS cosine FROM f GROUP BY ALL", graph=False)
def analogy_pair_dedup(spark, sf_dir):
    """One row per unordered pair."""
    best = similarity.one_per_pair(similarity.candidates(_vectors(spark, sf_dir), floor=_FLOOR))
    return best.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.round("cosine", 6).alias("cosine"))


@query()
def analogy_capped(spark, sf_dir):
    """Pairs kept while both ends have room, as SIMILAR_TO edges. A zero vector, or one with NaN or infinity, is no end of any."""
    best = similarity.one_per_pair(similarity.candidates(similarity.directed(_vectors(spark, sf_dir)), floor=_FLOOR))
    return similarity.similar_edges(similarity.capped(best)).drop("rank")


def _links(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    i = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return o.join(i, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("src"), (F.col("l_partkey") + 1_000_000_000).alias("dst")).distinct()


@query()
def components(spark, sf_dir):
    """Connected components of all customers and the parts they ordered."""
    return communities.components(_links(spark, sf_dir))


@query("SELECT e.entity_type, count(*) AS members, min(e.entity_name) AS example FROM entities e JOIN relations r ON r.dst = e.id AND r.src = (SELECT src FROM relations WHERE relationship_type = 'owns' AND src LIKE 'nation/%' GROUP BY src ORDER BY count(*) DESC, src LIMIT 1) AND r.relationship_type = 'owns' GROUP BY ALL")
def community_members(spark, sf_dir):
    """Members of the largest group, by kind."""
    owned = relations(spark, sf_dir).where(F.col("relationship_type") == "owns")
    top = owned.where(F.col("src").startswith("nation/")).groupBy("src").agg(counted("n")).orderBy(F.col("n").desc(), "src").limit(1)
    members = owned.join(F.broadcast(top.select("src")), "src", "left_semi").select(F.col("dst").alias("id"))  # one row
    return entities(spark, sf_dir).join(members, "id").groupBy("entity_type").agg(counted("members"), F.min("entity_name").alias("example"))


@query("""
WITH k AS (SELECT n_regionkey AS r, c_mktsegment AS s, count(*) AS n, min(c_name) AS example FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT string_agg(n || ' x ' || s, ', ' ORDER BY n DESC, n || ' x ' || s) AS summary, min(example) AS title, CAST(sum(n) AS BIGINT) AS size FROM k GROUP BY r
""", graph=False)  # fmt: skip
def report_aggregate(spark, sf_dir):
    """Reports of groups: what kinds of members each has, most frequent first."""
    members = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    members = members.select(F.lit(0).alias("level"), F.col("n_regionkey").cast("string").alias("cluster"), F.col("c_name").alias("entity_name"), F.col("c_mktsegment").alias("entity_type"))
    return communities.reports(members, 1).select("report_json.summary", "title", "size")


# --- JSON, imports ---


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL", graph=False)
def json_props_group(spark, sf_dir):
    """Events by a field of their JSON text."""
    rows = table(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.groupBy("event_type", "k").agg(counted("n"))


_FILES = [
    ("App.sysml", "package App { import Core::*; import Parts::*; import UtilPackage::*; }"),
    ("Core.sysml", "package Core { import Parts::*; import ISQ::*; }"),
    ("Parts.sysml", "package Parts { import Util::*; import Core::*; }"),
    ("Util.sysml", "package Util { attribute x; }"),
]


def _imports(spark) -> DataFrame:
    files = spark.createDataFrame(_FILES, "path string, text string")
    found = utilities.imports(files)
    at = utilities.package_files(found, files)
    return found.join(at, "package", "left").select(F.regexp_replace("path", r"\.sysml$", "").alias("src"), F.coalesce(F.regexp_replace("file", r"\.sysml$", ""), "package").alias("dst"))


@query("""
SELECT * FROM (VALUES ('App', NULL, 0, 'App', 'first'), ('Core', 'App', 1, 'App>Core', 'first'), ('ISQ', 'Core', 2, 'App>Core>ISQ', 'first'), ('Parts', 'Core', 2, 'App>Core>Parts', 'first'),
 ('Core', 'Parts', 3, 'App>Core>Parts>Core', 'cycle'), ('Util', 'Parts', 3, 'App>Core>Parts>Util', 'first'), ('Parts', 'App', 1, 'App>Parts', 'seen'), ('Util', 'App', 1, 'App>Util', 'seen')) t(vertex, parent, depth, way, label)
""", graph=False)  # fmt: skip
def import_tree(spark, sf_dir):
    """The import tree of a few files: first places, later places, and cycles."""
    return traverse.dependency_tree(_imports(spark), "App")


@query("SELECT * FROM (VALUES ('ISQ', 1), ('Core', 2), ('Parts', 2), ('Util', 2)) t(package, \"references\")", graph=False)
def reference_counts(spark, sf_dir):
    """How often each package stands in the tree."""
    return utilities.reference_counts(import_tree(spark, sf_dir), "App").select("package", F.col("references").cast("int").alias("references"))


# --- survey and lookups ---


@query("SELECT m AS model, count(*) AS entities, count(source_file) AS declared FROM (SELECT source_file, unnest(models) AS m FROM entities) GROUP BY m")
def models_entities(spark, sf_dir):
    """Entities of each model, and how many of them a file declares."""
    rows = entities(spark, sf_dir).select("source_file", F.explode("models").alias("model"))
    return rows.groupBy("model").agg(counted("entities"), F.count("source_file").alias("declared"))


@query("SELECT id, entity_name, array_to_string(files, ',') AS files FROM entities WHERE entity_type = 'supplier' AND list_contains(models, 'supply')")
def parts_of_model(spark, sf_dir):
    """Elements of one kind and model."""
    rows = entities(spark, sf_dir).where((F.col("entity_type") == "supplier") & F.array_contains("models", "supply"))
    return rows.select("id", "entity_name", F.array_join("files", ",").alias("files"))


@query("""
SELECT e.id, e.entity_name, max(CASE WHEN a.name = 'retailPrice' THEN round(a.value, 4) END) AS price, max(CASE WHEN a.name = 'finish' THEN a.text END) AS finish, max(CASE WHEN a.name = 'netCost' THEN a.expression END) AS cost
FROM entities e LEFT JOIN attrs a ON a.id = e.id WHERE e.entity_name IN ('SMALL RING', 'SMALL BOLT') AND e.source_file IS NOT NULL GROUP BY ALL
""")  # fmt: skip
def attributes_of_named(spark, sf_dir):
    """Known attributes of named elements, read without a walk; what is missing is null."""
    rows = entities(spark, sf_dir).where(F.col("entity_name").isin("SMALL RING", "SMALL BOLT") & declared())
    return rows.select("id", "entity_name", F.round(attribute("retailPrice"), 4).alias("price"), attribute("finish", "text").alias("finish"), attribute("netCost", "expression").alias("cost"))


@query("SELECT s.id, s.short_name, o.id AS twin FROM entities s JOIN entities o ON o.entity_name = s.short_name WHERE s.entity_type = 'customer' AND o.entity_type = 'orders'")
def twin_names(spark, sf_dir):
    """Rows whose short name is the name of another row."""
    e = entities(spark, sf_dir)
    others = e.where("entity_type = 'orders'").select(F.col("entity_name").alias("short_name"), F.col("id").alias("twin"))
    return e.where("entity_type = 'customer'").select("id", "short_name").join(others, "short_name").select("id", "short_name", "twin")


@query("""
SELECT r.relationship_type, r.n, r.edge, coalesce(a.entity_name, split_part(r.edge, '>', 1)) AS from_label, coalesce(b.entity_name, split_part(r.edge, '>', 2)) AS to_label
FROM (SELECT relationship_type, count(*) AS n, min(src || '>' || dst) AS edge FROM relations GROUP BY ALL) r LEFT JOIN entities a ON a.id = split_part(r.edge, '>', 1) LEFT JOIN entities b ON b.id = split_part(r.edge, '>', 2)
""")  # fmt: skip
def one_edge_of_each_kind(spark, sf_dir):
    """The number of edges of each kind and one of them, its ends named where a vertex is there."""
    kinds = relations(spark, sf_dir).groupBy("relationship_type").agg(counted("n"), F.min(F.concat("src", F.lit(">"), "dst")).alias("edge"))
    names = entities(spark, sf_dir).select("id", "entity_name")
    for side, place in (("from", 0), ("to", 1)):
        kinds = kinds.withColumn("_end", F.split("edge", ">")[place])
        found = names.select(F.col("id").alias("_end"), F.col("entity_name").alias("_name"))
        kinds = kinds.join(found, "_end", "left").withColumn(f"{side}_label", F.coalesce("_name", "_end")).drop("_end", "_name")
    return kinds


@query("SELECT coalesce(unit, '') AS unit, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM attrs WHERE value IS NOT NULL GROUP BY ALL")
def totals_by_unit(spark, sf_dir):
    """Sums never mix units."""
    rows = entities(spark, sf_dir).select(F.explode("attributes").alias("k", "v")).where("v.value is not null")
    return rows.groupBy(F.coalesce("v.unit", F.lit("")).alias("unit")).agg(counted("n"), exact_total(F.col("v.value")).alias("total"))


@query("SELECT r.relationship_type, count(*) AS n, count(*) FILTER (e.id IS NULL) AS dangling FROM relations r LEFT JOIN entities e ON e.id = r.dst GROUP BY ALL")
def dangling_ends(spark, sf_dir):
    """Edges whose target is no vertex."""
    ids = entities(spark, sf_dir).select(F.col("id").alias("dst"), F.lit(True).alias("there"))
    return relations(spark, sf_dir).join(ids, "dst", "left").groupBy("relationship_type").agg(counted("n"), F.count_if(F.col("there").isNull()).alias("dangling"))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL ORDER BY n DESC, doc_id LIMIT 5", graph=False)
def longest_documents(spark, sf_dir):
    """The longest texts."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.length("text").cast("long").alias("n")).orderBy(F.col("n").desc(), "doc_id").limit(5)


@query("SELECT part, count(*) AS n FROM (SELECT 'stated' AS part FROM relations WHERE stated UNION ALL SELECT 'inferred' FROM relations WHERE stated IS NOT TRUE UNION ALL SELECT 'valued' FROM attrs WHERE name = 'acctbal' AND value IS NOT NULL) GROUP BY part")
def stated_and_inferred(spark, sf_dir):
    """How much is stated, how much inferred, and how many carry one attribute."""
    r = relations(spark, sf_dir).groupBy(F.when(is_stated(), "stated").otherwise("inferred").alias("part")).agg(counted("n"))
    v = entities(spark, sf_dir).where(attribute("acctbal").isNotNull()).agg(F.lit("valued").alias("part"), counted("n"))
    return r.unionByName(v.where("n > 0"))


# --- models read from text ---


def _model_files(spark, sf_dir) -> DataFrame:
    """One model file per supplier, as the reader takes them."""
    key, cents = F.col("s_suppkey").cast("long"), F.round(F.col("s_acctbal") * 100).cast("long")
    body = (
        "package '%s' {\n  // a unit and what it must do\n  part def <'S-%d'> Unit%d :> Base {\n    attribute acctbal = %de-2 ['$'];\n    attribute twice = acctbal * 2;\n    part seat%d : Nation%d;\n  }\n"
        "  requirement <'R-%d'> need%d;\n  part spare%d : Unit%d;\n  satisfy need%d by spare%d.seat%d;\n}\n"
    )
    text_ = F.format_string(body, "s_name", key, key, cents, key, F.col("s_nationkey").cast("long"), key, key, key, key, key, key, key)
    path = F.format_string("fleet%d/unit%d.sysml", key % 3, key)
    return table(spark, sf_dir, "supplier").select(path.alias("path"), text_.alias("text"), F.format_string("fleet%d", key % 3).alias("model"))


_S = "SELECT s_name AS n, s_suppkey AS k, s_nationkey AS nk, CAST(round(s_acctbal * 100) AS BIGINT) / 100.0 AS bal, 'fleet' || s_suppkey % 3 AS model, 'fleet' || s_suppkey % 3 || '/unit' || s_suppkey || '.sysml' AS file FROM supplier"


@query("SELECT DISTINCT 'fleet' || s_suppkey % 3 AS model, CAST(dense_rank() OVER (ORDER BY 'fleet' || s_suppkey % 3) - 1 AS INTEGER) AS import_number FROM supplier", graph=False)
def read_models(spark, sf_dir):
    """The models that files lie under, numbered."""
    return reader.models(_model_files(spark, sf_dir))


@query(f"WITH s AS ({_S}) SELECT 'unit' || k || '.sysml' AS file_name, 'models/' || file AS citable_url, 'sysml:' || file AS file_ids, model FROM s", graph=False)
def read_documents(spark, sf_dir):
    """A document for each file, with its address."""
    return reader.documents(_model_files(spark, sf_dir)).select("file_name", "citable_url", "file_ids", F.element_at("models", 1).alias("model"))


@query(f"""
WITH s AS ({_S})
SELECT n AS name, n AS qualified, 'package' AS kind, '' AS short, '' AS typed, '' AS specializes, file, 1 AS line, CAST(NULL AS DOUBLE) AS acctbal, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS twice FROM s
UNION ALL SELECT 'Unit' || k, n || '::Unit' || k, 'part', 'S-' || k, '', 'Base', file, 3, bal, '$', 'acctbal * 2' FROM s
UNION ALL SELECT 'seat' || k, n || '::Unit' || k || '::seat' || k, 'part', '', 'Nation' || nk, '', file, 6, NULL, NULL, NULL FROM s
UNION ALL SELECT 'need' || k, n || '::need' || k, 'requirement', 'R-' || k, '', '', file, 8, NULL, NULL, NULL FROM s
UNION ALL SELECT 'spare' || k, n || '::spare' || k, 'part', '', 'Unit' || k, '', file, 9, NULL, NULL, NULL FROM s
""", graph=False)  # fmt: skip
def read_elements(spark, sf_dir):
    """What model files declare: names, kinds, types, lines and written values."""
    found = reader.read(_model_files(spark, sf_dir))[0]
    value = [attribute("acctbal").alias("acctbal"), attribute("acctbal", "unit").alias("unit"), attribute("twice", "expression").alias("twice")]
    return found.select("name", "qualified", "kind", "short", "typed", F.array_join("specializes", ",").alias("specializes"), "file", "line", *value)


_READ = """SELECT n AS a, n || '::Unit' || k AS b, 'owns' AS type, file, 3 AS line, model FROM s
UNION ALL SELECT n || '::Unit' || k, 'Base', 'specializes', file, 3, model FROM s
UNION ALL SELECT n || '::Unit' || k, n || '::Unit' || k || '::seat' || k, 'owns', file, 6, model FROM s
UNION ALL SELECT n || '::Unit' || k || '::seat' || k, 'Nation' || nk, 'typedby', file, 6, model FROM s
UNION ALL SELECT n, n || '::need' || k, 'owns', file, 8, model FROM s
UNION ALL SELECT n, n || '::spare' || k, 'owns', file, 9, model FROM s
UNION ALL SELECT n || '::spare' || k, 'Unit' || k, 'typedby', file, 9, model FROM s
UNION ALL SELECT 'spare' || k || '.seat' || k, 'need' || k, 'satisfies', file, 10, model FROM s"""


@query(f"WITH s AS ({_S}) SELECT a AS \"from\", b AS \"to\", type, file, line FROM ({_READ})", graph=False)
def read_relations(spark, sf_dir):
    """What model files state between names, as written."""
    return reader.read(_model_files(spark, sf_dir))[1].select("from", "to", "type", "file", "line")


@query(f"""
WITH s AS ({_S})
SELECT model, a AS src, b AS dst, type, line FROM ({_READ}) WHERE type = 'owns'
UNION ALL SELECT model, n || '::spare' || k, n || '::Unit' || k, 'typedby', 9 FROM s
UNION ALL SELECT model, n || '::Unit' || k || '::seat' || k, n || '::need' || k, 'satisfies', 10 FROM s
""", graph=False)  # fmt: skip
def stated_edges_resolved(spark, sf_dir):
    """Written relations between declarations: names by nearest scope, feature paths through types; what names nothing is dropped."""
    elements, written = reader.read(_model_files(spark, sf_dir))
    found = reconcile.stated_edges(written, elements.withColumn("model", model_of(F.col("file"))))
    return found.select("model", "src", "dst", "type", "line")


@query(f"WITH s AS ({_S}) SELECT model, n || '::spare' || k AS qualified, n || '::spare' || k || '.seat' || k AS path, n || '::Unit' || k || '::seat' || k AS hit FROM s", graph=False)
def feature_paths(spark, sf_dir):
    """Dotted paths followed through the type of what they start from."""
    elements = reader.read(_model_files(spark, sf_dir))[0].withColumn("model", model_of(F.col("file")))
    spare = elements.where(F.col("name").startswith("spare")).select("model", "qualified", F.concat("qualified", F.lit(".seat"), F.substr("name", F.lit(6))).alias("path"))
    short = F.concat(F.element_at(F.split("qualified", "::"), -1), F.lit(".seat"), F.substr(F.element_at(F.split("qualified", "::"), -1), F.lit(6)))
    asked = spare.select(F.col("path").alias("ref_id"), "model", short.alias("reference"), F.col("qualified").alias("source"))
    return spare.join(resolve.follow(asked, elements).withColumnRenamed("ref_id", "path"), "path").select("model", "qualified", "path", "hit")


@query("SELECT 'x' || p_partkey AS id, 'd' || p_partkey AS \"into\" FROM part", graph=False)
def merge_plan(spark, sf_dir):
    """Rows that are second names of declarations: by short name, or by short name and name."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("k"), "p_name")
    rows = parts.select(F.concat(F.lit("x"), "k").alias("id"), F.when(F.col("k").cast("long") % 2 == 0, F.concat(F.lit("p. "), "k")).otherwise(F.concat(F.lit("p-"), "k", F.lit("_"), "p_name")).alias("name"), F.lit("supply").alias("model"))
    declarations = parts.select(F.concat(F.lit("d"), "k").alias("id"), F.col("p_name").alias("name"), F.concat(F.lit("P-"), "k").alias("short"), F.lit("supply").alias("model"))
    return resolve.merges(rows, declarations)


@query(f"""
SELECT 'edge ' || vec_id AS description, 'connects' AS relation, 'f' || vec_id % 7 || '.sysml' AS at, round({_COSINE}, 6) AS score FROM embeddings WHERE label % 2 = 0 ORDER BY {_COSINE} DESC, 'v/' || vec_id LIMIT 8
""", graph=False)  # fmt: skip
def relation_search(spark, sf_dir):
    """The eight edges of one kind nearest to a vector; the kind is asked before any score."""
    v = table(spark, sf_dir, "embeddings")
    ident = F.concat(F.lit("v/"), F.col("vec_id").cast("string"))
    edges = v.select(ident.alias("src"), F.lit("RELATED_TO").alias("type"), F.when(F.col("label") % 2 == 0, "connects").otherwise("owns").alias("relationship_type"), F.concat(F.lit("edge "), F.col("vec_id").cast("string")).alias("description"), "embedding")
    ends = v.select(ident.alias("id"), F.array(F.concat(F.lit("f"), (F.col("vec_id") % 7).cast("string"), F.lit(".sysml"))).alias("files"))
    return vector.search_relations(edges, ends, _QUERY_VECTOR, relation="connects").select("description", "relation", F.array_join("at", ",").alias("at"), F.round("score", 6).alias("score"))


# --- probes of the graph ---


def _probe(heading: str, *columns, sql: str):
    """Register a probe of the survey over the tables' graph."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file_name"), F.col("text").alias("content"))
        groups = table(spark, sf_dir, "nation").select(F.lit(0).alias("level"), F.col("n_name").alias("_key"), F.struct(F.col("n_name").alias("title")).alias("report_json"))
        found = profile.probes(entities(spark, sf_dir), relations(spark, sf_dir), docs, docs.select("content"), groups)[heading]()
        return found.selectExpr(*columns) if columns else found

    run.__name__ = f"probe_{heading.replace(' ', '_')}"
    run.__doc__ = f"The survey's probe: {heading}."
    query(sql)(run)


_probe("models", sql="SELECT model, count(*) AS n FROM (SELECT unnest(models) AS model FROM entities) GROUP BY model")
_probe("entity types", sql="SELECT entity_type, count(*) AS n FROM entities GROUP BY entity_type")
_probe("filled fields", sql="SELECT count(*) FILTER (id IN (SELECT id FROM attrs)) AS with_attributes, count(short_name) AS with_short_name, count(source_file) AS declared, 0 AS read, count(*) FILTER (len(models) > 1) AS in_two_models, count(*) FILTER (len(files) > 1) AS in_two_files FROM entities")
_probe("attributes", "attribute", "n", "array_join(units, ',') AS units", sql="SELECT name AS attribute, count(*) AS n, coalesce(string_agg(DISTINCT unit, ',' ORDER BY unit), '') AS units FROM attrs GROUP BY name ORDER BY n DESC, attribute LIMIT 30")
_probe("formulas", sql="SELECT entity_name, name AS attribute, expression FROM attrs JOIN entities USING (id) WHERE expression IS NOT NULL ORDER BY id, name LIMIT 8")
_probe("short names", sql="SELECT short_name, entity_name, entity_type FROM entities WHERE short_name IS NOT NULL ORDER BY short_name, entity_name LIMIT 12")
_probe("edge kinds", sql="SELECT type, count(*) AS n FROM relations GROUP BY type")
_probe("relations by provenance", sql="SELECT relationship_type, coalesce(stated, false) AS read, count(*) AS n FROM relations WHERE type = 'RELATED_TO' GROUP BY ALL")
_probe("a stated edge", sql="SELECT src, dst, type, relationship_type, stated FROM relations WHERE stated AND type = 'RELATED_TO' ORDER BY src, dst LIMIT 1")
_probe("communities", sql="SELECT 0 AS level, count(*) AS n, min(n_name) AS title FROM nation")
_probe("collections", sql="SELECT 'entities' AS collection, count(*) AS rows, false AS edge_collection FROM entities UNION ALL SELECT 'relations', count(*), true FROM relations UNION ALL SELECT 'documents', count(*), false FROM documents UNION ALL SELECT 'chunks', count(*), false FROM documents UNION ALL SELECT 'communities', count(*), false FROM nation")
_probe("most connected", sql="SELECT entity_name, entity_type, degree FROM (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM relations UNION ALL SELECT dst FROM relations) GROUP BY id) JOIN entities USING (id) ORDER BY degree DESC, id LIMIT 8")
_probe("an entity", "id", "entity_name", "entity_type", "short_name", "source_file", "source_line", sql="SELECT id, entity_name, entity_type, short_name, source_file, source_line FROM entities WHERE id IN (SELECT id FROM attrs) AND short_name IS NOT NULL AND source_file IS NOT NULL ORDER BY id LIMIT 1")
