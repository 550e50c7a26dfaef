from pyspark.sql import functions as F

from weftline.functions import expressions as ex
from weftline.operators import text
from weftline.plans.queries import _FILES, import_tree
from weftline.sources import utilities


def test_imports_and_files(spark):
    files = spark.createDataFrame([*_FILES, ("x/Only.sysml", "import A::B::*; import A::B::*; import C::**; import D::e;")], "path string, text string")
    got = {(r.path, r.package) for r in utilities.imports(files).collect()}
    assert ("x/Only.sysml", "A::B") in got and len([g for g in got if g[0] == "x/Only.sysml"]) == 2
    at = {r.package: r.file for r in utilities.package_files(utilities.imports(files), files).collect()}
    assert at["UtilPackage"] == "Util.sysml" and "ISQ" not in at
    body = utilities.combined(files.unionByName(files.limit(1))).first().content
    assert body.startswith("// ===== App.sysml =====\npackage App") and body.count("=====\n") == 5


def test_tree_roles_and_drawing(spark):
    tree = import_tree(spark, "")
    edges = tree.where("parent is not null").select(F.col("parent").alias("src"), F.col("vertex").alias("dst")).distinct()
    roles = {r.package: r.role for r in utilities.core_and_utility(edges, ["ISQ"]).collect()}
    assert roles == {"App": "core", "Core": "core", "Parts": "core", "Util": "utility"}
    assert "  Core --> ISQ;" in utilities.mermaid(tree) and "class App depth0" in utilities.mermaid(tree)


def test_expressions(spark):
    row = spark.range(1).select(
        ex.alias_key(F.lit("X::'DE-REQ-3")).alias("alias"), ex.slug_key(F.lit("analogy:a b:c")).alias("slug"), ex.model_of(F.lit("a/b/c.sysml")).alias("m1"), ex.model_of(F.lit("b.sysml")).alias("m2"),
        ex.is_stated(F.lit(None).cast("boolean")).alias("stated"), ex.quantity(F.lit("'x y'")).alias("q"), ex.quantity(F.lit("")).alias("none"), ex.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("zero"),
    ).first()
    assert (row.alias, row.m1, row.m2, row.stated, row.q.text, row.none, row.zero) == ("DEREQ3", "a", "b", False, "x y", None, None)
    assert row.slug.startswith("analogy_a_b_c_") and len(row.slug) == 24
    assert spark.range(0).agg(ex.total(F.col("id")).alias("t")).first().t == 0


def test_chunks(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, " x ")], "doc_id int, text string")
    got = sorted((r.doc_id, r.chunk_order_index, r.tokens, r.content) for r in text.chunks(df, 3, 1).collect())
    assert got == [(1, 0, 3, "a b c"), (1, 1, 3, "c d e"), (3, 0, 1, "x")]
