from pyspark.sql import functions as F

from weftline import __main__ as cli
from weftline.graph import Graph, build
from weftline.operators.extract import identifiers, off_vocabulary

ROCKET = """package Rocketry {
  doc /* The SaturnRocket carries the 'Lunar Module' and meets REQ-7. */
  part def Stage { attribute dryMass = 10.5 [kg]; }
  part def Rocket { part stage1 : Stage; part stage2 : Heavy; }
  part def Heavy :> Stage { attribute dryMass = 20 [kg]; }
  requirement <'REQ-7'> fly;
  satisfy fly by Rocket;
}"""


def test_build_save_load(spark, tmp_path, capsys):
    (tmp_path / "in" / "space").mkdir(parents=True)
    (tmp_path / "in" / "space" / "rocket.sysml").write_text(ROCKET)
    (tmp_path / "in" / "other.sysml").write_text("package Other { part def Stage; part s : Stage; }")
    build(spark, str(tmp_path / "in"), 20).save(str(tmp_path / "out"))
    g = Graph.load(spark, str(tmp_path / "out"))
    counts = {r.collection: r.rows for r in g.summary().collect()}
    assert counts["documents"] == 2 and counts["chunks"] >= 3 and counts["communities"] > 0
    total = g.sql(
        """WITH RECURSIVE walk AS (SELECT id, 0 AS d FROM entities WHERE entity_name = 'ROCKET'
           UNION ALL SELECT r.dst, d + 1 FROM walk JOIN relations r ON r.src = walk.id AND r.relationship_type IN ('owns', 'typedby') AND d < 4)
           SELECT sum(attributes['dryMass'].value) AS total FROM entities WHERE id IN (SELECT id FROM walk)"""
    )
    assert total.first().total == 30.5  # stages carry their values on the definitions
    assert g.sql("SELECT count(*) n FROM entities WHERE short_name = 'REQ-7' AND contains(description, 'REQ-7')").first().n == 1
    assert g.relations.where("relationship_type = 'satisfies' AND stated").count() == 1
    assert g.entities.where("size(models) > 1").count() == 0 and g.entities.where("entity_name = 'STAGE'").count() == 2
    assert {r.type for r in g.relations.select("type").distinct().collect()} >= {"RELATED_TO", "IN_COMMUNITY", "PART_OF", "MENTIONED_IN", "SUB_COMMUNITY_OF"}
    inner = g.relations.where("type = 'SUB_COMMUNITY_OF'").alias("r")
    keys = g.communities.select("_key", "level")
    assert inner.join(keys.alias("a"), F.expr("a._key = r.src and a.level = 1")).join(keys.alias("b"), F.expr("b._key = r.dst and b.level = 0")).count() == g.communities.where("level = 1").count()
    assert cli.main(["ask", str(tmp_path / "out"), "which rocket stages", "--scope", "unified"]) == 0
    assert cli.main(["sql", str(tmp_path / "out"), "drop table x"]) == 1 and cli.main(["profile", str(tmp_path / "out")]) == 0
    out = capsys.readouterr().out
    assert "retrieved" in out and "refused" in out and "### most connected" in out and "(unavailable" not in out
    assert Graph.drop(spark, str(tmp_path / "out")) and not Graph.drop(spark, str(tmp_path / "out")) and list((tmp_path / "out").iterdir()) == []


def test_identifiers(spark):
    df = spark.createDataFrame([("c1", "m", "part def 'Lunar Module' near SaturnRocket and REQ-7 plain words")], "id string, model string, content string")
    assert {(r.name, r.kind) for r in identifiers(df).collect()} == {("LUNAR MODULE", "part"), ("SATURNROCKET", "item"), ("REQ-7", "item")}
    edges = spark.createDataFrame([("a", "owns"), ("b", "likes")], "src string, relationship_type string")
    assert [(r.relationship_type, r.n) for r in off_vocabulary(edges).collect()] == [("likes", 1)]
    assert df.where(F.lit(False)).count() == 0
