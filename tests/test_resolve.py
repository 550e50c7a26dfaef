from pyspark.sql import functions as F

from weftline.operators import naming, reconcile, resolve
from weftline.operators.similarity import capped
from weftline.sources import reader

SMALL = """package Kit_Architecture {
  part def Kite;
  part kite { attribute totalMass = 750; part battery { attribute capacity = 6000; } }
}
package Kit_Requirements {
  requirement <'REQ-1'> longFlight;
  requirement <'REQ-2'> battery;
  satisfy Kit_Requirements::battery by kite;
}
package Use { part mine : Kite; part def Owner { part inner : Kite; } part a : Owner; satisfy Kit_Requirements::longFlight by a.inner; }
"""


def read(spark, text, path="kit/a.sysml"):
    return reader.read(spark.createDataFrame([(path, text)], "path string, text string"))


def elements_of(spark, rows):
    return spark.createDataFrame([("m", q, t, s) for q, t, s in rows], "model string, qualified string, typed string, specializes array<string>")


def ask(spark, index, rows):
    refs = spark.createDataFrame([(i, "m", r, s) for i, (r, s) in enumerate(rows)], "ref_id int, model string, reference string, source string")
    return {r.ref_id: r.hit for r in resolve.nearest(refs, index).collect()}


def test_nearest(spark):
    e = elements_of(spark, [("P::A::b", "", []), ("P::C::b", "", []), ("Q::d", "", []), ("P::x", "", []), ("P::y::x", "", []), ("Z::t", "", []), ("W::t", "", [])])
    got = ask(spark, resolve.suffixes(e), [("A::b", ""), ("b", "P::C::u"), ("b", "Q"), ("x", "P::k"), ("t", ""), ("nowhere", ""), ("'Q.d'", ""), ("A . b", "")])
    assert got == {0: "P::A::b", 1: "P::C::b", 3: "P::x", 6: "Q::d", 7: "P::A::b"}


def test_other_models_are_not_matched(spark):
    e = elements_of(spark, [("P::b", "", [])]).withColumn("model", F.lit("other"))
    assert ask(spark, resolve.suffixes(e), [("b", "")]) == {}


def test_inherited_features(spark):
    e = elements_of(spark, [("S", "", []), ("S::stage", "Def", []), ("Def", "", ["Base"]), ("Base", "", []), ("Base::tank", "TankDef", []), ("TankDef", "", []), ("TankDef::valve", "", [])])
    refs = spark.createDataFrame([(0, "m", "stage.tank.valve", "S"), (1, "m", "stage.none", "S"), (2, "m", "stage", "S")], "ref_id int, model string, reference string, source string")
    assert {r.ref_id: r.hit for r in resolve.follow(refs, e).collect()} == {0: "TankDef::valve"}
    found = [(r.scope, r.step) for r in resolve.scopes(e).where("qualified = 'S::stage'").collect()]
    assert sorted(found, key=lambda x: x[1]) == [("S::stage", 1), ("Def", 2), ("Base", 3)]


def test_merges(spark):
    rows = spark.createDataFrame([("r1", "DE-REQ-3", "m"), ("r2", "DE-REQ-3 DURABILITY", "m"), ("r3", "X::'DE-REQ-3", "m"), ("r4", "$", "m"), ("r5", "TWICE", "m"), ("d1", "DURABILITY", "m")], "id string, name string, model string")
    declared = spark.createDataFrame([("d1", "DURABILITY", "DE-REQ-3", "m"), ("d2", "COST", "$", "m"), ("d3", "P", "TWICE", "m"), ("d4", "Q", "TWICE", "m")], "id string, name string, short string, model string")
    assert {r.id: r.into for r in resolve.merges(rows, declared).collect()} == {"r1": "d1", "r2": "d1", "r3": "d1"}


def test_display_names(spark):
    rows = [("A::x", "x"), ("B::x", "x"), ("C::y", "y"), ("D::E::z", "z"), ("F::E::z", "z"), ("G::H::z", "z"), ("S::t", "t"), ("S::t", "t")]
    df = spark.createDataFrame([("m", q, n) for q, n in rows], "model string, qualified string, name string")
    got = sorted((r.qualified, r.display) for r in naming.disambiguate(df).collect())
    assert got == sorted([("A::x", "A_X"), ("B::x", "B_X"), ("C::y", "Y"), ("D::E::z", "D_E_Z"), ("F::E::z", "F_E_Z"), ("G::H::z", "H_Z"), ("S::t", "S::T"), ("S::t", "S::T")])


def test_reconcile(spark):
    elements, relations = read(spark, SMALL)
    numbers = spark.createDataFrame([("kit", 4)], "model string, import_number int")
    schema = "id string, entity_name string, entity_type string, description string, models array<string>, files array<string>, attributes map<string, struct<value: double, text: string, unit: string, expression: string>>, short_name string, source_file string, source_line int, stated boolean"
    old = [("e1", "LONGFLIGHT", "requirement", "flies long", ["kit"], ["a"], {}, None, None, None, None), ("e2", "REQ-1", "requirement", "the first one", ["kit"], ["a"], {}, None, None, None, None), ("e3", "MINE", "part", "it is mine", ["kit"], ["a"], {}, None, None, None, None), ("e4", "PROSE", "part", "only in prose", ["kit"], ["a"], {}, None, None, None, None)]
    edges = [("e2", "e1", "RELATED_TO", "refines", "", None, None, None), ("e4", "e2", "RELATED_TO", "refines", "", None, None, None), ("e3", "e4", "RELATED_TO", "owns", "", None, None, None), ("e4", "e4", "RELATED_TO", "performs", "", None, None, None), ("e3", "e1", "RELATED_TO", "x", "old", True, "f", 1)]
    ents, rels = reconcile.apply(elements, relations, numbers, spark.createDataFrame(old, schema), spark.createDataFrame(edges, "src string, dst string, type string, relationship_type string, description string, stated boolean, source_file string, source_line int"))
    rows = {r.entity_name: r for r in ents.collect()}
    assert "REQ-1" not in rows and rows["LONGFLIGHT"].short_name == "REQ-1" and rows["LONGFLIGHT"].source_line == 6
    assert rows["LONGFLIGHT"].description == "flies long [REQ-1]"
    assert rows["KIT_ARCHITECTURE::KITE"].attributes["totalMass"].value == 750
    assert rows["KITE_BATTERY"].attributes["capacity"].value == 6000 and rows["KITE_BATTERY"].stated
    assert rows["PROSE"].source_file is None and rows["MINE"].source_line == 10
    name = {r.id: n for n, r in rows.items()}
    got = {(name[r.src], name[r.dst], r.relationship_type, bool(r.stated)) for r in rels.collect()}
    assert ("PROSE", "LONGFLIGHT", "refines", False) in got  # repointed
    assert not [g for g in got if g[0] == g[1]] and not [g for g in got if g[2] == "owns" and not g[3]] and not [g for g in got if g[2] == "x"]
    assert ("USE", "MINE", "owns", True) in got and ("INNER", "LONGFLIGHT", "satisfies", True) in got


def test_two_sided_cap(spark):
    pairs = [("s1", "t1", 0.95), ("s1", "t2", 0.90), ("s1", "t3", 0.85), ("s1", "t4", 0.80), ("s2", "t1", 0.79), ("s3", "t1", 0.78), ("s4", "t1", 0.77)]
    df = spark.createDataFrame([("r", *p) for p in pairs], "role string, src string, dst string, cosine double")
    assert sorted((r.src, r.dst) for r in capped(df).collect()) == [("s1", "t1"), ("s1", "t2"), ("s1", "t3"), ("s2", "t1")]


def test_upsert_and_supersede(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, x string, y double")
    new = spark.createDataFrame([(2, None, 5.0), (3, "c", None)], "k int, x string, y double")
    assert sorted(map(tuple, reconcile.upsert(old, new, "k").collect())) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", None)]
    assert sorted(map(str, map(tuple, reconcile.upsert(old, new, "k", "replace").collect()))) == ["(1, 'a', 1.0)", "(2, None, 5.0)", "(3, 'c', None)"]
    rows = [("a", "b", "satisfies", True), ("a", "b", "satisfies", None), ("a", "b", "refines", None), ("c", "d", "owns", None), ("c", "d", "owns", True)]
    e = spark.createDataFrame([(s, d, "RELATED_TO", r, t) for s, d, r, t in rows], "src string, dst string, type string, relationship_type string, stated boolean")
    assert sorted((r.relationship_type, bool(r.stated)) for r in reconcile.supersede(e).collect()) == [("owns", True), ("refines", False), ("satisfies", True)]
