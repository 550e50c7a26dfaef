import random

import pytest
from pyspark.sql import functions as F

from weftline import schema
from weftline.operators import communities, text, traverse, vector
from weftline.plans import ask, profile
from weftline.plans.guard import is_query, provenance_gap, writes


def test_writes():
    assert writes("SELECT * FROM entities WHERE entity_name = 'ATLUNARORBITINSERTION'") == ""
    assert writes("SELECT ATLUNARORBITINSERTION FROM t") == "" and writes("select replace(a, 'b', 'c') from t") == ""
    assert writes("insert into t values (1)") == "INSERT" and writes("FOR c IN x TRUNCATE c") == "TRUNCATE" and writes("  drop table t") == "DROP"
    assert writes("select 'please remove' from t -- update\n") == ""


def test_is_query(spark):
    assert is_query(spark, "with a as (select 1 x) select * from a union all select 2")
    assert not is_query(spark, "create table t (a int)") and not is_query(spark, "show tables") and not is_query(spark, "set a=b")


@pytest.mark.parametrize(
    "sql,gap",
    [
        ("select count(*) from entities where entity_type = 'part'", ["source_file"]),
        ("select count(*) from entities where entity_type = 'part' and source_file is not null", []),
        ("select count(*) from entities e join relations r on r.dst = e.id\nwhere entity_type = 'part' and source_file is not null and relationship_type = 'owns'", ["stated"]),
        ("select m, count(*) from entities lateral view explode(models) x as m group by m", []),
        ("select entity_name from entities where entity_type = 'part'", []),
        ("select count(*) from entities where array_contains(models, 'a') ", ["source_file"]),
        (None, []),
    ],
)
def test_provenance(sql, gap):
    found = provenance_gap(sql)
    assert bool(found) == bool(gap) and all(g in found for g in gap)


@pytest.fixture(scope="module")
def graph(spark):
    value = "map<string, struct<value: double, text: string, unit: string, expression: string>>"
    ents = [
        ("e1", "SATURN", "part", "a rocket with stages", {}, None, "f", 1, ["f"], ["m"], True),
        ("e2", "STAGE", "part", "first stage of the rocket", {"mass": (10.0, None, "kg", None), "sum": (None, None, None, "a + b")}, "S-1", "f", 2, ["f"], ["m"], True),
        ("e3", "SATURN_STAGE", "part", "another stage", {"mass": (5.5, None, "kg", None)}, None, "f", 3, ["f", "g"], ["m", "n"], None),
        ("e4", "NEED", "requirement", "the rocket shall fly", {}, "R-1", None, None, ["g"], ["n"], None),
        ("e5", "ATLAUNCH", "snapshot", "launch", {}, None, "f", 9, ["f"], ["m"], True),
    ]
    entities = vector.embed(spark.createDataFrame(ents, f"id string, entity_name string, entity_type string, description string, attributes {value}, short_name string, source_file string, source_line int, files array<string>, models array<string>, stated boolean"), "description").cache()
    edges = [("e1", "e2", "RELATED_TO", "owns", True, 1.0, 1), ("e1", "e3", "RELATED_TO", "owns", True, 1.0, 1), ("e2", "e4", "RELATED_TO", "satisfies", None, 0.5, 1), ("e5", "e3", "RELATED_TO", "owns", True, 1.0, 1), ("e2", "e3", "SIMILAR_TO", None, None, 0.9, 0)]
    edges = spark.createDataFrame([(*e, "part" if e[2] == "SIMILAR_TO" else None, e[5]) for e in edges], "src string, dst string, type string, relationship_type string, stated boolean, weight double, order int, analogy_role string, cosine double")
    docs = spark.createDataFrame([("d1", "f", "models/f", "rocket stages are heavy " * 3), ("d2", "g", "models/g", "nothing at all")], "id string, file_name string, citable_url string, content string")
    chunks = vector.embed(text.chunks(docs, 5, ident="id", text="content").withColumnRenamed("id", "doc_id").withColumn("id", F.concat_ws("-", "doc_id", "chunk_order_index")), "content").cache()
    rep = spark.createDataFrame([("c1", 1, "rockets and stages of the rocket", 5.0), ("c2", 1, "boats", 9.0), ("c3", 0, "rocket", 1.0)], "_key string, level int, t string, r double")
    coms = vector.embed(rep, "t").select("_key", "level", "embedding", F.struct(F.col("t").alias("title"), F.col("t").alias("summary"), F.col("r").alias("rating"), F.array(F.struct(F.lit("big").alias("summary"), F.col("t").alias("explanation")), F.struct(F.col("_key").alias("summary"), F.col("t").alias("explanation"))).alias("findings")).alias("report_json"))
    for name, df in (("entities", entities), ("relations", edges), ("documents", docs), ("chunks", chunks), ("communities", coms)):
        df.createOrReplaceTempView(name)
    return entities, edges, docs, chunks, coms


def test_ask(spark, graph):
    sql = "select count(*) n from entities where entity_type = 'part'"
    planner = ask.TemplatePlanner([("how many parts", sql, sql + " and source_file is not null"), ("of (?P<kind>\\w+)s", "select entity_name from entities where entity_type = :kind order by 1", ""), ("wipe", "truncate table entities", ""), ("broken", "select nope from entities", "")])
    first = ask.ask(spark, planner, "How many parts are there?")
    assert first.ok and first.answer == "3" and first.note.startswith("asked again") and "source_file" in first.sql
    assert ask.ask(spark, planner, "names of requirements").rows == [{"entity_name": "NEED"}]
    assert "refused" in ask.ask(spark, planner, "wipe it").error and not ask.ask(spark, planner, "broken").ok
    assert not ask.ask(spark, planner, "unknown").ok and "entities(" in ask.schema_of(spark)
    assert "Q  " in first.show()


def test_a_plan_that_fails_is_planned_anew(spark, graph):
    class Slow:
        asked: list[str] = []

        def plan(self, question, schema, correction=""):
            self.asked.append(correction)
            return (f"select nope{len(self.asked)} from entities" if len(self.asked) < self.good else "select 1 as one"), {}

    for good, tries, ok in ((4, 4, True), (9, ask.ATTEMPTS, False)):
        planner = Slow()
        planner.asked, planner.good = [], good
        got = ask.ask(spark, planner, "what")
        assert got.ok == ok and len(planner.asked) == tries and planner.asked[0] == "" and "nope1" in planner.asked[1]


def test_retrieval(graph):
    r = ask.Retriever(*(graph[i] for i in (0, 1, 3, 2, 4)))
    local = r.local("rocket stages", 2).collect()
    assert local and {x.id for x in local} <= {"e1", "e2", "e3", "e4"}
    by = [x.order for x in local if x.id == local[0].id]
    assert by == sorted(by)
    answer = r.ask("rocket stages", "unified")
    assert "[CITE:1]" in answer.context and answer.rows[0]["url"] == "models/f" and "passage" in answer.retrieved
    assert "rockets" in r.ask("rockets and stages", "global").context
    assert [(p.point, p.rating, p.reports) for p in r.points("rockets and stages").collect()] == [("big", 5.0, 1), ("c1", 5.0, 1)]
    assert [(p.point, p.rating, p.reports) for p in r.points("rockets", floor=-2).collect()] == [("big", 14.0, 2), ("c2", 9.0, 1), ("c1", 5.0, 1)]
    assert "big" in r.ask("rockets and stages", "global").context
    assert "rocket" in answer.evidence(80, "rocket") and "does not occur" in answer.evidence(80, "zeppelin")
    with pytest.raises(ValueError):
        r.ask("x", "elsewhere")


def test_evidence_window():
    body = "first line\nsecond line with 42\nthird"
    assert text.evidence(body, 20, "42") == ("second line with 42\n", 11)
    assert text.evidence(body, 5) == ("first", 0) and text.evidence(body, 5, "none") == ("", -1)


def test_profile(spark, graph):
    entities, edges, docs, chunks, coms = graph
    found = profile.probes(entities, edges, docs, chunks, coms)
    assert len(found) == 17
    rows = {k: f().collect() for k, f in found.items()}
    assert rows["filled fields"][0].asDict() == {"with_attributes": 2, "with_short_name": 2, "declared": 4, "read": 3, "in_two_models": 1, "in_two_files": 1}
    assert [(r.entity_name, r.n) for r in rows["occurrences"]] == [("ATLAUNCH", 1)]
    assert rows["prefixed names"][0].tail == "STAGE" and rows["formulas"][0].expression == "a + b" and rows["analogies"][0].n == 1
    assert rows["attributes"][0].attribute == "mass" and rows["most connected"][0].degree == 2
    out = profile.survey(found | {"bad": lambda: spark.table("nowhere")}, limit=200)
    assert "(unavailable:" in out and "... truncated" in out and out.count("### ") == 18


def test_check_of_a_document(spark, graph):
    doc = "```sql\nselect entity_name from entities where entity_type = :kind\n```\ntext kg_Nothing and kg_x\n```sql\ndelete from entities\n```\n```sql\nselec 1\n```\n```sql\nselect 1 where false\n```"
    values = profile.live_values(graph[0], graph[2])
    assert values["moment"] == "ATLAUNCH" and values["short"] == "R-1"
    results = profile.check(spark, doc, values)
    assert [t.outcome for t in results] == ["answers", "forbidden", "unreadable", "empty"]
    assert profile.invented(spark, doc, "kg") == ["kg_Nothing", "kg_x"]
    assert profile.report(results).startswith("4 tried; 1 answers; 1 empty") and len(profile.complaints(results, ["kg_x"])) == 4
    fixed, again = profile.primer(spark, lambda s, todo: "```sql\nselect 1\n```" if todo else doc, "survey", values, "kg")
    assert again[0].size == 1


def test_walks(spark):
    rows = [("a", "b", "owns"), ("b", "c", "x"), ("c", "d", "owns"), ("b", "a", "owns"), ("b", "b", "owns")]
    e = spark.createDataFrame(rows, "src string, dst string, k string")
    s = spark.createDataFrame([("a",)], "id string")
    got = lambda df: sorted((r.vertex, r.depth) for r in df.collect())
    assert got(traverse.reach(s, e, 1, 3, where=F.col("k") == "owns")) == [("a", 2), ("b", 1)]
    assert got(traverse.reach(s, e, 1, 3, last=F.col("k") == "owns")) == [("a", 2), ("b", 1), ("d", 3)]
    assert got(traverse.reach(s, e, 0, 1)) == [("a", 0), ("b", 1)]
    assert got(traverse.paths(s, e, 1, 3)) == [("b", 1), ("c", 2), ("d", 3)]
    assert ("a", 2) in got(traverse.paths(s, e, 1, 3, unique="edges")) and got(traverse.reach(s, e, 1, 1, traverse.IN)) == [("b", 1)]
    assert sorted((r.to, r.direction) for r in traverse.neighbors(s, e).collect()) == [("b", "incoming"), ("b", "outgoing")]


@pytest.mark.parametrize("least,most", [(0, 5), (1, 5), (2, 4)])
@pytest.mark.parametrize("last", [False, True])
def test_reach_equals_a_walk_of_all_pairs(spark, least, most, last):
    """Cyclic graphs: every pair at its least depth within the bounds."""
    rng = random.Random(least * 7 + most)
    rows = sorted({(rng.randrange(14), rng.randrange(14), rng.choice("kx")) for _ in range(30)})
    e = spark.createDataFrame(rows, "src int, dst int, k string")
    starts, want = range(0, 14, 3), {}
    for s in starts:
        front = {s}
        for depth in range(most + 1):
            ends = front if depth == 0 else {b for a, b, k in rows if a in before and (k == "k" or not last)}
            if depth >= least:
                for v in ends:
                    want.setdefault((s, v), depth)
            before, front = front if depth == 0 else {b for a, b, _ in rows if a in before}, front
    got = traverse.reach(spark.createDataFrame([(s,) for s in starts], "id int"), e, least, most, last=F.col("k") == "k" if last else None).collect()
    assert sorted((r.start, r.vertex, r.depth) for r in got) == sorted((*pair, depth) for pair, depth in want.items())


def test_communities(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (6, 6)], "src long, dst long")
    assert {r.id: r.component for r in communities.components(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    h = communities.hierarchy(e)
    assert {tuple(r) for r in communities.nested(h).collect()} == {tuple(r) for r in h.alias("a").join(h.alias("b"), "id").where("a.level = 1 and b.level = 0").select("a.cluster", "b.cluster").collect()}
    assert h.where("level = 0").count() == 6 and h.where("level = 1").count() == 6


def test_vocabularies():
    assert len(schema.KINDS) == 27 and len(schema.MODIFIERS) == 20 and len(schema.RELATIONS) == 18
    assert schema.ENTITIES["attributes"].dataType.valueType.fieldNames() == ["value", "text", "unit", "expression"]


def test_stream_of_files(spark, tmp_path):
    from weftline.streaming.incremental import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sysml").write_text("package A { part b; }")
    seen = []
    for _ in range(2):
        watch(spark, str(tmp_path / "in"), str(tmp_path / "state"), lambda e, r, n: seen.append((n, e.count(), r.count()))).awaitTermination()
        (tmp_path / "in" / "b.sysml").write_text("package B;")
    assert seen == [(0, 2, 1), (1, 1, 0)]
