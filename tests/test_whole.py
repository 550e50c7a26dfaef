"""Queries over whole tables, without SQL, against brute force on small tables."""

from weftline.operators import similarity
from weftline.plans import queries


def save(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_part_is_resolved(spark, tmp_path):
    rows = [(i, f"Brand{i % 3}", f"type{i % 4}", f"name{i % 7 if i < 40 else i}", i % 50) for i in range(60)]
    sf = save(spark, tmp_path, part=(rows, "p_partkey long, p_brand string, p_type string, p_name string, p_size int"))
    want = {}
    for key, *path, _ in rows:
        here = [x.upper() for x in path]
        found = {tuple(x.upper() for x in p) for _, *p, _ in rows if p[2] == path[2]}
        shared = lambda f: next((i for i in range(3) if f[i] != here[i]), 3)
        best = [f for f in found if len(found) == 1 or shared(f) == max(map(shared, found))]
        if len(best) == 1:
            want[key] = "::".join(best[0])
    got = {r.p_partkey: r.hit for r in queries.QUERIES["suffix_index_resolution"](spark, sf).collect()}
    assert got == want and len(want) == 60


def test_edges_of_every_nation_are_moved(spark, tmp_path):
    nations = range(25)
    sf = save(spark, tmp_path, nation=([(n,) for n in nations], "n_nationkey int"), supplier=([(n,) for n in nations if n % 3], "s_nationkey int"), customer=([(n,) for n in nations if n % 4 != 1], "c_nationkey int"))
    into = lambda n: n - 7 if n % 7 == 0 and n else n
    want = {(into(a), into(b)) for a in nations if a % 3 for b in nations if b % 4 != 1 if into(a) != into(b)}
    got = [tuple(r) for r in queries.QUERIES["repoint_merge"](spark, sf).select("src", "dst").collect()]
    assert sorted(got) == sorted(want) and max(a for a, _ in want) == 23


def test_components_of_all_orders(spark, tmp_path):
    orders = [(i, i // 2, "5-LOW" if i % 3 else "1-URGENT") for i in range(60)]
    items = [(i, p, 1 + i % 50) for i in range(59) for p in (100 + i // 20, 200 + i % 2 + i // 20 * 2)]
    items += [(59, 700, 1), (1000, 800, 50)]
    sf = save(spark, tmp_path, orders=(orders, "o_orderkey long, o_custkey long, o_orderpriority string"), lineitem=(items, "l_orderkey long, l_partkey long, l_quantity long"))
    customer = {o: c for o, c, _ in orders}
    group: dict[int, set[int]] = {}
    for o, p, _ in items:
        if o in customer:
            both = group.get(customer[o], {customer[o]}) | group.get(10**9 + p, {10**9 + p})
            group |= dict.fromkeys(both, both)
    got = {r.id: r.component for r in queries.QUERIES["components"](spark, sf).collect()}
    assert got == {x: min(g) for x, g in group.items()} and set(got.values()) == {0, 10, 20}


def test_counterparts_by_words_and_vectors(spark):
    """A counterpart that only its words recommend is among the best of the fused ranks."""
    rows = [(0, "part", "a", [1.0, 0.0], "valve of the oxygen tank")]
    rows += [(i, "part", "b", [1.0, i / 100], f"filler{i}") for i in range(1, 20)]
    rows += [(20, "part", "b", [1.0, 0.5], "oxygen tank valve"), (21, "part", "a", [1.0, 0.0], "oxygen tank valve"), (22, "port", "b", [1.0, 0.0], "oxygen tank valve")]
    df = spark.createDataFrame(rows, "id long, role string, model string, embedding array<double>, text string")
    assert 20 not in {r.dst for r in similarity.candidates(df, search=3).where("src = 0").collect()}
    got = similarity.candidates(df, search=3, text="text").where("src = 0").collect()
    by = {r.dst: r for r in got}
    assert set(by) == {1, 2, 20} and abs(by[20].rrf_score - (1 / 80 + 1 / 61)) < 1e-12 and [by[20].rank, by[1].rank] == [1, 2]
