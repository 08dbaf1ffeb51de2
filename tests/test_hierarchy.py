import random

from corpusloom.operators import hierarchy as H


def brute(edges):
    parents, nodes = {}, set()
    for p, c in edges:
        parents.setdefault(c, set()).add(p)
        nodes |= {p, c}
    known = {n: (0, [n], n) for n in nodes if n not in parents}
    while True:
        new = {c: min((known[p][0] + 1, known[p][1] + [c], known[p][2]) for p in ps) for c, ps in parents.items() if c not in known and all(p in known for p in ps)}
        if not new:
            return {n: (known[n][2], known[n][0], known[n][1]) if n in known else (-1, -1, None) for n in nodes}
        known |= new


def run(spark, edges):
    df = spark.createDataFrame(edges, "parent int, child int")
    return {r.node: (r.root, r.depth, r.path) for r in H.hierarchy(df).collect()}


def test_random_graphs(spark):
    rng = random.Random(4)
    tree = [(rng.randrange(max(0, i - 6), i), i) for i in range(1, 30)] + [(40, 41), (41, 42), (42, 41), (42, 43), (50, 50), (7, 41)]
    dag = [(rng.randrange(i), i) for i in range(1, 14) for _ in range(2)] + [(14, 13), (13, 14)]
    for edges in (tree, dag):
        assert run(spark, edges + edges[:3]) == brute(edges)


def test_empty_and_nulls(spark):
    assert run(spark, []) == {}
    assert run(spark, [(None, 1), (1, None)]) == {}


def test_clean_edges(spark):
    rows = [(1, 2, " Subtopic_Of ", 9), (1, 2, "subtopic_of", 9), (1, 99, "subtopic_of", 9), (None, 2, "subtopic_of", 9), (1, 2, None, 9), (2, 3, "related_to", 9)]
    rel = spark.createDataFrame(rows, "s int, t int, kind string, parent int")
    nodes = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (None, 5)], "id int, known int")
    assert [tuple(r) for r in H.clean_edges(rel, nodes, "subtopic_of", "s", "t", "kind", "id").collect()] == [(1, 2)]


def test_ancestors(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "parent int, child int")
    assert {tuple(r) for r in H.ancestor_pairs(H.hierarchy(df)).collect()} == {(1, 2, 1), (1, 3, 2), (2, 3, 1)}


def test_levels_are_read_by_one_scan(spark):
    """Not by one for each level: many tasks that each write a small file at once."""
    chain = [(i, i + 1) for i in range(9)]
    for edges in (chain, [*chain, (0, 9)]):
        tree = H.hierarchy(spark.createDataFrame(edges, "parent int, child int"))
        optimized = tree._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("Relation") <= 6 and tree.count() == 10
