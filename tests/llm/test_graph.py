import random

from helpers_llm import components as brute

from streetflow.llm.graph import components, sample_by_hash


def found(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"u {kind}, v {kind}")
    return {r["node"]: r["component"] for r in components(df).collect()}


def test_random_graphs_paths_and_hubs(spark):
    rng = random.Random(1)
    graphs = [
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 300)] + [(500, i) for i in range(200, 260)],
        [(i, 1000) for i in range(300)],
        [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        [(a, b) for a in range(12) for b in range(a)] + [(50, 51), (51, 50), (50, 51)],
    ]
    for edges in graphs:
        nodes = {x for e in edges if e[0] != e[1] for x in e}
        comp = brute(nodes, [e for e in edges if e[0] != e[1]])
        assert found(spark, edges) == comp


def test_no_edges_loops_and_nulls(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, 1), (None, 2), (3, None), (5, 4)]) == {4: 4, 5: 4}


def test_sample_is_bounded_and_stable(spark):
    df = spark.range(5000)
    a = {r.id for r in sample_by_hash(df, "id", 300).collect()}
    assert len(a) == 300 and a == {r.id for r in sample_by_hash(df.repartition(7), "id", 300).collect()}
    assert sample_by_hash(spark.range(10), "id", 300).count() == 10
