import random

from pageloom.llm.graph import components
from pageloom.llm.scratch import Scratch


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def run(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r["id"]: r["component"] for r in components(df, Scratch(spark, "test-graph")).collect()}


def test_random_chain_star_and_none(spark):
    random.seed(4)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(160)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(3000, 2000 + i) for i in range(50)]
    edges = [(a, b) for a, b in edges if a != b]
    assert run(spark, edges + edges[:9]) == brute(edges)
    assert run(spark, []) == {}
