import random

from stratalake.llm.components import connected_components
from stratalake.llm.covering import covering_tables


def test_components_of_chains_stars_and_pairs(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(5000 + i, 6000 + random.randrange(40)) for i in range(60)] + [(7, 7), (None, 3)]
    edges += [(b, a) for a, b in edges[:20]]
    random.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: root(x) for x in list(parent)}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0


def test_every_pair_within_the_radius_meets_in_some_table():
    for positions, radius in ((64, 2), (8, 2), (20, 3)):
        tables = [set(t) for t in covering_tables(positions, radius)]
        for _ in range(3000):
            differ = set(random.sample(range(positions), radius))
            assert any(not differ & t for t in tables)
        assert min(map(len, tables)) >= positions // 2 - 2
