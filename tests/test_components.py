import random

from commgraph.operators.components import connected_components


def test_against_union_find(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(1000, 1040)] + [(5, k) for k in range(200, 260)] + [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(60)] + [(None, 3), (4, 4)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(a, b, 0) for a, b in edges], "a long, b long, m int")
    assert {r["node"]: r["root"] for r in connected_components(df).collect()} == {x: find(x) for x in list(parent)}
    assert connected_components(df.limit(0)).collect() == []
