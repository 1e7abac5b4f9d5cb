import random

from textgate.llm.components import components


def test_equals_brute_force(spark):
    r = random.Random(1)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(200 + i, 201 + i) for i in range(40)] \
        + [(500, 500 + i) for i in range(1, 30)] + [(900, 900), (None, 3), (4, None), (-7, 501), (1, 1)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    label = {n: n for e in edges for n in e if None not in e}
    for _ in label:
        for a, b in edges:
            if None not in (a, b):
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_empty(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
