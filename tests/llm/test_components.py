import random

from cargolens.llm.components import components


def plain(edges):
    at = {}

    def find(x):
        while at.setdefault(x, x) != x:
            x = at[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        at[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(at)}


def test_random_graphs_chain_star_and_loops(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(90)]
    edges += [(1000 + i, 1001 + i) for i in range(120)]                    # a chain
    edges += [(5000, 5000 - i) for i in range(1, 400)] + [(5000, 4999)]     # a star, its hub the largest; a repeat
    edges += [(-7, 9000), (9000, 9000)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain([e for e in edges if e[0] != e[1]])
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
