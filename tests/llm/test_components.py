import random

from issuewatch.llm.components import connected_components


def union_find(edges):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    return {a: find(a) for a in parent}


def classes(labels):
    out = {}
    for node, label in labels.items():
        out.setdefault(label, set()).add(node)
    return sorted(map(sorted, out.values()))


def test_random_graph_chain_and_star(spark):
    draw = random.Random(1)
    name = lambda: draw.getrandbits(64) - 2**63
    chain, hub = [name() for _ in range(120)], name()
    edges = list(zip(chain, chain[1:], strict=False)) + [(hub, name()) for _ in range(200)]
    few = [name() for _ in range(60)]
    edges += [(draw.choice(few), draw.choice(few)) for _ in range(50)]
    edges += edges[:5] + [(5, 5)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    got = {r["node"]: r["component"] for r in found.collect()}
    assert classes(got) == classes(union_find(edges))


def test_sorted_chain_and_nulls(spark):
    edges = [(i, i + 1) for i in range(64)] + [(None, 3), (4, None)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == 65 and len({r["component"] for r in got}) == 1


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
