import random

import pytest

from tessera.llm import components as c


def graphs():
    rng = random.Random(3)
    path = list(range(400))
    rng.shuffle(path)
    return {
        "none": [],
        "path": list(zip(path, path[1:])),
        "hub": [(999, i) for i in range(300)],
        "repeats": [(5, 3), (3, 5), (5, 5), (8, 8), (-4, 3)],
        "random": [(rng.randrange(2000) - 1000, rng.randrange(2000) - 1000) for _ in range(900)],
    }


def brute(edges):
    least = {x: x for e in edges if e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return sorted(least.items())


@pytest.mark.parametrize("name", graphs())
@pytest.mark.parametrize("local", [c.LOCAL, 0])
def test_components(spark, name, local):
    edges = spark.createDataFrame(graphs()[name], "a long, b long")
    assert sorted(tuple(r) for r in c.components(edges, local=local).collect()) == brute(graphs()[name])


def test_a_small_table_takes_no_rounds(spark, monkeypatch):
    def refuse(*args):
        raise AssertionError("a round over the cluster")

    monkeypatch.setattr(c, "_star", refuse)
    edges = spark.createDataFrame(graphs()["path"], "a long, b long")
    assert {r.root for r in c.components(edges).collect()} == {0}
