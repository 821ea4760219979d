"""Components by union-find in the tasks and by rounds, against plain Python."""

import random

import pytest

from clicklake.llm import components
from clicklake.llm.common import prepare


@pytest.mark.parametrize("edges_a_task", [500_000, 40])
@pytest.mark.parametrize("kind", ["long", "binary"])
def test_components_in_one_task_or_many(spark, monkeypatch, edges_a_task, kind):
    prepare(spark)
    monkeypatch.setattr(components, "EDGES_A_TASK", edges_a_task)
    rng = random.Random(edges_a_task)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 500)] + [(7, 7)]
    if kind == "binary":
        edges = [(a.to_bytes(3, "big"), b.to_bytes(3, "big")) for a, b in edges]
    want = {x: r for x, r in components.forest(e for e in edges if e[0] != e[1]).items()}
    got = {(bytes(a) if kind == "binary" else a): (bytes(r) if kind == "binary" else r)
           for a, r in components.components(spark.createDataFrame(edges, f"a {kind}, b {kind}")).collect()}
    assert got == want and all(want[a] == want[b] for a, b in edges if a != b)
    assert components.components(spark.createDataFrame([], f"a {kind}, b {kind}")).count() == 0
