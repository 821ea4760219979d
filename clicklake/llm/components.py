"""Connected components of an edge table by alternating large-star and small-star rounds.

Tasks first contract what they can see: a union-find over at most ``EDGES_A_TASK`` edges leaves one edge a
node.  A table that fits into one task is solved by that; otherwise rounds follow over what is left.

Every round is two grouped minima and two joins, staged so that a lost executor re-reads files and so
that adaptive execution can split a hot node on the edge side of each join (the minima are one row per
node).  The number of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MAX_ROUNDS = 60
EDGES_A_TASK = 500_000


def forest(edges: Iterator[tuple]) -> dict:
    """{node: smallest node of its component} by union-find, roots included."""
    above: dict = {}

    def root(x):
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for u, v in edges:
        above.setdefault(u, u)
        above.setdefault(v, v)
        a, b = root(u), root(v)
        if a != b:
            above[max(a, b)] = min(a, b)
    return {x: root(x) for x in above}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None

    def pairs():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    found = [(x, r) for x, r in forest(pairs()).items() if x != r]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], kind), pa.array([r for _, r in found], kind)], ["u", "v"])


def _contracted(edges: DataFrame, count: int) -> tuple[DataFrame, bool]:
    """Edges (u larger, v) after a union-find in every task, and whether one task saw them all."""
    tasks = -(-count // EDGES_A_TASK)
    spread = edges.coalesce(1) if tasks <= 1 else edges.repartition(tasks, "u")
    kind = edges.schema["u"].dataType.simpleString()
    return stage(spread.mapInArrow(_contract, f"u {kind}, v {kind}"), "cc-forest"), tasks <= 1


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every directed edge with the smallest of u and all its v."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("_least")), "cc-least")
    return edges.join(least, "u").select("u", "v", F.least("u", "_least").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node u to the smaller v."""
    found = _with_least(edges)
    linked = found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(found.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; the root is the component's smallest node."""
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "cc-edges")
    count = now.count()
    if count:
        now, solved = _contracted(now, count)
        state = None if solved else _state(now)
        for _ in range(MAX_ROUNDS if not solved else 0):
            now = stage(_small_star(stage(_large_star(now), "cc-large")), "cc-small")
            before, state = state, _state(now)
            if state == before:
                break
        else:
            if not solved:
                raise RuntimeError(f"components: not settled after {MAX_ROUNDS} rounds")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
