"""Sharding by a hierarchical weighted hash tree: region -> rack -> shard.

At every level each child draws ``-ln(u) / weight`` with ``u`` hashed from (key, node) and the smallest
draw wins, so a child is taken in proportion to its weight and the draw of a node depends on that node
alone.  Changing one subtree's weight moves keys only into or out of that subtree.  ``grown`` hangs the
new shard into a region of its own: no existing node changes, so rows move into the new shard only.

All draws are built-in functions of one row.  Slots are gapless per shard without one task per shard:
pass one stages the rows with the writing task's number, pass two numbers them inside (task, shard)
and adds the prefix sums of the per-task counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import offsets_by_part, stage, text_of


@dataclass(frozen=True)
class Node:
    """A node of the tree; ``weight`` of an inner node is the sum of its leaves."""

    name: str
    children: tuple = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int = 8, regions: int = 2, racks: int = 2, weights: dict | None = None) -> Node:
    """Shards 0..n-1 dealt to ``regions`` x ``racks`` in order; ``weights`` by shard (1 by default)."""
    per_region, root = -(-shards // regions), []
    for r in range(regions):
        own = range(r * per_region, min(shards, (r + 1) * per_region))
        per_rack = -(-len(own) // racks) if len(own) else 0
        nodes = []
        for k in range(racks):
            leaves = tuple(Node(f"shard{s}", (), s, (weights or {}).get(s, 1.0)) for s in own[k * per_rack:(k + 1) * per_rack])
            if leaves:
                nodes.append(Node(f"region{r}/rack{k}", leaves))
        if nodes:
            root.append(Node(f"region{r}", tuple(nodes)))
    return Node("root", tuple(root))


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a new region: it takes keys from the others, they trade none."""
    leaf = Node(f"shard{shard}", (), shard, weight)
    return Node(root.name, (*root.children, Node(f"region-of-{shard}", (Node(f"region-of-{shard}/rack0", (leaf,)),))))


def _draw(key: Column, node: Node, seed: int) -> Column:
    # 53 bits of the hash plus a half: u lies strictly between 0 and 1.
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{seed}:{node.name}")), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(node.weight))


def shard_of(key: Column, node: Node, seed: int = 0) -> Column:
    """Shard of a key: descend to the child with the smallest draw (ties: the earlier child)."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0], seed)
    pick = F.array_min(F.array(*[F.struct(_draw(key, c, seed).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(node.children)]))["i"]
    out = F.when(pick == 0, shard_of(key, node.children[0], seed))
    for i, c in enumerate(node.children[1:], 1):
        out = out.when(pick == i, shard_of(key, c, seed))
    return out


def shard_rows(docs: DataFrame, root: Node, id_col: str = "doc_id", text_col: str = "text",
               seed: int = 0, grown_root: Node | None = None) -> DataFrame:
    """Shard, slot and size of every row: ``id_col``, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 length plus 1 (NULL text: 1), ``text_crc32`` the unsigned CRC-32 of the text
    (NULL: of the empty text).  NULL ids are one key; equal ids share a shard and get slots of their
    own.  No other column is read.  ``grown_shard`` is NULL without ``grown_root``.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("\0null"))
    rows = stage(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text_of(text_col)) + 1).cast("long").alias("_size"),
        F.crc32(text_of(text_col).cast("binary")).alias("_crc"), shard_of(key, root, seed).cast("int").alias("_shard"),
        (shard_of(key, grown_root, seed) if grown_root else F.lit(None)).cast("int").alias("_grown"),
        F.spark_partition_id().alias("_part")), "shard-rows")
    counts = rows.groupBy("_part", "_shard").agg(F.count(F.lit(1)).alias("_rows"))
    base = offsets_by_part(counts, "_part", "_rows", "_before", "_shard").select("_part", "_shard", "_before")
    local = F.row_number().over(Window.partitionBy("_part", "_shard").orderBy("_id", "_crc", "_size")) - 1
    # base: one row per (writing task, shard), bounded by the number of tasks.
    return (rows.withColumn("_local", local).join(F.broadcast(base), ["_part", "_shard"])
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                    F.col("_shard").alias("shard"), (F.col("_before") + F.col("_local")).cast("long").alias("slot"),
                    F.col("_grown").alias("grown_shard")))
