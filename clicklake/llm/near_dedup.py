"""MinHash near-dedup with an LSH forest; links are confirmed on full shingle sets.

1. One map over the texts: shingle set -> (set size, digest, signature).  Texts with equal sets form a
   *class* (pre-aggregated, so a third of all rows being copies costs one row a task); only classes go on.
2. Forest: each of ``TREES`` trees orders the classes by its own slice of the signature.  A global sort
   (range partitioning on tree, slice, class: no two keys are equal, so no hot key) puts classes with the
   longest common prefix next to each other.  A class is compared with its next ``NEIGHBOURS`` neighbours
   that share at least ``MIN_DEPTH`` values.  In a sparse region these are all classes of that short
   prefix; in a dense one the sort has put those of a longer prefix first, so depth adapts to the region.
   Neighbours whose whole signatures agree in ``candidate_share`` of the values or more are joined; each
   task sends a spanning forest of what it joined, never the pairs.
3. The forests' components (``components``) are *blobs*: every link lies inside one, as the candidate
   similarity lies well under the link threshold (``ERRORS`` standard errors of the estimate).
4. The texts of blob members are gathered and every link of a blob is decided on full sets by counting
   shared shingles.  A member is counted against all others unless it already belongs to the blob's
   largest component (links inside one component change nothing), so no link between different
   components is lost.  Blobs over ``BLOB_MEMBERS`` members are cut into chunks (``confirmed_links``), so
   no task holds an unbounded group.
5. The components of the confirmed links are joined back to the rows on the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, fresh, slices, stage, text_of
from .components import components
from .shingles import SHINGLE_WORDS, MinHash, digest, shingle_set

TREES, DEPTH = 16, 8
SIGNATURE = TREES * DEPTH
MIN_DEPTH = 3
NEIGHBOURS = 8
# Standard errors of the estimated similarity between the link threshold and that of candidates.
ERRORS = 4.75
SEED = 20240501
# Members of a chunk of a blob, and of a block of members compared with it; hubs of a large blob.
BLOB_MEMBERS, HUBS = 1000, 8


class Sets:
    """Joined sets by union-find; ``largest`` is the root of the biggest one."""

    def __init__(self, n: int):
        self.parent, self.size, self.largest = list(range(n)), [1] * n, 0

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        if self.size[x] < self.size[y]:
            x, y = y, x
        self.parent[y], self.size[x] = x, self.size[x] + self.size[y]
        if self.size[x] > self.size[self.largest]:
            self.largest = x
        return True


def candidate_share(percent: int) -> float:
    """Share of equal signature values from which a pair is a candidate: 0.70 for 85, 0.63 for 80 percent."""
    link = percent / 100
    return link - ERRORS * (link * (1 - link) / SIGNATURE) ** 0.5


def _is_link(shared, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def exact_links(sets: list[np.ndarray], percent: int = 85) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links sets with 100 * shared >= percent * union; exact."""
    n, joined, links = len(sets), Sets(len(sets)), []
    sizes = np.array([len(s) for s in sets])
    if n <= 3:
        for i in range(n):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if _is_link(shared, sizes[i], sizes[j], percent) and joined.join(i, j):
                    links.append((i, j))
        return links
    owner = np.repeat(np.arange(n), sizes)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    by_shingle, starts = owner[order], np.searchsorted(ids[order], np.arange(ids.max() + 2))
    first = np.concatenate([[0], np.cumsum(sizes)])

    def count(member: int) -> None:
        own = ids[first[member]:first[member + 1]]
        lo, length = starts[own], starts[own + 1] - starts[own]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        shared = np.bincount(by_shingle[at], minlength=n)
        for other in np.flatnonzero(_is_link(shared, sizes, sizes[member], percent)):
            if other != member and joined.join(member, int(other)):
                links.append((member, int(other)))

    # The member with the commonest shingles first: the original of a group of edited copies.
    common = np.add.reduceat((starts[1:] - starts[:-1])[ids], first[:-1]) / sizes
    todo, left = [int(np.argmax(common))], set(range(n))
    while todo:
        for member in todo:
            if member in left and (len(todo) == 1 or joined.root(member) != joined.root(joined.largest)):
                left.discard(member)
                count(member)
        # The largest component may have changed on the way: its former members are still to count then.
        todo = [m for m in sorted(left) if joined.root(m) != joined.root(joined.largest)]
    return links


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = MinHash(SIGNATURE, SEED)
        for batch in slices(batches):
            sizes, nodes, signatures, looks = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, k)
                sizes.append(len(s))
                nodes.append(digest(s))
                values = sign(s)
                signatures.append(values.astype(">u2").tobytes())
                looks.append(values.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(looks, pa.binary())],
                ["_id", "_salt", "_hash", "_n", "_node", "_signature", "_looks"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _salt, _text, _hash): the salt tells rows without id apart by their text, the hash all rows."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("_id"), F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("bigint")).alias("_salt"),
                       text.alias("_text"), F.xxhash64(text).alias("_hash"))


def _forest(least: float):
    """Spanning forest of the neighbours that look alike (in ``least`` of the values), of one sorted partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        names: list[bytes] = []
        joined = Sets(0)
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = np.asarray(batch.column(0))
            prefixes = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, DEPTH)
            nodes = batch.column(2).to_pylist()
            looks = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            if tail is not None:
                tree, prefixes = np.concatenate([tail[0], tree]), np.concatenate([tail[1], prefixes])
                nodes, looks = tail[2] + nodes, np.concatenate([tail[3], looks])
            pairs = []
            for step in range(1, min(NEIGHBOURS, len(nodes) - 1) + 1):
                near = np.flatnonzero((tree[step:] == tree[:-step]) & (prefixes[step:, :MIN_DEPTH] == prefixes[:-step, :MIN_DEPTH]).all(1))
                for at in range(0, len(near), 4096):
                    i = near[at:at + 4096]
                    alike = (looks[i] == looks[i + step]).mean(1) >= least
                    pairs += [(int(x), int(x) + step) for x in i[alike]]
            out = []
            for x, y in pairs:
                found = []
                for node in (nodes[x], nodes[y]):
                    if node not in number:
                        number[node] = len(names)
                        names.append(node)
                        joined.parent.append(number[node])
                        joined.size.append(1)
                    found.append(number[node])
                if joined.join(*found):
                    out.append((nodes[x], nodes[y]))
            keep = max(0, len(nodes) - NEIGHBOURS)
            tail = (tree[keep:], prefixes[keep:], nodes[keep:], looks[keep:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.binary()), pa.array([p[1] for p in out], pa.binary())], ["a", "b"])

    return run


def candidate_edges(classes: DataFrame, percent: int = 85) -> DataFrame:
    """(a, b): a spanning forest, task by task, of the classes that look alike in some tree."""
    trees = F.array(*[F.struct(F.lit(t).cast("int").alias("tree"),
                               F.substring("_signature", t * DEPTH * 2 + 1, DEPTH * 2).alias("slice")) for t in range(TREES)])
    rows = classes.select("_node", "_looks", F.explode(trees).alias("t")).select("t.tree", "t.slice", "_node", "_looks")
    key = ["tree", "slice", "_node"]
    return rows.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_forest(candidate_share(percent)), "a binary, b binary")


def _confirm(k: int, percent: int):
    """Links of each run of equal task keys (_task, _node, _text), the rows sorted by key."""

    def solve(group: dict[bytes, str]) -> list[tuple[bytes, bytes]]:
        nodes, sets = [], []
        for node, text in group.items():
            nodes.append(node)
            sets.append(text)
        return [(nodes[i], nodes[j]) for i, j in exact_links(sets, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, group, out = None, {}, []
        for batch in slices(batches):
            for key, node, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if key != task:
                    out += solve(group) if len(group) > 1 else []
                    task, group = key, {}
                if node not in group:
                    s = shingle_set(text, k)
                    if digest(s) == node:  # an id may occur with another text too
                        group[node] = s
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.binary()), pa.array([p[1] for p in out], pa.binary())], ["a", "b"])
                out = []
        out = solve(group) if len(group) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.binary()), pa.array([p[1] for p in out], pa.binary())], ["a", "b"])

    return run


def _task(root, *numbers):
    """Key of a confirming task: the blob's root and the numbers of its parts."""
    return F.concat(root, *[F.to_binary(F.lpad(F.hex(n), 8, "0"), F.lit("hex")) for n in numbers])


def _links_of(keyed: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Forests of the links inside the tasks of ``members`` (_key, _node, _task)."""
    texts = keyed.select(F.struct(F.col("_id").alias("id"), F.col("_salt").alias("salt")).alias("_key"), "_text")
    # Few documents are members: only their texts move, unless there are too many members to broadcast.
    spread = texts.join(broadcast_if_small(stage(members.distinct(), "blob-tasks")), "_key").select("_task", "_node", "_text")
    return stage(spread.repartition("_task").sortWithinPartitions("_task", "_node")
                 .mapInArrow(_confirm(k, percent), "a binary, b binary"), "links")


def _hubs(large: DataFrame, edges: DataFrame) -> DataFrame:
    """(_node): of each large blob up to ``HUBS`` members, the best connected of their hash class each."""
    degrees = edges.select(F.explode(F.array("a", "b")).alias("_node")).groupBy("_node").agg(F.count(F.lit(1)).alias("_degree"))
    best = (large.select("root", "_node").join(degrees, "_node")
            .groupBy("root", F.pmod(F.xxhash64("_node", F.lit(7)), F.lit(HUBS)).alias("_class")).agg(F.max(F.struct("_degree", "_node")).alias("_best")))
    return best.select("_best._node")


def confirmed_links(keyed: DataFrame, classes: DataFrame, blobs: DataFrame, edges: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): spanning forests of the links between classes of a blob, on full sets.

    A blob of one chunk is one task.  A larger one is confirmed in two rounds: every chunk together with
    the blob's hubs, which joins most of an original's copies; then the members that are still outside
    the blob's largest component, in blocks, against every chunk.  Two members of the largest component
    need no comparing, so no link between components is lost and the work is linear in the blob but for
    the members left over.
    """
    sizes = stage(blobs.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOB_MEMBERS).cast("int").alias("_chunks")), "blob-sizes")
    members = stage(blobs.withColumnRenamed("node", "_node").join(sizes, "root")
                    .withColumn("_own", F.pmod(F.xxhash64("_node"), F.col("_chunks")).cast("int"))
                    .join(classes.select("_node", F.struct(F.col("_low").alias("id"), F.col("_low_salt").alias("salt")).alias("_key")), "_node"), "blob-members")
    large = members.filter("_chunks > 1")
    own = members.select("_key", "_node", _task(F.col("root"), F.col("_own")).alias("_task"))
    if large.isEmpty():
        return _links_of(keyed, own, k, percent)
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_q")
    hubs = (large.join(_hubs(large, edges), "_node", "left_semi").select("_key", "_node", "root", every_chunk)
            .select("_key", "_node", _task(F.col("root"), F.col("_q")).alias("_task")))
    first = _links_of(keyed, own.union(hubs), k, percent)

    joined = components(first).select(F.col("node").alias("_node"), F.col("root").alias("_part"))
    parts = stage(large.join(joined, "_node", "left").withColumn("_part", F.coalesce("_part", "_node")), "blob-parts")
    largest = (parts.groupBy("root", "_part").agg(F.count(F.lit(1)).alias("_n"))
               .groupBy("root").agg(F.max(F.struct("_n", "_part")).alias("_most")))
    outside = stage(parts.join(largest, "root").filter(F.col("_part") != F.col("_most._part")).drop("_most", "_part"), "blob-outside")
    blocks = stage(outside.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOB_MEMBERS).cast("int").alias("_blocks")), "blob-blocks")
    asked = (outside.join(blocks, "root").withColumn("_block", F.pmod(F.xxhash64("_node", F.lit(3)), F.col("_blocks")).cast("int"))
             .select("_key", "_node", "root", "_block", every_chunk)
             .select("_key", "_node", _task(F.col("root"), F.col("_q"), F.col("_block")).alias("_task")))
    against = (large.join(blocks, "root").select("_key", "_node", "root", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_b"))
               .select("_key", "_node", _task(F.col("root"), F.col("_own"), F.col("_b")).alias("_task")))
    return first.union(_links_of(keyed, asked.union(against), k, percent))


def _resolved(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Profiles of all rows, and (_node, _component, _group) of every class: its smallest id and its own key."""
    keyed = _keyed(docs, id_col, text_col)
    kind = keyed.schema["_id"].dataType.simpleString()
    rows = stage(keyed.mapInArrow(_profiles(k), f"_id {kind}, _salt long, _hash long, _n long, _node binary, _signature binary, _looks binary"), "profiles")
    grouped = rows.filter("_n > 0").groupBy("_node", "_signature", "_looks").agg(F.min("_id").alias("_low"), F.min("_salt").alias("_least_salt"))
    classes = stage(grouped.select("_node", "_signature", "_looks", "_low",
                                   F.when(F.col("_low").isNull(), F.col("_least_salt")).otherwise(F.lit(0).cast("bigint")).alias("_low_salt")), "classes")
    edges = stage(candidate_edges(classes, percent), "candidates")
    blobs = stage(components(edges), "blobs")
    linked = components(confirmed_links(keyed, classes, blobs, edges, k, percent))
    merged = linked.withColumnRenamed("node", "_node").join(classes.select("_node", "_low"), "_node")
    lows = merged.groupBy("root").agg(F.min("_low").alias("_component"))
    found = stage(merged.select("_node", "root").join(lows, "root").select("_node", "_component", F.col("root").alias("_root")), "component-ids")
    known = stage(classes.select("_node", "_low").join(found, "_node", "left")
                  .select("_node", F.when(F.col("_component").isNull(), F.col("_low")).otherwise(F.col("_component")).alias("_component"),
                          F.coalesce("_root", "_node").alias("_group")), "classes-of-components")
    return rows, known


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, percent: int = 85) -> DataFrame:
    """``id_col``, n_shingles, component_id, kept of every row.

    Rows are linked when 100 * shared shingles >= percent * all shingles of both; a component is what
    links reach.  Texts without words (NULL, empty, white space) are linked with nothing and stay.  Rows
    of one text and one id are one document: all of them carry the same result.  Rows without id are
    linked like others; their component_id is NULL only when no member has an id, and they stay only
    then.  Other columns are not read.
    """
    rows, known = _resolved(docs, id_col, text_col, k, percent)
    empty = rows.filter("_n = 0").select("_id", "_n", F.col("_id").alias("_component"))
    full = rows.filter("_n > 0").select("_id", "_n", "_node").join(known, "_node").select("_id", "_n", "_component")
    return full.unionByName(empty).select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each component.

    That is the row of the smallest id (rows without id come last), then of the smallest text hash; of rows
    with the same id and text any one.  All rows whose texts have no words stay.
    """
    rows, known = _resolved(docs, id_col, text_col, SHINGLE_WORDS, percent)
    key, copies = fresh(docs, "_key"), fresh(docs, "_copies")
    own = F.struct(F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    counted = (rows.filter("_n > 0").select("_node", "_id", "_hash").join(known.select("_node", "_group"), "_node")
               .groupBy("_group", "_id", "_hash").agg(F.count(F.lit(1)).alias("_rows")))
    least = counted.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), own.alias("key"), F.col("_rows").alias("rows"))).alias("_least"))
    wordless = rows.filter("_n = 0").select(own.alias(key), F.lit(1).cast("long").alias(copies)).distinct()
    kept = stage(least.select(F.col("_least.key").alias(key), F.col("_least.rows").alias(copies)).union(wordless), "kept-keys")
    keyed = docs.withColumn(key, F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("hash")))
    single = keyed.join(kept.filter(F.col(copies) == 1).select(key), key, "left_semi").drop(key)
    repeated = kept.filter(F.col(copies) > 1).select(key)
    if repeated.isEmpty():
        return single
    return single.union(keyed.join(broadcast_if_small(repeated), key, "left_semi").dropDuplicates([key]).drop(key))
