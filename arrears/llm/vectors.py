"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each tree cuts the space again and again by random directions near the median; vectors
close to a cut go to both sides.  Pairs are compared exactly within leaves, for vectors of
one label.  A pair that meets in several leaves counts in the first of them, so links are
counted and united without ever listing pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrears.llm.common import on_executors, written
from arrears.llm.components import components, local_roots

THRESHOLD = 0.93
TREES = 10
LEAF = 1024
#: share of a node's vectors on either side of the cut that go to both sides
SPILL = 0.08
#: vectors that the forest is fitted on at most, chosen by a hash
SAMPLE = 16_384
#: a leaf with more vectors is compared in pairs of blocks of about this size
BLOCK = 2048


class Forest:
    """Directions and cuts of complete trees, each in heap order."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, spill: float = SPILL, seed: int = 5):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1] if len(sample) else 1
        nodes = 2**depth
        self.depth = depth
        self.directions = rng.standard_normal((trees, nodes, dim)).astype(np.float32)
        self.low = np.zeros((trees, nodes), dtype=np.float32)
        self.high = np.zeros((trees, nodes), dtype=np.float32)
        for t in range(trees):
            todo = {1: np.arange(len(sample))}
            for node in range(1, nodes):
                own = todo.pop(node, np.zeros(0, dtype=int))
                p = sample[own] @ self.directions[t, node]
                if len(own):
                    at = rng.uniform(0.45, 0.55)
                    self.low[t, node], self.high[t, node] = np.quantile(p, [max(0, at - spill), min(1, at + spill)])
                middle = (self.low[t, node] + self.high[t, node]) / 2
                todo[2 * node], todo[2 * node + 1] = own[p <= middle], own[p > middle]

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf numbers: a vector has one leaf or, by spill, several in each tree."""
        rows, found = [], []
        size = 2**self.depth
        for t in range(len(self.directions)):
            todo = [(1, np.arange(len(x)))]
            while todo:
                node, own = todo.pop()
                if not len(own):
                    continue
                if node >= size:
                    rows.append(own)
                    found.append(np.full(len(own), t * size + node - size, dtype=np.int32))
                    continue
                p = x[own] @ self.directions[t, node]
                todo.append((2 * node, own[p <= self.high[t, node]]))
                todo.append((2 * node + 1, own[p >= self.low[t, node]]))
        if not rows:
            return np.zeros(0, dtype=int), np.zeros(0, dtype=np.int32)
        return np.concatenate(rows), np.concatenate(found)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first: squares of very large or small components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def leaf_links(
    ids: np.ndarray, x: np.ndarray, weights: np.ndarray, leaves: list[np.ndarray], leaf: int, part: np.ndarray, first: int, second: int, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(id, links, root)`` of the vectors with links that count in this leaf.

    Compared are the vectors of block ``first`` with those of block ``second``.  A pair
    that shares a leaf with a smaller number counts there.
    """
    one, two = np.flatnonzero(part == first), np.flatnonzero(part == second)
    count = np.zeros(len(ids), dtype=np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    earlier, own = [], []
    for i, some in enumerate(leaves):
        before = some[some < leaf]
        earlier.append(before)
        own.append(np.full(len(before), i))
    keys, at = np.unique(np.concatenate([*earlier, np.zeros(0, np.int32)]), return_inverse=True)
    member = np.zeros((len(ids), max(1, len(keys))), dtype=np.float32)
    member[np.concatenate([*own, np.zeros(0, int)]).astype(int), at] = 1
    for s in range(0, len(one), 512):
        rows = one[s : s + 512]
        close = x[rows] @ x[two].T >= threshold
        if first == second:
            close &= rows[:, None] < two[None, :]
        if not close.any():
            continue
        close &= member[rows] @ member[two].T == 0
        count[rows] += close @ weights[two]
        count[two] += weights[rows] @ close
        i, j = np.nonzero(close)
        edges.append((rows[i], two[j]))
    if not edges:
        return ids[:0], count[:0], ids[:0]
    root = local_roots(len(ids), np.concatenate([a for a, _ in edges]), np.concatenate([b for _, b in edges]))
    linked = np.flatnonzero(count)
    return ids[linked], count[linked], ids[root[linked]]


def usable(vector: str = "embedding"):
    """Whether a vector can link: no null, no component null or not finite, not zero."""
    c = F.col(vector)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.coalesce(c.isNotNull() & ~F.exists(c, bad) & F.exists(c, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors(vec_id, embedding, label)``.

    Rows whose label is null or whose vector cannot link stand alone.  Vectors of different
    lengths never link.  Equal vectors of one label are one class that is compared once and
    counts as often as it stands, repeated rows included; each of them links with the
    others.  A null vec_id stays null; component_id is the smallest id that is not null.
    An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    on_executors(spark)
    ready = F.col("label").isNotNull() & usable()
    # equal vectors share a class: 128 bits of hash and the label name it
    rows = vectors.select(
        "vec_id", "label", "embedding", ready.alias("ready"),
        F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), F.reverse("embedding"), "embedding").alias("k2"),
        F.size("embedding").alias("dim"),
    )
    classes = (
        rows.filter("ready").groupBy("label", "k1", "k2", "dim")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("embedding").alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = written(classes, "vector-classes")
    sizes = classes.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("most")).collect()
    found = None
    for row in sizes:  # one forest per vector length; a corpus has one or few
        own = classes.filter(F.col("dim") == row["dim"])
        part = written(_links(own, row["most"], threshold, trees), "vector-links")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "cid long, links long, root long")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    roots = classes.select("cid", "first_id").join(roots.withColumnRenamed("node", "cid"), "cid")
    smallest = written(roots.groupBy("root").agg(F.min("first_id").alias("smallest")), "vector-components")
    named = roots.join(smallest, "root").select("cid", "smallest")
    result = (
        classes.select("cid", "label", "k1", "k2", "dim", "weight", "first_id")
        .join(links, "cid", "left").join(named, "cid", "left")
        .select(
            "label", "k1", "k2", "dim",
            (F.coalesce("links", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("smallest", "first_id").alias("component_id"),
        )
    )
    kept = (F.col("vec_id") == F.col("component_id")).alias("kept")
    linked = rows.filter("ready").select("vec_id", "label", "k1", "k2", "dim").join(result, ["label", "k1", "k2", "dim"])
    alone = rows.filter("not ready").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.select("vec_id", "n_links", "component_id", F.coalesce(kept, F.lit(False)).alias("kept"))


def _links(classes: DataFrame, most: int, threshold: float, trees: int) -> DataFrame:
    """``(cid, links, root)`` of the linked classes of one vector length; ``most`` is the largest label's count."""
    depth = max(0, math.ceil(math.log2(max(1, most) / LEAF)))
    some = classes.orderBy("k1", "k2", "label").limit(SAMPLE).select("embedding").collect()
    sample = unit(np.array([r["embedding"] for r in some], dtype=np.float64)).astype(np.float32)
    forest = classes.sparkSession.sparkContext.broadcast(Forest(sample, trees, depth))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                x = unit(matrix(piece.column(3))).astype(np.float32)
                row, leaf = forest.value.leaves(x)
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                first = np.searchsorted(row, np.arange(len(x) + 1))
                every = pa.array([leaf[first[i] : first[i + 1]] for i in range(len(x))], pa.list_(pa.int32()))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(k).take(at) for k in range(4)] + [pa.array(leaf), every.take(at)],
                    ["cid", "label", "weight", "embedding", "leaf", "leaves"],
                )

    def compare(group: pa.Table) -> pa.Table:
        leaves = [np.array(v, dtype=np.int32) for v in group.column("leaves").to_pylist()]
        ids, count, root = leaf_links(
            group.column("cid").to_numpy(),
            unit(matrix(group.column("embedding"))),
            group.column("weight").to_numpy(),
            leaves,
            group.column("leaf")[0].as_py(),
            group.column("block").to_numpy(),
            group.column("first")[0].as_py(),
            group.column("second")[0].as_py(),
            threshold,
        )
        return pa.table({"cid": ids, "links": count, "root": root})

    kind = dict(classes.dtypes)["label"]
    routed = written(
        classes.select("cid", "label", "weight", "embedding").mapInArrow(
            route, f"cid long, label {kind}, weight long, embedding array<float>, leaf int, leaves array<int>"
        ),
        "vector-leaves",
    )
    large = routed.groupBy("label", "leaf").count().filter(F.col("count") > BLOCK)
    large = large.select("label", "leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = routed.join(large, ["label", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # block b meets block o in the task (min, max): a leaf of any size is many even tasks
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    return dealt.select("cid", "label", "weight", "embedding", "leaf", "leaves", "block", "first", "second").groupBy(
        "label", "leaf", "first", "second"
    ).applyInArrow(compare, "cid long, links long, root long")
