"""SimHash near-duplicates, searched with a sharded vantage-point tree.

The fingerprints (64 bits) live in a metric space under the Hamming distance.  A tree of
vantage points cuts that space into shards: at a node with vantage point v and radius m,
fingerprints with d(x, v) <= m lie inside, the others outside.  By the triangle inequality
the ball of radius r around x can only meet the inside if d(x, v) - r <= m and the outside
if d(x, v) + r > m; all other branches are pruned.  Every distinct fingerprint goes to its
home shard, and as a query to each shard behind its own that its ball overlaps.  Within a
shard the same bounds go on down to small leaves, where pairs are compared exactly.  A
shard returns a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from arrears.llm.common import give_back, on_executors, written
from arrears.llm.components import components, local_roots

SAMPLE = 1 << 14
SHARD_ROWS = 1 << 15
MIN_DEPTH = 6
LEAF = 96


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of a whole text; 0 without words, the whole sequence below ``shingle`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in grams], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_column(spark: SparkSession, shingle: int = 4):
    """The fingerprint of a text column as a signed 64-bit number; Arrow batches, whole texts."""
    on_executors(spark)

    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t or "", shingle) for t in text], dtype=np.uint64)
        give_back()
        return pd.Series(found.view(np.int64))

    return of


def _distance(x: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(x ^ np.uint64(v)).astype(np.int16)


def build_tree(sample: np.ndarray, depth: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree with ``2 ** depth`` shards, in heap order.

    Of a few candidates the vantage point with the widest spread of distances wins: the
    wider the spread, the fewer balls cross the boundary.
    """
    rng = np.random.default_rng(seed)
    points = np.zeros(2**depth, dtype=np.uint64)
    radii = np.full(2**depth, 64, dtype=np.int16)
    todo = {1: np.unique(sample)}
    for node in range(1, 2**depth):
        own = todo.pop(node, sample[:0])
        if len(own) > 1:
            best = max(
                (own[i] for i in rng.integers(0, len(own), 12)), key=lambda v: float(_distance(own, v).std())
            )
            d = _distance(own, best)
            # of the radii around the median the one with the fewest distances near it
            mid = int(np.median(d))
            share = {m: (d <= m).mean() for m in range(mid - 2, mid + 3)}
            even = [m for m, s in share.items() if 0.3 <= s <= 0.7] or [mid]
            points[node] = best
            radii[node] = min(even, key=lambda m: int((np.abs(d - m) <= 3).sum()))
            inside = d <= radii[node]
            todo[2 * node], todo[2 * node + 1] = own[inside], own[~inside]
    return points, radii


def route(x: np.ndarray, points: np.ndarray, radii: np.ndarray, reach: int):
    """Shards of each fingerprint: yields ``(shard, rows, at_home)`` with pruned branches left out.

    A fingerprint is a query only in shards numbered above its home: a link between two
    shards is found from the lower one.
    """
    size = len(points)
    todo = [(1, np.arange(len(x)), np.ones(len(x), dtype=bool))]
    while todo:
        node, rows, home = todo.pop()
        if not len(rows):
            continue
        if node >= size:
            yield node - size, rows, home
            continue
        d, m = _distance(x[rows], points[node]), radii[node]
        inside = d <= m
        # a ball that leaves its home branch to the inside would meet a lower shard
        left = inside | (~home & (d - reach <= m))
        right = ~inside | (d + reach > m)
        todo.append((2 * node, rows[left], (home & inside)[left]))
        todo.append((2 * node + 1, rows[right], (home & ~inside)[right]))


def shard_links(home: np.ndarray, asking: np.ndarray, reach: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within ``home`` and between ``asking`` and ``home``."""
    every = np.concatenate([home, asking])
    rng = np.random.default_rng(seed)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def forest() -> list[tuple[np.ndarray, np.ndarray]]:
        root = local_roots(len(every), np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
        moved = np.flatnonzero(root != np.arange(len(every)))
        return [(moved, root[moved])]

    todo = [(np.arange(len(home)), np.arange(len(every)))]
    while todo:
        data, query = todo.pop()
        if not len(data) or not len(query):
            continue
        if len(data) > LEAF:
            v = every[data[rng.integers(0, len(data))]]
            dd, dq = _distance(every[data], v), _distance(every[query], v)
            m = int(np.median(dd))
            if (dd <= m).all():
                m -= 1
            inside = dd <= m
            if inside.any():
                todo.append((data[inside], query[dq - reach <= m]))
                todo.append((data[~inside], query[dq + reach > m]))
                continue
        for q in range(0, len(query), 1 << 13):
            for k in range(0, len(data), LEAF):
                some, part = query[q : q + (1 << 13)], data[k : k + LEAF]
                i, j = np.nonzero(np.bitwise_count(every[some][:, None] ^ every[part][None, :]) <= reach)
                a, b = some[i], part[j]
                real = a > b
                held.append((a[real], b[real]))
                count += int(real.sum())
                if count > 1 << 20:
                    held = forest()
                    count = len(held[0][0])
    if not held:
        return every[:0], every[:0]
    (a, b), = forest()
    return every[a], every[b]


def linked_fingerprints(distinct: DataFrame, reach: int = 4) -> DataFrame:
    """``(a, b)``: links that connect all of ``distinct(fp)`` lying within ``reach`` bits of each other.

    The tree is fitted on at most ``SAMPLE`` fingerprints, taken in the order of a hash;
    every fingerprint is routed and compared.  Depth grows with the table so that a shard
    keeps about ``SHARD_ROWS`` rows.
    """
    spark = distinct.sparkSession
    on_executors(spark)
    n = distinct.count()
    sample = [r[0] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    depth = max(MIN_DEPTH, math.ceil(math.log2(max(1, n / SHARD_ROWS))))
    depth = min(depth, 13)
    points, radii = build_tree(np.array(sample, dtype=np.int64).view(np.uint64), depth)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, rows, home in route(x, points, radii, reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), shard, dtype=np.int32)), pa.array(x[rows].view(np.int64)), pa.array(home)],
                    ["shard", "fp", "home"],
                )

    def compare(group: pa.Table) -> pa.Table:
        x = group.column("fp").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy()
        a, b = shard_links(x[home], x[~home], reach)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    sent = distinct.mapInArrow(send, "shard int, fp long, home boolean")
    return sent.groupBy("shard").applyInArrow(compare, "a long, b long")


def classes(fps: DataFrame, reach: int = 4) -> DataFrame:
    """``(fp, class)`` of the distinct ``fps(fp)``: class is one fingerprint of the group."""
    linked = components(linked_fingerprints(fps, reach))
    linked = linked.select(F.col("node").alias("fp"), "root")
    return fps.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("class"))


def simhash_components(docs: DataFrame, reach: int = 4, shingle: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs(doc_id, text)``.

    Null and empty texts have fingerprint zero and link like any other.  Repeated rows stay
    repeated.  A row without doc_id keeps its place and belongs to the group of its
    fingerprint; ``component_id`` is the smallest doc_id that is not null.  An empty table
    gives an empty result; other columns are not read.
    """
    of = fingerprint_column(docs.sparkSession, shingle)
    rows = written(docs.select("doc_id", of("text").alias("fp")), "fingerprints")
    first = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    named = written(classes(first.select("fp"), reach).join(first, "fp"), "classes")
    smallest = named.groupBy("class").agg(F.min("first_id").alias("component_id"))
    every = named.join(smallest, "class").select("fp", "component_id")
    return rows.join(every, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, reach: int = 4, shingle: int = 4) -> DataFrame:
    """``docs`` with one row left of each near-duplicate group: the one with the smallest doc_id.

    Rows without doc_id come last.  Rows with one doc_id and one text are one document and
    leave one row.  All columns stay.  The texts are shuffled once, by doc_id and a hash.
    """
    of = fingerprint_column(docs.sparkSession, shingle)
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = written(docs.select("doc_id", text_hash.alias("__text"), of("text").alias("fp")), "fingerprints")
    named = written(classes(rows.select("fp").distinct(), reach), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__text")).alias("first")
    # the smallest of each fingerprint, then of each class: no hot fingerprint meets a join
    per_fp = rows.groupBy("fp").agg(first)
    stay = (
        per_fp.join(named, "fp").groupBy("class").agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("__id"), F.col("first.__text").alias("__hash"))
    )
    hashed = docs.withColumn("__text", text_hash)
    met = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    return hashed.join(stay, met, "left_semi").dropDuplicates(["doc_id", "__text"]).drop("__text")
