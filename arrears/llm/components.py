"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from arrears.llm.common import written


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' component under the links ``a[i]-b[i]``."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while (jumped := root[root]).tolist() != root.tolist():
            root = jumped
    return root


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the smallest node reachable.

    Links to itself and nulls are ignored, repeated links count once, an empty table gives
    an empty result.  Each round is a partial aggregate and a shuffle join (which Spark
    splits where one node has many links), written to the shared folder.  Nothing is
    collected but one row with the number of links and a digest.
    """
    edges = written(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = written(small, "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
