"""Joins that survive a key which holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key with more than this share of the rows is "hot"; 200 keys at most can
#: be, times the number of rows that one unit of the total stands for.
HOT_SHARE = 1 / 200


def split_join(rows: DataFrame, table: DataFrame, key: str, weight: str, total: Column) -> DataFrame:
    """Inner join with ``table``, which has one row per key.

    ``weight`` is how many of ``total`` units the key has.  Rows of hot keys
    find theirs in a broadcast table, whose size the share bounds; all other
    rows are shuffled, and none of their keys is large.
    """
    extra = [c for c in table.columns if c != key]
    limit = F.greatest(total * HOT_SHARE, F.lit(1.0))
    hot = table.where(F.col(weight) > limit).select(key, F.struct(*extra).alias("_hot"))
    cold = table.where(F.col(weight) <= limit)
    tagged = rows.join(F.broadcast(hot), key, "left")
    found = tagged.where(F.col("_hot").isNotNull()).select(
        *rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in extra]
    )
    rest = tagged.where(F.col("_hot").isNull()).select(*rows.columns)
    return found.unionByName(rest.join(cold, key).select(*rows.columns, *extra))
