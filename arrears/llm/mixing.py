"""Mixing sources to target weights by balanced sampling with the cube method.

A source's rate is target / size.  Its whole part is taken of every document; the
fractional part is each document's inclusion probability for one more copy.  The cube
method moves these probabilities through the null space of the balancing constraints (the
words and the number of documents of a source) until each is 0 or 1, so the totals stay
where they were.  A few documents remain undecided per block and meet in the next round;
what a source has left at the end is the landing problem.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from arrears.llm.common import WORD, numbered, on_executors, written

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 4096
#: undecided units of a source that the landing phase rounds together
LANDING = 12
TINY = 1e-9


def flight(p: np.ndarray, x: np.ndarray, spare: int = 0) -> np.ndarray:
    """Probabilities after the flight phase: at most two lie strictly between 0 and 1, and the last ``spare``.

    ``x`` holds a unit's words; words and the count are the two constraints.  A window of
    three undecided units always has a direction that changes neither total.  The move
    goes to the nearer end with the probability that keeps each unit's chance, by a
    generator seeded from the units themselves, so that reruns agree.
    """
    p = p.astype(float).copy()
    open_ = [i for i in range(len(p)) if TINY < p[i] < 1 - TINY]
    open_ = open_[: max(0, len(open_) - spare)]
    rng = np.random.default_rng([len(p), int(x.sum()) & 0x7FFFFFFF])
    toss = iter(rng.random(len(open_) + 4))
    held = open_[:3]
    follow = iter(open_[3:])
    while len(held) == 3:
        a, b, c = (float(x[i]) for i in held)
        # null space of the rows (1, 1, 1) and (a, b, c)
        u = (b - c, c - a, a - b)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[i]) / s if s > 0 else p[i] / -s) for i, s in zip(held, u) if s)
        down = min((p[i] / s if s > 0 else (1 - p[i]) / -s) for i, s in zip(held, u) if s)
        step = up if next(toss) * (up + down) < down else -down
        stay = []
        for i, s in zip(held, u):
            p[i] = min(1.0, max(0.0, p[i] + step * s))
            if TINY < p[i] < 1 - TINY:
                stay.append(i)
            else:
                p[i] = round(p[i])
        held = stay
        while len(held) < 3 and (i := next(follow, None)) is not None:
            held.append(i)
    return p


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """0 or 1 for all: flight over the long documents first, then a landing problem over a few units.

    Units of many sizes are kept for landing.  Of all ways to round these ``LANDING`` units
    the one whose words come nearest to what was promised wins, ties by the nearest count.
    Where one undecided document outweighs them, decided units are turned back, the best
    fitting one first, as long as each brings the words nearer.
    """
    start, longest = p, x
    order = np.argsort(-x, kind="stable")
    spared = np.unique(np.linspace(0, len(order) - 1, LANDING).astype(int)[1:-1]) if len(order) else order
    order = np.concatenate([np.delete(order, spared), order[spared]])
    p, x = flight(p[order], x[order], LANDING - 2), x[order]
    open_ = [i for i in range(len(p)) if TINY < p[i] < 1 - TINY]
    want, count = sum(p[i] * x[i] for i in open_), sum(p[i] for i in open_)
    masks = np.arange(1 << len(open_))
    words_of = sum((masks >> k & 1) * x[i] for k, i in enumerate(open_)) + 0.0 * masks
    count_of = sum((masks >> k & 1) for k in range(len(open_))) + 0 * masks
    best = int(masks[np.lexsort((np.abs(count_of - count), np.abs(words_of - want)))[0]])
    for k, i in enumerate(open_):
        p[i] = best >> k & 1
    out = np.empty(len(p))
    out[order] = np.round(p)
    free = (start > TINY) & (start < 1 - TINY)
    excess = float(((out - start) * longest).sum())
    while free.any():
        change = np.where(free, np.where(out == 1, -longest, longest), 0.0)
        best = int(np.argmin(np.abs(excess + change)))
        if abs(excess + change[best]) >= abs(excess):
            break
        out[best] = 1 - out[best]
        excess += float(change[best])
    return out


def _ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with their place in code-point order, null last, from 0.

    Ranges of names are numbered in parallel; only the number of names per range, one row
    for each task, is summed over all.
    """
    spread = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    spread = written(spread, "source-ranges")
    counts = spread.groupBy("part").count()
    before = counts.withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count"))
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        spread.withColumn("n", F.row_number().over(own))
        .join(F.broadcast(before.select("part", "before")), "part")
        .select("source", "source_size", "n_docs", (F.col("before") + F.col("n") - 1).alias("place"))
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, n_docs, target)`` from ``sizes(source, size)``; one row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share all words.
    A target above ``cap`` times its source's size stops there; the excess is shared again
    by weight among the others, until none is above.  Each round is one aggregate.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = written(_ranked_sources(own).withColumn("weight", turn.cast("double")), "sources")
    ceiling = F.col("source_size") * cap
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        at_cap = F.col("weight") * level > ceiling
        row = ranked.agg(
            F.count(F.when(at_cap, 1)).alias("n"),
            F.sum(F.when(at_cap, ceiling).otherwise(0)).alias("fixed"),
            F.sum(F.when(at_cap, 0.0).otherwise(F.col("weight"))).alias("w"),
        ).first()
        if row["n"] == stopped or not row["w"]:
            break
        stopped, level = row["n"], (total - row["fixed"]) / row["w"]
    target = F.least(F.col("weight") * level, ceiling.cast("double"))
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def words(text: str = "text"):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source, source_size, target, copies, taken)``, one row per row of ``docs(doc_id, text, source)``.

    ``taken`` is ``copies`` times the words.  Null texts and texts without words have size 0
    and count as documents of their source.  Sources without any word have target 0 and rate
    0.  Repeated rows are drawn as separate units; equal ones are interchangeable.  A null
    doc_id or source is a value of its own.  Empty in, empty out; other columns are not read.
    Reruns agree: blocks and draws hang on the rows alone.  A source of any size is cut into
    blocks of about ``block`` documents, so that no task holds a whole source.
    """
    spark = docs.sparkSession
    on_executors(spark)
    row_hash = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))
    sizes = numbered(docs.select("doc_id", "source", words().alias("size"), row_hash.alias("h")), "n")
    # equal rows are units of their own in different blocks
    unit = F.when(F.col("n") == 0, F.col("h")).otherwise(F.xxhash64("h", "n"))
    rows = written(sizes.withColumn("u", unit).drop("n"), "mix-sizes")
    named = written(targets(rows.select("source", "size"), weights, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate + TINY), F.lit(cap)).cast("long")
    part = F.greatest(F.lit(0.0), rate - whole)
    # a number for each source and block; blocks per source follow from its row count
    units = (
        rows.join(named, rows["source"].eqNullSafe(named["source"])).drop(named["source"])
        .withColumn("whole", whole)
        .withColumn("p", part)
        .withColumn("blocks", F.ceil(F.col("n_docs") / block))
        .withColumn("block", F.pmod(F.col("u"), F.col("blocks")))
    )
    keep = "doc_id long, source string, size long, h long, u long, source_size long, n_docs long, target double, whole long, p double, blocks long, block long"
    names = [c.split()[0] for c in keep.split(", ")]

    def move(last: bool):
        def work(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["u", "doc_id", "size"], na_position="first", ignore_index=True)
            step = landing if last else flight
            group["p"] = step(group["p"].to_numpy(), group["size"].to_numpy(dtype=float))
            return group[names]

        return work

    decided = []
    state = units.select(*names)
    level = 0
    biggest = named.agg(F.max("n_docs")).first()[0] or 0
    while True:
        # at most two undecided units leave a block; a later block takes those of many blocks
        last = biggest <= block
        state = written(
            state.groupBy("source", "block").applyInPandas(move(last), keep), f"mix-flight-{level}"
        )
        if last:
            decided.append(state)
            break
        open_ = (F.col("p") > TINY) & (F.col("p") < 1 - TINY)
        decided.append(state.filter(~open_))
        biggest = 2 * -(-biggest // block)
        state = (
            state.filter(open_)
            .withColumn("blocks", F.greatest(F.lit(1), F.ceil(2 * F.col("blocks") / block)))
            .withColumn("block", F.pmod(F.xxhash64("u"), F.col("blocks")))
        )
        level += 1
    every = decided[0]
    for more in decided[1:]:
        every = every.unionByName(more)
    copies = F.least(F.col("whole") + F.round("p").cast("long"), F.lit(cap))
    return every.select(
        "doc_id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "h"
    )


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` as the mix takes it: each row as often as its copies say, columns unchanged.

    Copies come from ``mixed``; the join is on hashes of doc_id with text and of the source.
    Rows equal in these are one document drawn several times: the draws are shared out to
    the rows in turn.
    """
    drawn = mixed(docs, weights, cap).withColumn("__s", F.xxhash64("source"))
    per_key = drawn.groupBy("h", "__s").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    per_key = per_key.withColumnRenamed("h", "__h")
    hashed = docs.withColumn("__h", F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))).withColumn(
        "__s", F.xxhash64("source")
    )
    turn = Window.partitionBy("__h", "__s").orderBy(F.lit(0))
    share = F.floor(F.col("__copies") / F.col("__rows")) + F.when(
        F.col("__at") <= F.col("__copies") % F.col("__rows"), 1
    ).otherwise(0)
    return (
        hashed.join(per_key, ["__h", "__s"])
        .withColumn("__at", F.row_number().over(turn))
        .withColumn("__n", share.cast("int"))
        .filter("__n > 0")
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__n"))))
        .select(*[f"`{c}`" for c in docs.columns])
    )
