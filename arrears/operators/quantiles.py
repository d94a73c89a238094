"""Exact, linearly interpolated quantiles that never gather a whole column.

``percentile`` keeps one map entry per distinct value in a single task.  That
is fine for whole days, whose domain is bounded by the calendar, and is used
for them after counting per day (:func:`day_quantiles`).  Amounts have no such
bound, so :func:`exact_quantiles` brackets each wanted rank with an approximate
sketch and only ranks the few distinct values inside the brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The sketch errs by at most 1/ACCURACY of the rows; brackets are four times
#: as wide on either side, and the result is checked against them.
ACCURACY = 50_000
MARGIN = 4.0 / ACCURACY


def day_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Quantiles of a whole-number column with a bounded domain.

    Counting per (group, value) first spreads a hot group over many tasks and
    shrinks what the quantile has to read.
    """
    by = by or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(
        *[F.percentile(column, p, F.col("n")).alias(name) for name, p in probs.items()]
    )


#: Slices of a bracket with about as many distinct values each; only the slice with the wanted
#: rank is ranked.  A power of two, for the search among the cuts.
SLICES = 512
#: the cuts' sketch errs by a tenth of a slice at most
CUT_ACCURACY = 10 * SLICES


def _brackets(df: DataFrame, values: list[str], wanted: list[tuple[int, float]], by: list[str]) -> DataFrame:
    """Per group: for each wanted (column, probability) its position, low and high bounds."""
    sides = {
        c: [min(max(p + side * MARGIN, 0.0), 1.0) for i, p in wanted if i == c for side in (-1, 1)]
        for c in range(len(values))
    }
    aggregates = []
    for c, v in enumerate(values):
        aggregates += [
            F.count(v).alias(f"n{c}"),
            F.min(v).alias(f"least{c}"),
            F.max(v).alias(f"most{c}"),
            F.percentile_approx(v, sides[c], ACCURACY).alias(f"points{c}"),
        ]
    sketch = df.groupBy(*by).agg(*aggregates)
    entries, used = [], dict.fromkeys(sides, 0)
    for which, (c, p) in enumerate(wanted):
        at = used[c]
        used[c] += 2
        low = F.col(f"least{c}") if sides[c][at] == 0.0 else F.col(f"points{c}")[at]
        high = F.col(f"most{c}") if sides[c][at + 1] == 1.0 else F.col(f"points{c}")[at + 1]
        entries.append(
            F.struct(
                F.lit(which).alias("which"),
                F.lit(c).alias("c"),
                low.alias("low"),
                high.alias("high"),
                (F.lit(p) * (F.col(f"n{c}") - 1)).alias("position"),
            )
        )
    return sketch.select(*by, F.array(*entries).alias("brackets"))


def cuts_below(cuts: Column, value: Column) -> Column:
    """How many of the ``SLICES - 1`` sorted cuts are less than ``value``, by bisection."""
    steps = F.array(*[F.lit(SLICES >> k) for k in range(1, SLICES.bit_length())])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at)
    )


def exact_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], by: str | None = None
) -> DataFrame:
    """One row (per group) with the quantiles of ``column``; see :func:`several_quantiles`."""
    return several_quantiles(df, {name: (column, p) for name, p in probs.items()}, by)


def several_quantiles(
    df: DataFrame, wanted: dict[str, tuple[str, float]], by: str | None = None
) -> DataFrame:
    """One row (per group) with named quantiles: name to (column, probability).

    ``by`` must be a column with a small fixed domain such as a flag.  The
    input is read twice, for all columns together: for the sketch, and to
    count.  In the second pass the rows on either side of a bracket collapse
    into one counter each before the shuffle, and equal values inside it into one row.
    A sketch of these rows cuts the bracket into ``SLICES`` slices of about as many
    distinct values each, however close together they lie.  Counters per slice tell
    which one holds the wanted rank; the values of that slice alone are put in
    order: of a million million rows about 2e8 fall into a bracket and 4e5 into a
    slice.  NaN counts as missing; infinite amounts are ordered like any other.
    """
    keys = [by] if by else []
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    names = list(wanted)
    pairs = [(columns.index(c), p) for c, p in wanted.values()]
    values = [f"v{i}" for i in range(len(columns))]
    numbers = [F.col(c).cast("double") for c in columns]
    rows = df.select(*keys, *[F.when(~F.isnan(x), x).alias(v) for x, v in zip(numbers, values)])
    if by:
        rows = rows.where(F.col(by).isNotNull())
    brackets = _brackets(rows, values, pairs, keys)
    if by:
        ranked = rows.join(F.broadcast(brackets), by)
    else:
        ranked = rows.withColumn("brackets", brackets.select("brackets").scalar())
    zone = F.when(F.col("v") < F.col("b.low"), -1).when(F.col("v") > F.col("b.high"), 1).otherwise(0)
    place = [*keys, "which", "position", "zone", "slice"]
    distinct = (
        ranked.select(*keys, F.array(*values).alias("values"), F.explode("brackets").alias("b"))
        .select(*keys, "b", F.element_at("values", F.col("b.c") + 1).alias("v"))
        .where(F.col("v").isNotNull())
        .withColumn("zone", zone)
        .withColumn("inner", F.when(F.col("zone") == 0, F.col("v")))
        .select(*keys, F.col("b.which").alias("which"), F.col("b.position").alias("position"), "zone", "inner", "v")
        .groupBy(*keys, "which", "position", "zone", "inner")
        .agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    )
    shares = ", ".join(f"{i / SLICES}D" for i in range(1, SLICES))
    # the cuts follow the distinct values, so that values close together do not share one slice
    cuts = (
        distinct.where(F.col("zone") == 0)
        .groupBy(*keys, "which")
        .agg(F.expr(f"percentile_approx(inner, array({shares}), {CUT_ACCURACY})").alias("cuts"))
    )
    # one row of SLICES numbers for each wanted quantile
    counted = distinct.join(F.broadcast(cuts), [*keys, "which"], "left").withColumn(
        "slice", F.when(F.col("zone") == 0, cuts_below(F.col("cuts"), F.col("inner"))).otherwise(0)
    ).drop("cuts")
    # at most SLICES + 2 rows for each wanted quantile
    over_slices = Window.partitionBy(*keys, "which").orderBy("zone", "slice")
    low_rank, high_rank = F.floor("position"), F.ceil("position")
    located = (
        counted.groupBy(*place).agg(F.sum("n").alias("held"))
        .withColumn("start", F.sum("held").over(over_slices) - F.col("held"))
        .where((F.col("start") <= high_rank) & (F.col("start") + F.col("held") > low_rank))
        .select(*keys, "which", "zone", "slice", "start")
    )
    within = Window.partitionBy(*keys, "which", "zone", "slice").orderBy("inner")
    upto = counted.join(F.broadcast(located), [*keys, "which", "zone", "slice"]).withColumn(
        "upto", F.col("start") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )

    def at(rank: Column) -> Column:
        """Value at a 0-based rank: inside the bracket or right next to it."""
        first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
        return F.max(
            F.when((F.col("zone") == 0) & rank.between(first, last), F.col("inner"))
            .when((F.col("zone") == -1) & (rank == last), F.col("most"))
            .when((F.col("zone") == 1) & (rank == first), F.col("least"))
        )

    found = upto.groupBy(*keys, "which", "position").agg(
        at(low_rank).alias("low"), at(high_rank).alias("high")
    )
    between = F.col("low") + (F.col("position") - F.floor("position")) * (F.col("high") - F.col("low"))
    value = F.when((F.col("low") == F.col("high")) | (low_rank == high_rank), F.col("low")).otherwise(between)
    checked = found.withColumn(
        "q",
        F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), value).otherwise(
            F.raise_error(F.lit("quantile rank outside its bracket"))
        ),
    )
    return checked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("which") == i, F.col("q"))).alias(name) for i, name in enumerate(names)]
    )


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct column, evaluated once as a scalar subquery."""
    return df.select(F.struct(*[F.col(c) for c in df.columns])).scalar()
