"""Keyword categories by a rule table of any size: no expression grows with the rules.

A text holds a keyword only where it holds every run of characters of it.  Each
keyword is found through one such run, the one that the fewest keywords share,
by a join; what is found is then checked on the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arrears import contracts as K
from arrears.operators import joins

#: Lengths of the runs; a keyword uses the longest that fits.  Each doubles the one before.
WIDTHS = (1, 2, 4, 8)


def _runs(df: DataFrame, column: str) -> DataFrame:
    """Adds ``_g1, _g2, _g4, _g8``: the runs of characters of ``column``, in linear time."""

    def doubled(runs: Column, width: int) -> Column:
        last = F.greatest(F.size(runs) - width, F.lit(0))
        return F.zip_with(
            F.slice(runs, F.lit(1), last), F.slice(runs, F.lit(width + 1), last), lambda left, right: F.concat(left, right)
        )

    out = df.withColumn("_g1", F.filter(F.split(column, ""), lambda c: c != ""))
    for width in WIDTHS[:-1]:
        out = out.withColumn(f"_g{2 * width}", doubled(F.col(f"_g{width}"), width))
    return out


def _anchors(rules: DataFrame) -> DataFrame:
    """``run, keyword, rule``: the best rule of each keyword under the run that the fewest keywords share."""
    best = rules.where("keyword <> ''").groupBy("keyword").agg(F.min(F.struct("priority", "category")).alias("rule"))
    cut = _runs(best, "keyword")
    longest = F.col("_g1")
    for width in WIDTHS[1:]:
        longest = F.when(F.size(f"_g{width}") > 0, F.col(f"_g{width}")).otherwise(longest)
    every = cut.select("keyword", F.explode(F.array_distinct(longest)).alias("run"))
    shared = every.groupBy("run").agg(F.count("*").alias("n"))
    chosen = every.join(shared, "run").groupBy("keyword").agg(F.min(F.struct("n", "run")).alias("least"))
    return best.join(chosen, "keyword").select(F.col("least.run").alias("run"), "keyword", "rule")


def categories_by_rules(
    texts: DataFrame, column: str, rules: DataFrame, alias: str = "category", default: str = K.OTHER
) -> DataFrame:
    """``texts`` with the category of the first rule whose keyword the upper-case text holds.

    ``rules(priority, category, keyword)``; equal priorities go by category.  An
    empty keyword is held by every text, a missing one by none; a missing text
    reads ``NAN``.  Each distinct text is searched once.
    """
    rows = texts.withColumn("_text", F.upper(F.coalesce(F.col(column), F.lit("nan"))))
    distinct = rows.groupBy("_text").agg(F.count("*").alias("_n")).withColumn("_id", F.sha2("_text", 256))
    # the text stays behind: it meets the few keywords found, not its runs
    every = _runs(distinct.select("_id", "_text"), "_text").select(
        "_id", F.explode(F.concat(*[F.array_distinct(f"_g{w}") for w in WIDTHS])).alias("run")
    )
    near = every.join(_anchors(rules), "run").select("_id", "keyword", "rule")
    held = distinct.select("_id", "_text").join(near, "_id").where(F.contains("_text", "keyword"))
    first = held.groupBy("_id").agg(F.min("rule").alias("rule"))
    always = rules.where("keyword = ''").agg(F.min(F.struct("priority", "category"))).scalar()
    answers = distinct.join(first, "_id", "left").select(
        "_text", "_n", F.coalesce(F.least("rule", always)["category"], F.lit(default)).alias("_category")
    )
    n_rows = texts.agg(F.count("*").cast("double")).scalar()
    found = joins.split_join(rows, answers, "_text", "_n", n_rows)
    return found.drop("_text", "_n").withColumnRenamed("_category", alias)
