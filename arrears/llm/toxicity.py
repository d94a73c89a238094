"""Toxicity: a hashed linear classifier that is told not to mind which group a sentence names.

Labelled texts that name a group get counterfactuals: each identity term is swapped for the
other terms of its kind.  The fit penalises the square of every change of score, so a
neutral mention of a group does not raise it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from arrears.llm.common import on_executors, pieces, texts
from arrears.llm.linear import Rows, bucket, fit

BUCKETS = 1 << 18
#: labelled rows that the fit sees at most, chosen by a hash of the id
MAX_LABELLED = 20_000
THRESHOLD = 0.3
#: a word must be in this many of the fit's texts to have a weight
MIN_TEXTS = 4

# Identity terms by kind; a term is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
)

_LETTERS = regex.compile(r"\p{L}+")
_SWAPS = {t: tuple(o for o in kind if o != t) for kind in IDENTITY_TERMS for t in kind}


def words(text: str) -> set[str]:
    """The distinct words of a text: runs of letters, lower case."""
    return set(_LETTERS.findall(text.lower()))


def features(found: set[str], buckets: int) -> np.ndarray:
    return np.unique(np.array([bucket(w, buckets) for w in found], dtype=np.int64))


def counterfactuals(found: set[str], buckets: int) -> tuple[list[int], list[int]]:
    """Columns that leave and that come (-1: is there already) when an identity term is swapped for another of its kind."""
    swaps = [(t, o) for t in sorted(found & _SWAPS.keys()) for o in _SWAPS[t]]
    return [bucket(t, buckets) for t, _ in swaps], [-1 if o in found else bucket(o, buckets) for _, o in swaps]


class ToxicityModel:
    def __init__(self, weights: np.ndarray, intercept: float, buckets: int):
        self.columns = np.flatnonzero(weights)
        self.weights, self.intercept, self.buckets = weights, intercept, buckets

    def scorer(self):
        """A function from text to probability, with a table of the words that carry weight."""
        heavy = {int(c): float(self.weights[c]) for c in self.columns}
        known: dict[str, tuple[int, float]] = {}
        buckets, intercept = self.buckets, self.intercept

        def score(text: str) -> float:
            if len(known) > 500_000:
                known.clear()
            mine = {}
            for w in words(text):
                hit = known.get(w)
                if hit is None:
                    c = bucket(w, buckets)
                    hit = known[w] = (c, heavy.get(c, 0.0))
                if hit[1]:
                    mine[hit[0]] = hit[1]
            z = intercept + sum(mine[c] for c in sorted(mine))
            return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))

        return score


def train(
    columns: list[np.ndarray], labels: np.ndarray, leaves: np.ndarray, comes: np.ndarray, buckets: int = BUCKETS, agree: float = 1.0
) -> ToxicityModel:
    """Fit on the columns of labelled texts and their swaps; without rows the model says 0.5 for every text."""
    seen = np.zeros(buckets, dtype=np.int64)
    for c in columns:
        seen[c] += 1
    use = seen >= min(MIN_TEXTS, max(1, len(columns)))
    # terms of a group keep their weight even where rare: the penalty speaks about them
    use[[bucket(t, buckets) for t in _SWAPS]] = True
    rows = Rows.of([c[use[c]] for c in columns])
    pairs = None
    if len(leaves):
        two = [np.array([a] if b < 0 else [a, b]) for a, b in zip(leaves.tolist(), comes.tolist())]
        pairs = Rows.of(two, [np.array([1.0, -1.0])[: len(p)] for p in two])
    w, b = fit(rows, labels.astype(float), buckets, pairs, agree)
    return ToxicityModel(w, b, buckets)


def train_on_texts(own: list[str], labels: list[int], buckets: int = BUCKETS, agree: float = 1.0) -> ToxicityModel:
    """``train`` for a few texts at hand."""
    found = [words(t) for t in own]
    swaps = [counterfactuals(f, buckets) for f in found]
    leaves, comes = (np.array([c for s in swaps for c in s[k]], dtype=int) for k in (0, 1))
    return train([features(f, buckets) for f in found], np.array(labels), leaves, comes, buckets, agree)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, buckets: int = BUCKETS) -> pa.Table:
    """Columns, swaps and labels of at most ``limit`` rows that learning may see, chosen by a hash of the id.

    The tasks make the columns; texts never meet the driver.
    """
    on_executors(docs.sparkSession)
    marks = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")
    )
    marks = marks.filter(~held_out("__id")).orderBy(F.xxhash64("__id"), "__id", "__toxic").limit(limit)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [words(t) for t in texts(batch.column(0))]
            swaps = [counterfactuals(f, buckets) for f in found]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([features(f, buckets).astype(np.int32) for f in found], ints),
                    pa.array([s[0] for s in swaps], ints),
                    pa.array([s[1] for s in swaps], ints),
                ],
                ["id", "toxic", "columns", "leaves", "comes"],
            )

    # the chosen labels are few by their limit: the texts stay where they are
    chosen = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("__id"))
    rows = chosen.select("text", "__id", "__toxic").mapInArrow(
        describe, "id long, toxic int, columns array<int>, leaves array<int>, comes array<int>"
    )
    return rows.orderBy("id", "toxic", F.xxhash64("columns")).limit(limit).toArrow()


def scored(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs(doc_id, text)``.

    A null text counts as empty and scores by the intercept.  A null doc_id is never held
    out and never learnt from.  Labels that are null or neither 0 nor 1 are not learnt;
    repeated rows count as often as they stand.  Without labels every score is 0.5.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    on_executors(spark)
    known = labelled(docs, labels, limit)
    flat = lambda name: np.asarray(known.column(name).combine_chunks().flatten())
    lists = known.column("columns").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(int)
    every = np.asarray(lists.flatten())
    model = train(
        [every[a:b] for a, b in zip(starts[:-1], starts[1:])],
        np.asarray(known.column("toxic").combine_chunks()), flat("leaves"), flat("comes"),
    )
    kept = spark.sparkContext.broadcast((model.columns, model.weights[model.columns], model.intercept, model.buckets))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, values, intercept, buckets = kept.value
        weights = np.zeros(buckets)
        weights[columns] = values
        score = ToxicityModel(weights, intercept, buckets).scorer()
        for batch in pieces(batches):
            found = [score(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.float64())], ["doc_id", "held_out", "score"]
            )

    out = docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        work, T.StructType.fromDDL("doc_id long, held_out boolean, score double")
    )
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
