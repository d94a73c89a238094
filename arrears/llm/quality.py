"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.  Expectation
maximisation over the counts of vote patterns estimates how reliable each labeller is, and
a posterior for each pattern; no true label is used.  The posteriors train a hashed linear
scorer, which then judges every whole document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrears.llm.common import give_back, on_executors, pieces, texts
from arrears.llm.linear import Rows, bucket, fit

BUCKETS = 1 << 14
#: documents that the scorer is fitted on at most, chosen by a hash
MAX_FITTED = 20_000
#: documents whose probability of being good lies below are rejected
KEEP_FROM = 0.5

_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)
_SYMBOLS = frozenset(b"#*$%&|<>{}[]\\^~=_+@")

#: name, value below which (or above which) it votes good, value beyond which it votes bad
LABELLERS = (
    ("symbol_words", 0.05, 0.20),
    ("upper_words", 0.20, 0.60),
    ("same_as_before", 0.05, 0.20),
    ("repeated_triples", 0.25, 0.50),
    ("shouts", 0.05, 0.30),
    ("one_word_share", 0.15, 0.35),
    ("repeated_lines", 0.20, 0.50),
    ("not_lower", 0.30, 0.60),
    ("sameness", 0.60, 0.80),
)
#: Longer texts repeat more of their words: the number of different ones grows about as the square
#: root of the length, and beyond this many words the limit of "sameness" follows that.
SAMENESS_FROM = 400
#: below this many words the repetition labellers say nothing
SHORT = 40


def signals(text: str) -> tuple[int, dict[str, float], Counter]:
    """Words, the labellers' values and the counts of word shapes of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    n = len(tokens)
    shapes: Counter = Counter()
    for shape, k in Counter(raw.translate(_SHAPE).split()).items():
        shapes[_RUN.sub(rb"\1", shape)] += k
    if not n:
        return 0, {}, shapes
    counts = Counter(tokens)
    triples = Counter(zip(tokens, tokens[1:], tokens[2:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    values = {
        "symbol_words": sum(k for s, k in shapes.items() if not _SYMBOLS.isdisjoint(s)) / n,
        "upper_words": sum(k for s, k in shapes.items() if b"A" in s and b"a" not in s) / n,
        "same_as_before": sum(map(eq, tokens, tokens[1:])) / n,
        "repeated_triples": sum(k for k in triples.values() if k > 1) / max(1, n - 2),
        "shouts": sum(k for s, k in shapes.items() if b"!" in s) / n,
        "one_word_share": max(counts.values()) / n,
        "repeated_lines": 1 - len(set(lines)) / len(lines),
        "not_lower": 1 - sum(k for s, k in shapes.items() if s.strip(b".,;:?!\"'()-") in (b"a", b"Aa")) / n,
        "sameness": 1 - len(counts) / n,
    }
    return n, values, shapes


def votes(n: int, values: dict[str, float]) -> list[int]:
    """1 good, 0 bad, 2 nothing, for each labeller."""
    out = []
    for name, good, bad in LABELLERS:
        x = values.get(name)
        about_repeats = name in ("repeated_triples", "one_word_share", "repeated_lines", "sameness")
        if x is None or (about_repeats and n < SHORT):
            out.append(2)
        else:
            limit = bad if name != "sameness" else 1 - (1 - bad) * min(1.0, (SAMENESS_FROM / n) ** 0.5)
            out.append(0 if x > limit else 1 if x <= good else 2)
    return out


def pattern(text: str) -> int:
    n, values, _ = signals(text)
    code = 0
    for v in votes(n, values):
        code = 3 * code + v
    return code


def reliabilities(counts: dict[int, int], rounds: int = 200) -> tuple[np.ndarray, float, dict[int, float]]:
    """``(table, prior, posterior)`` by expectation maximisation over pattern counts.

    ``table[j, y, v]`` is the chance that labeller j votes v on class y when it votes at all:
    saying nothing, as on short texts, is no evidence.  The start is the votes' majority.  The number of patterns is bounded by the labellers, whatever
    the number of documents.
    """
    codes = sorted(counts)
    m = len(LABELLERS)
    v = np.array([[c // 3 ** (m - 1 - j) % 3 for j in range(m)] for c in codes], dtype=int).reshape(-1, m)
    weight = np.array([counts[c] for c in codes], dtype=float)
    good, bad = (v == 1).sum(axis=1), (v == 0).sum(axis=1)
    # a labeller that objects is heard: few do, and each looks at another fault
    p = np.where(bad == 0, 0.95, np.where(good > 4 * bad, 0.35, 0.05))
    table, prior = np.full((m, 2, 3), 1.0), 0.5
    for _ in range(rounds if len(codes) else 0):
        prior = float((weight * p).sum() / weight.sum())
        for y, share in ((1, p), (0, 1 - p)):
            for vote in range(2):
                table[:, y, vote] = ((v == vote) * (weight * share)[:, None]).sum(axis=0) + 0.5
            table[:, y, :2] /= table[:, y, :2].sum(axis=1, keepdims=True)
        odds = np.log(max(prior, 1e-9)) - np.log(max(1 - prior, 1e-9))
        for j in range(m):
            odds = odds + np.log(table[j, 1, v[:, j]]) - np.log(table[j, 0, v[:, j]])
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            p = new
            break
        p = new
    return table, prior, {c: float(x) for c, x in zip(codes, p)}


def features(text: str) -> list[int]:
    """Columns of a text: tenths of each value, shares of its word shapes, and its length class."""
    n, values, shapes = signals(text)
    out = {bucket(f"length {min(12, n.bit_length())}", BUCKETS)}
    for name, x in values.items():
        out.add(bucket(f"{name} {int(10 * x)}", BUCKETS))
    for shape, k in shapes.items():
        share = k / max(1, n)
        if share >= 0.02:
            out.add(bucket(f"shape {shape.decode('latin-1')} {int(10 * share)}", BUCKETS))
    return sorted(out)


def trained(docs: DataFrame, limit: int = MAX_FITTED) -> tuple[np.ndarray, float]:
    """Weights and intercept for ``docs(doc_id, text)``: votes of all, a fit on at most ``limit`` texts."""
    spark = docs.sparkSession
    on_executors(spark)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = Counter(map(pattern, texts(batch.column(0))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["pattern", "n"]
            )

    counted = docs.select("text").mapInArrow(vote, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r["pattern"]: r["n"] for r in counted.collect()}  # at most 3 ** labellers rows
    _, _, posterior = reliabilities(counts)
    known = spark.sparkContext.broadcast(posterior)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            own = texts(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([features(t) for t in own], pa.list_(pa.int32())),
                    pa.array([known.value.get(pattern(t), 0.5) for t in own], pa.float64()),
                ],
                ["columns", "good"],
            )

    some = docs.select(F.xxhash64("doc_id", "text").alias("__h"), "text")
    # a fixed number of rows, equal ones counting once: first the hashes alone, then the texts up to the last of them
    last = some.select("__h").distinct().orderBy("__h").limit(limit).agg(F.max("__h"), F.count(F.lit(1))).first()
    if not last[1]:
        return np.zeros(BUCKETS), 0.0
    chosen = some.filter(F.col("__h") <= F.lit(last[0])).groupBy("__h").agg(F.min("text").alias("text")).select("text")
    rows = chosen.mapInArrow(describe, "columns array<int>, good double").collect()
    rows = sorted((list(r["columns"]), r["good"]) for r in rows)
    sparse = Rows.of([np.array(c, dtype=np.int32) for c, _ in rows])
    return fit(sparse, np.array([g for _, g in rows]), BUCKETS, l1=1e-5, l2=1e-4, rounds=300)


def scored(docs: DataFrame, limit: int = MAX_FITTED, keep_from: float = KEEP_FROM, carry: bool = False) -> DataFrame:
    """``(doc_id, n_words, score, kept)`` per row of ``docs(doc_id, text)``; score is the chance of being good.

    With ``carry`` all columns of ``docs`` stay and ``__score`` is added.  A null text counts
    as empty; empty texts get the score of their length class.  Repeated rows stay repeated
    and score alike; a null doc_id stays null; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    on_executors(spark)
    weights, intercept = trained(docs, limit)
    model = spark.sparkContext.broadcast((weights, intercept))

    def score(text: str) -> float:
        w, b = model.value
        return float(1 / (1 + np.exp(-np.clip(b + w[features(text)].sum(), -30, 30))))

    if carry:
        @F.pandas_udf("double")
        def judge(text: pd.Series) -> pd.Series:
            found = pd.Series([score(t or "") for t in text], dtype=float)
            give_back()
            return found

        return docs.withColumn("__score", judge("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            own = texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8", "surrogatepass").split()) for t in own], pa.int64()),
                    pa.array([score(t) for t in own], pa.float64()),
                ],
                ["doc_id", "n_words", "score"],
            )

    out = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_words long, score double")
    return out.withColumn("kept", F.col("score") >= keep_from)


def keep_good(docs: DataFrame, limit: int = MAX_FITTED, keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    return scored(docs, limit, keep_from, carry=True).filter(F.col("__score") >= keep_from).drop("__score")
