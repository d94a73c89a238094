"""Long repeated word sequences across documents, found by recompression.

A text is a sequence of word codes.  Rounds of recompression replace runs of a symbol and
pairs of neighbouring symbols by new symbols.  Whether a pair merges depends only on a bit
of each symbol, and the name of the new symbol on the two names alone, so every task names
alike without asking others, and equal word sequences get equal symbols inside.  For each
symbol the span of words is known that its existence depends on.  The anchor of a window
is the longest symbol whose span lies in the window: a function of the window's words.
Equal windows therefore have equal anchors, and only anchors that several documents share
need a closer look.

The closer look goes over groups, the neighbouring windows of one anchor: a group that a
smaller document holds in full is settled; the others are compared window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from arrears.llm.common import on_executors, pieces, removed, shuffles_freed, texts, written

WINDOW = 13
ROUNDS = 3
#: longest symbol in words and longest group in windows; a group's first and last window cover it
LONGEST = 13
GROUP = 12
#: words that one pass of the arrays handles; longer texts go through in overlapping slices
SLICE = 200_000

_FAR = 1 << 40
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Codes(dict):
    """64-bit code of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word, 1)
        return code


def mixed(a: np.ndarray, b) -> np.ndarray:
    """Names of ordered pairs: a 64-bit finaliser over both."""
    x = a * _BASE ^ (b + np.uint64(0x7F4A7C15F39CC060) + (a << np.uint64(6)) + (a >> np.uint64(2)))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def symbols(words: np.ndarray, unit: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, ...]]:
    """Symbols of all rounds: ``(name, length, from, to)`` with the span each depends on.

    ``unit`` numbers the texts; nothing merges across them.  A symbol at the end of a text
    that waits for a neighbour depends on what is not there and has a span without end.
    """
    name, n = words, len(words)
    start = np.arange(n)
    end, low, high = start + 1, start.copy(), start + 1
    found = [(name, end - start, low, high)]
    for r in range(rounds):
        m = len(name)
        here = np.zeros(m, dtype=bool)
        here[:-1] = unit[:-1] == unit[1:]
        before = np.zeros(m, dtype=bool)
        before[1:] = here[:-1]
        length = end - start
        # runs: a maximal run of one symbol is named once its two ends are known
        equal = np.zeros(m, dtype=bool)
        equal[:-1] = (name[:-1] == name[1:]) & here[:-1]
        first = equal.copy()
        first[1:] &= ~equal[:-1]
        heads = np.flatnonzero(first)
        if len(heads):
            last = equal.copy()
            last[1:] = equal[:-1]
            last &= ~equal
            tails = np.flatnonzero(last)
            inside = before[heads] & here[tails]
            heads, tails = heads[inside], tails[inside]
            size = end[tails] - start[heads]
            short = size <= LONGEST
            heads, tails, size = heads[short], tails[short], size[short]
            found.append(
                (mixed(name[heads], (tails - heads).astype(np.uint64) + np.uint64(1 << 32)), size, low[heads - 1], high[tails + 1])
            )
        # pairs: left symbols merge with right ones that follow them
        left = (mixed(name, np.uint64(1000 + r)) & np.uint64(1)).astype(bool)
        merge = np.zeros(m, dtype=bool)
        merge[:-1] = left[:-1] & ~left[1:] & here[:-1] & (length[:-1] + length[1:] <= LONGEST)
        second = np.zeros(m, dtype=bool)
        second[1:] = merge[:-1]
        after, prior = np.minimum(np.arange(m) + 1, m - 1), np.maximum(np.arange(m) - 1, 0)
        new_low, new_high, new_end, new_name = low.copy(), high.copy(), end.copy(), name.copy()
        alone = left & ~merge
        new_high[alone] = np.where(here[alone], np.maximum(high[alone], high[after[alone]]), _FAR)
        alone = ~left & ~second
        new_low[alone] = np.where(before[alone], np.minimum(low[alone], low[prior[alone]]), -_FAR)
        i = np.flatnonzero(merge)
        new_name[i] = mixed(name[i], name[i + 1])
        new_end[i] = end[i + 1]
        new_low[i] = np.minimum(low[i], low[i + 1])
        new_high[i] = np.maximum(high[i], high[i + 1])
        stay = ~second
        name, start, end = new_name[stay], start[stay], new_end[stay]
        low, high, unit = new_low[stay], new_high[stay], unit[stay]
        new = merge[stay]
        found.append((name[new], (end - start)[new], low[new], high[new]))
    return found


def anchors(words: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """For each position the anchor of the window that begins there; its top bits are the symbol's length."""
    n = len(words)
    best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(WINDOW + 1)]
    for name, length, low, high in symbols(words, unit):
        span = high - low
        value = (length.astype(np.uint64) << np.uint64(58)) | (name >> np.uint64(6))
        for width in range(1, WINDOW + 1):
            fits = span == width
            if fits.any():
                best[width].append((low[fits], value[fits]))
    # best anchor of a window of width w: of its two windows of width w - 1, or one that spans it
    top = np.zeros(n + 1, dtype=np.uint64)
    for width in range(1, WINDOW + 1):
        top[:-1] = np.maximum(top[:-1], top[1:])
        for low, value in best[width]:
            np.maximum.at(top, low, value)
    return top[:n]


class Words:
    """Word codes of whole texts, cut into units of bounded length that overlap by a window."""

    def __init__(self, own: list[str], codes: Codes):
        find = codes.__getitem__
        coded = []
        for t in own:
            words = t.encode("utf-8", "surrogatepass").split()
            coded.append(np.fromiter(map(find, words), dtype=np.uint64, count=len(words)))
        self.units: list[tuple[int, int, np.ndarray]] = [
            (row, at, c[at : at + SLICE + WINDOW - 1])
            for row, c in enumerate(coded)
            for at in range(0, max(0, len(c) - WINDOW + 1), SLICE)
        ]

    def parts(self) -> Iterator[tuple[np.ndarray, ...]]:
        """``(row, position, word code, unit)`` of some units at a time."""
        some: list[tuple[int, int, np.ndarray]] = []
        count = 0
        for u in [*self.units, None]:
            if u is None or count + len(u[2]) > 2 * SLICE:
                if some:
                    sizes = [len(c) for _, _, c in some]
                    yield (
                        np.repeat([r for r, _, _ in some], sizes),
                        np.concatenate([np.arange(at, at + len(c)) for _, at, c in some]),
                        np.concatenate([c for _, _, c in some]),
                        np.repeat(np.arange(len(some)), sizes),
                    )
                some, count = [], 0
            if u is not None:
                some.append(u)
                count += len(u[2])


def whole(unit: np.ndarray) -> np.ndarray:
    """Positions where a window of one unit begins."""
    n = len(unit) - WINDOW + 1
    return np.flatnonzero(unit[:n] == unit[WINDOW - 1 :]) if n > 0 else np.zeros(0, dtype=int)


def window_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that begin at ``at``: a weighted sum of codes, finalised."""
    n = len(words)
    powers = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(WINDOW)]
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(WINDOW):
        total += mixed(words[np.minimum(at + k, n - 1)], np.uint64(77)) * powers[k]
    return mixed(total, np.uint64(WINDOW))


def groups(row: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, count)`` of groups: neighbouring windows ``at`` of one row and anchor, cut to ``GROUP``."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]) | (row[at[1:]] != row[at[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= (np.arange(len(at)) - head) % GROUP == 0
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return first, count


def document_anchors(docs: DataFrame) -> DataFrame:
    """``(doc_id, keys)``: the distinct anchors of each whole text of ``docs(doc_id, text)``."""
    on_executors(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in pieces(batches, limit=2 << 20):
            held: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for row, _, words, unit in Words(texts(batch.column(1)), codes).parts():
                at = whole(unit)
                key = anchors(words, unit)[at]
                order = np.lexsort((key, row[at]))
                r, k = row[at][order], key[order]
                keep = np.ones(len(r), dtype=bool)
                keep[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
                r, k = r[keep], k[keep]
                for i, own in zip(*_split(r, k)):
                    held[i].append(own)
            keys = [np.unique(np.concatenate(h)).view(np.int64) if h else None for h in held]
            rows = [i for i, k in enumerate(keys) if k is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([keys[i] for i in rows], pa.list_(pa.int64()))],
                ["doc_id", "keys"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, keys array<long>")


def _split(row: np.ndarray, value: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by row, rows in ascending order."""
    if not len(row):
        return [], []
    cut = np.flatnonzero(np.diff(row)) + 1
    return row[np.append(0, cut)].tolist(), np.split(value, cut)


def document_groups(docs: DataFrame) -> DataFrame:
    """Groups of the windows whose anchor is in ``keys``, from ``docs(doc_id, text, keys)``.

    ``(doc_id, text_hash, start, key, group_hash, windows)``: word position of the first
    window, hash of the group and of each window.
    """
    on_executors(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in pieces(batches, limit=2 << 20):
            shared = batch.column(3)
            offsets = np.asarray(shared.offsets)
            flat = np.asarray(shared.flatten()).view(np.uint64)
            base = offsets[0]
            for row, position, words, unit in Words(texts(batch.column(2)), codes).parts():
                at = whole(unit)
                key = anchors(words, unit)[at]
                wanted = np.zeros(len(at), dtype=bool)
                edges = np.append(np.flatnonzero(np.append(True, np.diff(row[at]) != 0)), len(at)) if len(at) else [0]
                for a, b in zip(edges[:-1], edges[1:]):
                    r = row[at[a]]
                    wanted[a:b] = np.isin(key[a:b], flat[offsets[r] - base : offsets[r + 1] - base])
                at, key = at[wanted], key[wanted]
                if not len(at):
                    continue
                hashes = window_hashes(words, at)
                first, count = groups(row, at, key)
                last = first + count - 1
                own = mixed(mixed(hashes[first], hashes[last]), count.astype(np.uint64))
                rows = pa.array(row[at[first]])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(at)), pa.int32()), pa.array(hashes.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(position[at[first]], pa.int64()),
                        pa.array(key[first].view(np.int64)),
                        pa.array(own.view(np.int64)),
                        lists,
                    ],
                    ["doc_id", "text_hash", "start", "key", "group_hash", "windows"],
                )

    return docs.select("doc_id", "text_hash", "text", "keys").mapInArrow(
        work, "doc_id long, text_hash int, start long, key long, group_hash long, windows array<long>"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, first, beyond)``: word spans that windows of smaller documents cover."""
    spark = docs.sparkSession
    known = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    held = written(document_anchors(known), "anchors")
    each = held.select("doc_id", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("key")
    shared = written(shared, "shared-anchors")
    shuffles_freed(spark)
    own = written(
        each.join(shared, "key", "left_semi").groupBy("doc_id").agg(F.collect_list("key").alias("keys")), "document-anchors"
    )
    removed(held)
    removed(shared)
    shuffles_freed(spark)
    hashed = known.withColumn("text_hash", F.hash("text"))
    found = written(document_groups(hashed.join(own, "doc_id")), "window-groups")
    removed(own)
    shuffles_freed(spark)
    smallest = written(
        found.groupBy("key", "group_hash").agg(F.min("doc_id").alias("smallest")), "distinct-groups"
    )
    whole_groups = found.select(
        "doc_id", "text_hash", "key", "group_hash", F.col("start").alias("first"),
        (F.col("start") + F.size("windows") + WINDOW - 1).alias("beyond"),
    )
    settled = written(
        whole_groups.join(smallest, ["key", "group_hash"]).filter("smallest < doc_id")
        .select("doc_id", "text_hash", "first", "beyond"),
        "settled-spans",
    )
    shuffles_freed(spark)
    # what no smaller document holds as a group: its windows one by one, where the anchor has other groups
    several = smallest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    open_ = smallest.join(several, "key", "left_semi").withColumnRenamed("smallest", "doc_id")
    unsettled = written(
        found.join(open_, ["key", "group_hash", "doc_id"]).select("doc_id", "text_hash", "start", "key", "windows"),
        "unsettled-groups",
    )
    removed(found)
    removed(smallest)
    shuffles_freed(spark)
    single = unsettled.select("doc_id", "text_hash", "start", "key", F.posexplode("windows").alias("at", "window"))
    single = single.select("doc_id", "text_hash", (F.col("start") + F.col("at")).alias("first"), "key", "window")
    least = single.groupBy("key", "window").agg(F.min("doc_id").alias("smallest"))
    later = single.join(least, ["key", "window"]).filter("smallest < doc_id").select(
        "doc_id", "text_hash", "first", (F.col("first") + WINDOW).alias("beyond")
    )
    spans = written(settled.unionByName(later), "repeated-spans")
    removed(settled)
    removed(unsettled)
    shuffles_freed(spark)
    return spans


def deduplicated(docs: DataFrame, text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs(doc_id, text)``; with ``text`` also the kept words.

    Removed is each word covered by a window of ``WINDOW`` words that also starts in a
    document with a smaller doc_id.  A null text has no words.  A row without doc_id is
    neither smaller nor larger: nothing is taken from it and nothing because of it.  Rows
    with the same doc_id do not take from each other.  Texts shorter than a window stay
    whole.  An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    on_executors(spark)
    spans = repeated_spans(docs)
    per_text = spans.groupBy("doc_id", "text_hash").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("beyond").alias("beyonds")
    )
    hashed = docs.select("doc_id", "text").withColumn("text_hash", F.hash("text"))
    marked = hashed.join(per_text, ["doc_id", "text_hash"], "left").select("doc_id", "text", "firsts", "beyonds")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, gone, digests, left = [], [], [], []
            for t, first, beyond in zip(texts(batch.column(1)), batch.column(2), batch.column(3)):
                words = t.encode("utf-8", "surrogatepass").split()
                kept = words
                if first.is_valid:
                    turn = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(turn, first.values.to_numpy(), 1)
                    np.add.at(turn, beyond.values.to_numpy(), -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()]
                joined = b" ".join(kept)
                counts.append(len(words))
                gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                left.append(joined.decode("utf-8", "surrogatepass") if text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(left, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    out = marked.mapInArrow(work, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if text else out.drop("kept")
