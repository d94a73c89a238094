"""Resampling a corpus towards the distribution of a target corpus, features by prefix CRCs.

Every run of one to three words is a feature, hashed by the CRC-32 of its bytes.  A text is
normalised to words with one space between them and scanned once; the running CRC is kept
at each word's end.  With S the CRC up to the start of a run, E the CRC up to its end and n
its bytes, CRC(run) = E xor S * x^(8n) in GF(2)[x] modulo the CRC polynomial: what came
before the run cancels.  So a run of any length costs one multiplication by a power of x,
read from tables, and no byte is hashed twice.

Feature counts of the corpus and of the target give each hash bucket a gain, the scaled
logarithm of how much likelier it is in the target; a document weighs the sum of its
gains.  Adding Gumbel noise to the weights and taking the highest scores draws without
replacement with probabilities proportional to the exponential of the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arrears.llm.common import give_back, on_executors, pieces, texts, written

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
#: percent of the documents with enough words that are drawn
PERCENT = 5
SEED = 42
#: of the scores only the part above this quantile is sorted, if it holds all that is drawn
SORTED_SHARE = 0.02

#: lower-cases A-Z, keeps digits, a-z and every byte of other characters, makes the rest spaces
_CLASS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_CLASS).split()


def _byte_steps() -> np.ndarray:
    """One byte of the CRC register: what its low byte turns into, from zlib itself."""
    # the CRC of a byte b is step[b ^ 255] ^ 0x00FFFFFF, inverted
    found = np.array([zlib.crc32(bytes([b ^ 255])) for b in range(256)], dtype=np.uint32)
    return ~found ^ np.uint32(0x00FFFFFF)


class Shifts:
    """Multiplication by x^(8n) modulo the CRC polynomial, for many values and lengths at once."""

    SHORT = 64

    def __init__(self):
        step = _byte_steps()
        self.step = step
        unit = np.zeros((4, 256), dtype=np.uint32)
        for k in range(4):
            unit[k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        tables = [unit]
        for _ in range(1, self.SHORT):
            last = tables[-1]
            tables.append(step[last & np.uint32(255)] ^ (last >> np.uint32(8)))
        #: what each of the four bytes of a value contributes after n zero bytes
        self.short = np.stack(tables).reshape(-1)
        last = tables[-1]
        self.powers = [step[last & np.uint32(255)] ^ (last >> np.uint32(8))]

    def _apply(self, table: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = table[0][x & np.uint32(255)]
        for k in range(1, 4):
            out ^= table[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def _power(self, k: int) -> np.ndarray:
        while len(self.powers) <= k:
            last = self.powers[-1]
            self.powers.append(self._apply(last, last))
        return self.powers[k]

    def __call__(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = (n % self.SHORT) * 1024
        out = self.short[at + (x & np.uint32(255))]
        for k in range(1, 4):
            out ^= self.short[at + 256 * k + ((x >> np.uint32(8 * k)) & np.uint32(255))]
        far = np.flatnonzero(n >= self.SHORT)
        rest, k = n[far] // self.SHORT, 0
        while len(far):
            odd = far[rest & 1 == 1]
            out[odd] = self._apply(self._power(k), out[odd])
            rest, k = rest >> 1, k + 1
            far, rest = far[rest > 0], rest[rest > 0]
        return out

    def after_space(self, crc: np.ndarray) -> np.ndarray:
        """The running CRCs after one more space."""
        register = ~crc
        return ~(self.step[(register ^ np.uint32(0x20)) & np.uint32(255)] ^ (register >> np.uint32(8)))


def feature_hashes(batch: list[str], shifts: Shifts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, document, words)``: CRC-32 of all features, whose they are, and the words of each document.

    One running CRC goes through all documents of the batch; runs do not cross documents.
    """
    split = [words_of(t) for t in batch]
    count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = [w for words in split for w in words]
    if not flat:
        return np.empty(0, np.uint32), np.empty(0, np.int64), count
    length = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    document = np.repeat(np.arange(len(split)), count)
    crc = zlib.crc32
    ends = np.fromiter(
        accumulate(flat, lambda c, w: crc(w, crc(b" ", c)), initial=0), dtype=np.uint32, count=len(flat) + 1
    )
    starts = shifts.after_space(ends[:-1])
    ends = ends[1:]
    to = np.cumsum(length + 1)  # one space before each word
    found, whose = [], []
    for n in range(LONGEST):
        if n >= len(flat):
            break
        last = np.arange(n, len(flat))
        first = last - n
        inside = document[first] == document[last]
        first, last = first[inside], last[inside]
        size = to[last] - to[first] + length[first]
        found.append(ends[last] ^ shifts(starts[first], size))
        whose.append(document[first])
    return np.concatenate(found), np.concatenate(whose), count


def bucket_counts(docs: DataFrame) -> DataFrame:
    """``(bucket, n)`` of all features of ``docs(text)``; each task sends at most one row per bucket."""
    on_executors(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, total = Shifts(), np.zeros(BUCKETS, dtype=np.int64)
        for batch in pieces(batches, limit=2 << 20):
            hashes, _, _ = feature_hashes(texts(batch.column(0)), shifts)
            total += np.bincount(hashes % np.uint32(BUCKETS), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])
        give_back()

    return docs.select("text").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``(bucket, gain)`` for every bucket: floor(1000 ln of the ratio of add-one shares), target over corpus."""
    spark = docs.sparkSession
    both = (
        spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
        .join(bucket_counts(target).withColumnRenamed("n", "t"), "bucket", "left")
        .join(bucket_counts(docs).withColumnRenamed("n", "s"), "bucket", "left")
        .na.fill(0, ["t", "s"])
    )
    both = written(both, "bucket-counts")
    total = both.agg(F.sum("s"), F.sum("t")).first()
    real = lambda c: c.cast("double")
    ratio = real(F.col("t") + 1) * F.lit(float(total[0] + BUCKETS)) / (real(F.col("s") + 1) * F.lit(float(total[1] + BUCKETS)))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row; ``gain`` has one value per bucket."""
    spark = docs.sparkSession
    on_executors(spark)
    shared = spark.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, own = Shifts(), shared.value
        for batch in pieces(batches, limit=2 << 20):
            hashes, whose, count = feature_hashes(texts(batch.column(1)), shifts)
            value = own[hashes % np.uint32(BUCKETS)]
            # sums of whole numbers below 2^53 are exact in doubles
            weight = np.bincount(whose, weights=value, minlength=len(count)).astype(np.int64)
            features = np.bincount(whose, minlength=len(count))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count), pa.array(features.astype(np.int64)), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int = SEED) -> Column:
    """Gumbel noise times 1,000, rounded down, that follows from the doc_id; a null one counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1 is the highest score, null below the drawn share.

    Rows with at least ``min_words`` words take part; ties go to the smaller doc_id.  Rows
    are numbered by their place in a range-sorted table plus the rows of the partitions
    before, so no task orders more than its range.  Equal rows differ by a row number in the
    sort key, and so even they are dealt to several ranges.
    """
    rows = written(scored.withColumn("__row", F.monotonically_increasing_id()), "weighed")
    able = rows.filter(F.col("n_words") >= min_words)
    n, low = able.agg(
        F.count(F.lit(1)), F.percentile_approx("score", max(0.0, 1 - percent / 100 - SORTED_SHARE), 10_000)
    ).first()
    drawn = percent * n // 100
    columns = [c for c in rows.columns if c != "__row"]
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return rows.select(*columns, none)
    high = F.col("score") >= low
    if able.filter(high).count() < drawn:  # the quantile is approximate
        high = F.lit(True)
    part = F.coalesce((F.col("n_words") >= min_words) & high, F.lit(False))
    keys = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("__row")]
    placed = written(
        rows.filter(part).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33)),
        "ranked",
    )
    before, starts = 0, []
    for p, size in placed.groupBy("__part").count().orderBy("__part").collect():  # one row per partition
        starts.append((p, before))
        before += size
    offsets = rows.sparkSession.createDataFrame(starts, "__part int, __before long")
    rank = F.col("__before") + F.col("__at") + 1
    top = placed.join(F.broadcast(offsets), "__part").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    return rows.filter(~part).select(*columns, none).unionByName(top)


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank, n_words)``, one row per row of ``docs(doc_id, text)``.

    ``target(text)`` is the corpus whose distribution is wanted.  A null or empty text has
    no words, weight 0 and a score, and is never drawn.  Repeated rows stay repeated and are
    ranked one after the other; a null doc_id stays null, comes before others in ties and
    takes its noise from the empty id.  An empty target leaves counts of zero; an empty
    table gives an empty result.  Other columns are not read.  The driver holds the 10,000
    gains, and the number of rows of each sorted partition.
    """
    found = gains(docs, target).collect()
    gain = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, value in found:
        gain[bucket] = value
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + noise())
    return ranked(scored).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
