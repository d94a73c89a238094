"""Quality rules: text statistics, and lines that too many documents of a host share.

Built-in functions only.  Lines are normalised and hashed; a line that more documents of
its host hold than the limits allow is boilerplate and is removed.  Distinct documents are
counted: copies, whose lines are the same when normalised, count once, and near copies
count each.  A document that loses too many of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arrears.llm.common import WORD, written

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: a line in more distinct documents of its host than this is above the limit
MAX_DOCUMENTS = 20
#: of a document's words this share must remain
MIN_REMAINING = 0.5


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words within three-word windows that occur twice or more, the first occurrence included.

    Windows are hashed and sorted with their positions, so equal ones are neighbours; a
    sorted list of the repeated positions then gives the words they cover.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda h, i: F.struct(F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)).alias("h"), i.alias("i")),
        )

    def positions(ordered: Column) -> Column:
        found = F.filter(
            ordered,
            lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]).eqNullSafe(True)
            | (F.get(ordered, k + 1)["h"] == x["h"]).eqNullSafe(True),
        )
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    ordered = _with(hashes, lambda h: F.sort_array(windows(h)))
    return _with(_with(ordered, positions), covered).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """Base columns of ``docs(doc_id, text, source)`` and its lines, one row per row.

    A null text is the empty text: no words, no lines.
    """
    text = F.coalesce("text", F.lit(""))
    has_word = lambda line: line.rlike(WORD)
    normal = lambda line: F.trim(F.regexp_replace(F.lower(line), SPACES, " "))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("host"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.split(text, "\n", -1), has_word).alias("lines"),
    )
    return rows.select(
        "doc_id",
        "host",
        F.monotonically_increasing_id().alias("row"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.md5(F.concat_ws("\n", F.transform("lines", normal))).alias("document"),
        F.transform(
            "lines", lambda x: F.struct(F.xxhash64(normal(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))
        ).alias("lines"),
    )


def judged(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    max_share: float | None = None,
    min_remaining: float = MIN_REMAINING,
) -> DataFrame:
    """Base columns, ``base_failed``, ``kept`` and ``n_removed_words``, one row per row of ``docs``.

    A line goes if more than ``max_documents`` distinct documents of its host hold it, and,
    where ``max_share`` is given, more than that share of the host's distinct documents.
    Rows without a source are one host of their own.  Repeated rows stay repeated and count
    as one document.  A null doc_id stays null.  An empty table gives an empty result; other
    columns are not read.  The texts are read once; lines are joined by host and hash with
    the few that are above the limits, a line of a third of all documents included.
    """
    rows = written(statistics(docs), "text-statistics")
    lines = rows.select("row", "host", "document", F.explode("lines").alias("x")).select("row", "host", "document", "x.h", "x.w")
    counted = (
        lines.select("host", "h", "document").distinct()
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_documents)
    )
    if max_share is not None:
        hosts = rows.select("host", "document").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
        counted = counted.join(hosts, "host").filter(F.col("n") > max_share * F.col("documents"))
    counted = counted.select("host", "h")
    removed = lines.join(written(counted, "frequent-lines"), ["host", "h"]).groupBy("row").agg(F.sum("w").cast("long").alias("removed"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.drop("lines", "document").join(removed, "row", "left").withColumn("removed", F.coalesce("removed", F.lit(0).cast("long")))
    remaining = F.col("n_words") - F.col("removed")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (remaining >= min_remaining * F.col("n_words"))).alias("kept"),
        F.col("removed").alias("n_removed_words"),
    )


#: DuckDB SQL for ``judged`` with the default limits
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT r, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS k FROM g WHERE w3 IS NOT NULL),
p AS (SELECT r, count(DISTINCT i + j) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS j FROM c WHERE k > 1) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM w GROUP BY r),
l AS (SELECT r, host, i, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS norm,
      len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
      FROM (SELECT r, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT r, host, string_split(t, chr(10)) AS ls FROM d))
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
u AS (SELECT r, count(*) - count(DISTINCT line) AS dup, md5(string_agg(norm, chr(10) ORDER BY i)) AS document FROM l GROUP BY r),
q AS (SELECT host, norm FROM l JOIN u USING (r) GROUP BY host, norm HAVING count(DISTINCT document) > 20),
x AS (SELECT r, sum(words) AS gone FROM l JOIN q USING (host, norm) GROUP BY r),
s AS (SELECT d.doc_id, d.t, coalesce(n.n, 0) AS n_words, coalesce(u.dup, 0) AS dup, coalesce(p.n, 0) AS rep, coalesce(x.gone, 0) AS gone
      FROM d LEFT JOIN n USING (r) LEFT JOIN u USING (r) LEFT JOIN p USING (r) LEFT JOIN x USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
       CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(dup AS BIGINT) AS n_dup_lines, CAST(rep AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * rep > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * rep > 50 * n_words) AND n_words - gone >= 0.5 * n_words AS kept,
       CAST(gone AS BIGINT) AS n_removed_words
FROM s
"""
