"""Guards that decide whether a batch may replace a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from arrears import contracts as K
from arrears.functions.numeric import ratio, round_even


class ValidationError(Exception):
    """The batch was refused; the table was not touched."""

    #: every key that occurs more than once, where that was a problem
    repeated: DataFrame | None = None

    def __init__(self, table: str, problems: list[str]):
        self.table = table
        self.problems = list(problems)
        listed = "\n".join(f"  - {p}" for p in self.problems)
        super().__init__(f"{len(self.problems)} problem(s), '{table}' left as it was:\n{listed}")


@dataclass(frozen=True)
class Guard:
    """What a table demands: its key, and columns that may not be NULL."""

    key: str
    required: tuple[str, ...]


def contract_guard(schema: T.StructType, key: str) -> Guard:
    """The guard of a table contract: its key, and all columns that may not be NULL."""
    return Guard(key, tuple(f.name for f in schema.fields if not f.nullable))


INVOICE_GUARD = contract_guard(K.INVOICES, "invoice_id")
SCORE_GUARD = Guard(key="client", required=("client",))


def row_count(spark: SparkSession, table: str) -> int | None:
    """Rows of a catalog table; ``None`` if it does not exist, unlike empty."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table).count()


def _profile(df: DataFrame, guard: Guard) -> DataFrame:
    """Counts behind every guard, from one scan and one shuffle on the key."""
    per_key = df.groupBy(guard.key).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in guard.required],
    )
    repeated = F.col(guard.key).isNotNull() & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count_if(repeated).alias("n_repeated"),
        *[
            F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}")
            for c in guard.required
        ],
    )


def problems(df: DataFrame, guard: Guard, current_rows: int | None = 0) -> DataFrame:
    """All reasons to refuse ``df``: ``rule, severity, detail, n_rows``.

    No rows means the batch is safe.  A missing or empty current table sets no
    volume floor.  Repeated keys are counted here and listed in full by
    :func:`repeated_keys`.
    """
    current = current_rows or 0
    floor = K.VOLUME_FLOOR * current
    n = F.col("n")
    checks: list[tuple[str, Column, Column, Column]] = [
        ("empty", n == 0, F.lit("no rows"), n),
        (
            "volume",
            (F.lit(current) > 0) & (n < F.lit(floor)),
            F.concat(n.cast("string"), F.lit(f" rows against {current} now")),
            n,
        ),
        (
            "repeated_key",
            F.col("n_repeated") > 0,
            F.concat(F.col("n_repeated").cast("string"), F.lit(f" repeated {guard.key} values")),
            F.col("n_repeated"),
        ),
    ]
    for c in guard.required:
        missing = F.col(f"null_{c}")
        detail = F.concat(missing.cast("string"), F.lit(f" rows without {c}"))
        checks.append((f"null_{c}", missing > 0, detail, missing))
    found = F.array(
        *[
            F.when(
                broken,
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit("error").alias("severity"),
                    detail.alias("detail"),
                    amount.cast("bigint").alias("n_rows"),
                ),
            )
            for rule, broken, detail, amount in checks
        ]
    )
    return _profile(df, guard).select(F.inline(F.array_compact(found)))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Every key that occurs more than once, most frequent first; NULLs aside."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .orderBy(F.col("n").desc(), key)
    )


def constraint_obstacles(df: DataFrame, key: str, required: list[str], examples: int = 10) -> DataFrame:
    """What stands against a key and NOT NULL constraints: ``kind, item, n``.

    The most repeated keys as examples, then the mandatory columns with NULLs.
    """
    repeats = repeated_keys(df, key).limit(examples).select(
        F.lit("repeated_key").alias("kind"), F.col(key).cast("string").alias("item"), "n"
    )
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).unpivot(
        [], list(required), "item", "n"
    )
    return repeats.unionByName(
        nulls.where(F.col("n") > 0).select(F.lit("null").alias("kind"), "item", "n")
    )


def refuse_if_broken(df: DataFrame, table: str, guard: Guard, current_rows: int | None) -> None:
    """Raise :class:`ValidationError` with all problems at once."""
    found = problems(df, guard, current_rows).collect()
    if not found:
        return
    texts = [f"{p.rule}: {p.detail}" for p in found]
    error = ValidationError(table, texts)
    repeats = [p.n_rows for p in found if p.rule == "repeated_key"]
    if repeats:
        every = repeated_keys(df, guard.key)
        shown = [str(r[0]) for r in every.take(10)]
        texts.append(f"most repeated {guard.key}, first {len(shown)} of {repeats[0]}: {', '.join(shown)}")
        error = ValidationError(table, texts)
        error.repeated = every
    raise error


# --------------------------------------------------------------------------
# Reconciliation
# --------------------------------------------------------------------------


def _hash(columns: list[str], *salt: Column) -> Column:
    # the hash passes over NULLs: a mark beside each value tells where they stand
    marked = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(*marked, *salt)


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-free content hash of one table."""
    row_hash = _hash(sorted(df.columns)).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("decimal(38,0)").alias("content"),
    ).select(F.lit(name).alias("table_name"), "n_rows", "content")


def reconcile(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Compare two sets of tables by name, row count and content."""

    def side(tables: dict[str, DataFrame], label: str) -> DataFrame:
        rows = None
        for name, df in tables.items():
            one = fingerprint(df, name)
            rows = one if rows is None else rows.unionByName(one)
        return rows.select(
            "table_name",
            F.col("n_rows").alias(f"{label}_rows"),
            F.col("content").alias(f"{label}_content"),
        )

    both = side(left, "source").join(side(right, "target"), "table_name", "full_outer")
    status = (
        F.when(F.col("target_rows").isNull(), "missing in target")
        .when(F.col("source_rows").isNull(), "missing in source")
        .when(F.col("source_rows") != F.col("target_rows"), "row count differs")
        .when(F.col("source_content") != F.col("target_content"), "content differs")
        .otherwise("ok")
    )
    return both.select("table_name", "source_rows", "target_rows", status.alias("status"))


def differing_keys(source: DataFrame, target: DataFrame, key: list[str], buckets: int = 4096) -> DataFrame:
    """The keys whose rows are not the same on both sides: ``key, source_rows, target_rows, status``.

    Rows of the two sides count with opposite signs, so that what is alike
    cancels out in each sum of hashes.  Sums per bucket of keys, then per bucket
    within the buckets that are left, tell where the sides differ; only rows of
    those buckets are summed per key.  Two tables alike cost two small
    aggregates of one scan each and no shuffle of rows.  Keys may be NULL or
    repeated: all rows of a key are compared as one set with repetitions.
    """
    if sorted(source.columns) != sorted(target.columns):
        raise ValueError("both sides need the same columns")
    columns = sorted(source.columns)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            *[F.col(f"`{k}`") for k in key],
            (_hash(columns).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias("_hash"),
            F.lit(sign).alias("_side"),
            F.pmod(_hash(key), F.lit(buckets)).alias("_coarse"),
            F.pmod(_hash(key, F.lit("fine")), F.lit(buckets)).alias("_fine"),
        )

    def unlike(rows: DataFrame, *by: str) -> DataFrame:
        sums = rows.groupBy(*[f"`{c}`" for c in by]).agg(
            F.sum("_hash").alias("_content"),
            F.count_if(F.col("_side") > 0).alias("source_rows"),
            F.count_if(F.col("_side") < 0).alias("target_rows"),
        )
        return sums.where((F.col("_content") != 0) | (F.col("source_rows") != F.col("target_rows")))

    rows = side(source, 1).unionByName(side(target, -1))
    coarse = unlike(rows, "_coarse").select("_coarse")
    # at most ``buckets`` numbers
    near = rows.join(F.broadcast(coarse), "_coarse", "left_semi")
    fine = unlike(near, "_coarse", "_fine").select("_coarse", "_fine")
    left = near.join(fine, ["_coarse", "_fine"], "left_semi")
    status = (
        F.when(F.col("target_rows") == 0, "missing in target")
        .when(F.col("source_rows") == 0, "missing in source")
        .when(F.col("source_rows") != F.col("target_rows"), "row count differs")
        .otherwise("content differs")
    )
    return unlike(left, *key).select(*[f"`{k}`" for k in key], "source_rows", "target_rows", status.alias("status"))


def require_reconciled(report: DataFrame) -> None:
    broken = report.where(F.col("status") != "ok").collect()
    if broken:
        raise ValidationError(
            "reconciliation", [f"{r.table_name}: {r.status}" for r in broken]
        )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULL count, share in percent, rows; one scan."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"`{f.name}`").alias("n_null"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select("n_rows", F.inline(entries)).select(
        "column_name",
        "data_type",
        "n_rows",
        "n_null",
        round_even(ratio(F.col("n_null"), F.col("n_rows")) * 100, 1).alias("pct_null"),
    )
