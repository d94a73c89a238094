import pytest
from pyspark.sql import functions as F

from arrears import contracts as K
from arrears.operators import quality
from arrears.plans import refresh
from arrears.sources import tables


def invoices(spark, n, start=1):
    return spark.range(start, start + n).select(
        F.col("id").alias("invoice_id"), F.concat(F.lit("CLIENTE "), F.col("id") % 5).alias("client"),
        F.lit("2025-01-01").cast("date").alias("invoice_date"), F.lit("SERVICIO").alias("concept"),
        F.lit(1000.0).alias("total"), F.lit("2025-01-10").cast("date").alias("paid_date"),
        F.lit(9).alias("days_to_pay"), F.lit(1).alias("is_paid"))


def rules(df, current=0, guard=quality.INVOICE_GUARD):
    return sorted(r.rule for r in quality.problems(df, guard, current).collect())


@pytest.mark.parametrize("n,current,want", [
    (100, 100, []), (50, 100, ["volume"]), (90, 100, []), (89, 100, ["volume"]), (3, 0, []), (3, None, []),
    (0, 0, ["empty"]), (0, 100, ["empty", "volume"]),
])
def test_volume_and_empty_guards(spark, n, current, want):
    assert rules(invoices(spark, n), current) == want


def test_repeated_null_key_and_null_date(spark):
    twice = invoices(spark, 5).union(invoices(spark, 1))
    assert rules(twice) == ["repeated_key"]
    assert [tuple(r) for r in quality.repeated_keys(twice, "invoice_id").collect()] == [(1, 2)]
    null_ids = invoices(spark, 3).withColumn("invoice_id", F.lit(None).cast("bigint"))
    # the contract asks for the number, and a missing one is not a repeated one
    assert rules(null_ids) == ["null_invoice_id"]
    assert rules(invoices(spark, 3).withColumn("paid_date", F.lit(None).cast("date"))) == []
    no_date = F.when(F.col("invoice_id") > 1, F.col("invoice_date"))
    assert rules(invoices(spark, 3).withColumn("invoice_date", no_date)) == ["null_invoice_date"]
    bad = invoices(spark, 4).union(invoices(spark, 1)).withColumn("invoice_date", no_date)
    assert rules(bad, 100) == ["null_invoice_date", "repeated_key", "volume"]


def test_score_guards(spark):
    def scores(*clients):
        return spark.createDataFrame([(c,) for c in clients], "client string")

    assert rules(scores("A", "B"), 2, quality.SCORE_GUARD) == []
    assert rules(scores("A", "A"), 0, quality.SCORE_GUARD) == ["repeated_key"]
    assert rules(scores("A", None), 0, quality.SCORE_GUARD) == ["null_client"]
    assert rules(scores("A", "B", "C", "D"), 10, quality.SCORE_GUARD) == ["volume"]


def test_constraint_obstacles_lists_ten_repeats_and_null_counts(spark):
    df = spark.range(30).select((F.col("id") % 12).alias("invoice_id"), F.when(F.col("id") > 3, "c").alias("client"),
                                F.lit(1.0).alias("total"))
    out = quality.constraint_obstacles(df, "invoice_id", ["invoice_id", "client", "total"]).collect()
    assert [(r.item, r.n) for r in out if r.kind == "repeated_key"] == (
        [(str(i), 3) for i in range(6)] + [(str(i), 2) for i in range(6, 10)])
    assert [(r.item, r.n) for r in out if r.kind == "null"] == [("client", 4)]


def test_first_load_replace_and_refusal(spark, tmp_path):
    root, table = str(tmp_path / "t"), "guarded_invoices"
    assert quality.row_count(spark, table) is None
    assert tables.guarded_swap(spark, table, invoices(spark, 10), quality.INVOICE_GUARD, root, K.INVOICES) is None
    assert quality.row_count(spark, table) == 10
    # the plan may read the table that it replaces
    grown = spark.table(table).union(invoices(spark, 5, start=100))
    assert tables.guarded_swap(spark, table, grown, quality.INVOICE_GUARD, root) == 10
    assert quality.row_count(spark, table) == 15
    with pytest.raises(quality.ValidationError) as error:
        tables.guarded_swap(spark, table, invoices(spark, 2).union(invoices(spark, 2)), quality.INVOICE_GUARD, root)
    assert len(error.value.problems) == 3 and "1" in error.value.problems[-1]
    assert quality.row_count(spark, table) == 15
    assert [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in K.INVOICES]
    spark.sql(f"DROP TABLE {table}")


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    root, table = str(tmp_path / "t"), "failing_invoices"
    tables.swap_table(spark, table, invoices(spark, 4), root)
    boom = invoices(spark, 4).withColumn("total", F.when(F.col("invoice_id") < 4, 1.0).otherwise(F.raise_error(F.lit("x"))))
    with pytest.raises(Exception):
        tables.swap_table(spark, table, boom, root)
    assert spark.table(table).agg(F.sum("total")).first()[0] == 4000.0
    tables.swap_table(spark, table, invoices(spark, 0), root)
    assert quality.row_count(spark, table) == 0  # an empty table is not a missing one
    spark.sql(f"DROP TABLE {table}")


def test_copy_tables_and_reconcile(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.swap_table(spark, "src_a", invoices(spark, 6), root)
    tables.swap_table(spark, "src_b", invoices(spark, 0), root)
    report = tables.copy_tables(spark, {"src_a": "dst_a", "src_b": "dst_b", "src_c": "dst_c"}, root)
    assert [tuple(r) for r in report.collect()] == [("src_a", 6, 6, "ok")]
    quality.require_reconciled(report)
    changed = {"src_a": spark.table("dst_a").withColumn("total", F.lit(2.0))}
    broken = quality.reconcile({"src_a": spark.table("src_a")}, changed)
    assert broken.first().status == "content differs"
    with pytest.raises(quality.ValidationError):
        quality.require_reconciled(broken)
    for t in ("src_a", "src_b", "dst_a"):
        spark.sql(f"DROP TABLE {t}")


def test_weekly_refresh_end_to_end(spark, tmp_path):
    export, root, csv = (str(tmp_path / n) for n in ("export", "tables", "csv"))
    rows = [(str(i), f" c{i % 3} ", "01/03/2025", "MANT", str(100.0 + i), "11/03/2025" if i % 2 else None) for i in range(30)]
    spark.createDataFrame(rows, K.RAW_INVOICES).write.option("header", True).csv(export)
    scores = refresh.refresh(spark, export, root, "2026-06-11", csv)
    assert {r.client for r in scores.collect()} == {"C0", "C1", "C2"}
    back = spark.read.option("header", True).csv(csv)
    assert back.columns == K.CLIENT_SCORES.fieldNames() and back.count() == 3
    short = str(tmp_path / "short")
    spark.createDataFrame(rows[:5], K.RAW_INVOICES).write.option("header", True).csv(short)
    with pytest.raises(quality.ValidationError):
        refresh.refresh(spark, short, root, "2026-06-12", csv)
    assert spark.table("invoices").count() == 30
    assert {r.computed_on for r in spark.table("client_scores").collect()} == {"2026-06-11"}
    for t in ("invoices", "client_scores"):
        spark.sql(f"DROP TABLE {t}")


def test_of_two_interleaved_swaps_one_is_refused(spark, tmp_path):
    name, root = "raced_rows", str(tmp_path / "raced")
    tables.swap_table(spark, name, spark.range(3), root)
    seen = tables.location(spark, name)
    tables.swap_table(spark, name, spark.range(5), root, seen=seen)
    with pytest.raises(tables.ChangedMeanwhile):
        tables.swap_table(spark, name, spark.range(9), root, seen=seen)
    assert spark.table(name).count() == 5
    # both read the same version and one is past the check already
    folder = tables._Folder(spark, f"{root}/{name}")
    assert folder.claim("after-" + tables.location(spark, name).rsplit("/", 1)[-1])
    with pytest.raises(tables.ChangedMeanwhile):
        tables.swap_table(spark, name, spark.range(9), root)
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_old_versions_go(spark, tmp_path):
    name, root = "versioned_rows", str(tmp_path / "versions")
    for n in range(1, 6):
        tables.swap_table(spark, name, spark.range(n), root, keep_versions=2)
        assert spark.table(name).count() == n
    assert len(list((tmp_path / "versions" / name).glob("v-*"))) == 2
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_differing_keys_equal_a_plain_comparison(spark, buckets):
    source = [(None, "n", 1.0), (1, "a", 1.0), (1, "a", 1.0), (2, "b", None), (3, "c", 2.0), (4, "d", 1.0), (5, "e", 7.0)]
    target = [(None, "n", 2.0), (1, "a", 1.0), (2, None, None), (3, "c", 2.0), (5, "e", 7.0), (6, "f", 0.0), (6, "f", 0.0)]
    kinds = "k int, t string, `a.b` double"
    left, right = spark.createDataFrame(source, kinds), spark.createDataFrame(target, kinds).select("a.b".join("``"), "t", "k")
    found = quality.differing_keys(left, right, ["k"], buckets).collect()
    assert sorted(map(tuple, found), key=str) == sorted([
        (None, 1, 1, "content differs"), (1, 2, 1, "row count differs"), (2, 1, 1, "content differs"),
        (4, 1, 0, "missing in target"), (6, 0, 2, "missing in source"),
    ], key=str)
    assert quality.differing_keys(left, left, ["k"], buckets).count() == 0
    assert quality.differing_keys(left.limit(0), left.limit(0), ["k"], buckets).count() == 0
    with pytest.raises(ValueError):
        quality.differing_keys(left, right.drop("t"), ["k"])
