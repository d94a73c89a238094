import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from arrears import contracts as K
from arrears.functions import dates, numeric, text
from arrears.operators import cleaning, keyword_rules
from arrears.sources import invoice_export, quoted_records

D = dt.date


def export(spark):
    rows = [
        ("1", "  toyoda  ", "01/03/2025", "MANT", "1000", "11/03/2025"),
        ("2", None, "05/03/2025", "CANCELADA", "999", None),
        ("3", "ACME", "10/03/2025", "REPARACION", "500", "05/03/2025"),
        ("4", "\tacme s.a. ", "2025-03-12 00:00:00", "INSTALACION", "2000", None),
        ("5", "ZZZ", "no es fecha", "X", "300", "01/04/2025"),
        ("6", "TOYODA", "15/03/2025", "MANT", "nan", "20/03/2025"),
    ]
    return spark.createDataFrame(rows, K.RAW_INVOICES)


def test_clean_drops_normalises_and_clips(spark):
    out = {r.invoice_id: r for r in cleaning.clean_invoices(export(spark)).collect()}
    assert sorted(out) == [1, 3, 4, 6]
    assert out[1].client == out[6].client == "TOYODA"
    assert out[4].client == "ACME S.A."
    assert (out[1].invoice_date, out[1].days_to_pay, out[1].is_paid) == (D(2025, 3, 1), 10, 1)
    assert (out[3].days_to_pay, out[3].is_paid) == (0, 1)
    assert (out[4].paid_date, out[4].days_to_pay, out[4].is_paid) == (None, None, 0)
    assert out[1].total == 1000.0 and out[6].total is None


def test_clean_matches_contract_names_and_types(spark):
    out = cleaning.clean_invoices(export(spark))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in K.INVOICES]


def test_strict_dates_lose_iso_text(spark):
    df = spark.createDataFrame(
        [("26/11/2025",), ("01/02/2025",), ("5/3/2025",), ("2025-03-12 00:00:00",), ("basura",), (None,), ("31/02/2025",)],
        "c string",
    )
    lenient = [r[0] for r in df.select(dates.mixed_date(F.col("c"))).collect()]
    strict = [r[0] for r in df.select(dates.mixed_date(F.col("c"), iso_text=False)).collect()]
    assert lenient == [D(2025, 11, 26), D(2025, 2, 1), D(2025, 3, 5), D(2025, 3, 12), None, None, None]
    assert strict == [D(2025, 11, 26), D(2025, 2, 1), D(2025, 3, 5), None, None, None, None]


def test_typed_dates_pass(spark):
    raw = spark.sql(
        "SELECT '7' AS Folio, 'a' AS Cliente, timestamp_ntz'2025-03-12 23:00:00' AS Fecha, 'x' AS Concepto, "
        "double('nan') AS ` Total `, timestamp_ntz'2025-03-13 01:00:00' AS `FECHA DE PAGO`"
    )
    row = cleaning.clean_invoices(raw).first()
    assert (row.invoice_date, row.days_to_pay, row.total) == (D(2025, 3, 12), 1, None)


def test_csv_folder_scan(spark, tmp_path):
    path = str(tmp_path / "export")
    invoice_export.write_csv(export(spark).repartition(3), path)
    again = cleaning.clean_invoices(invoice_export.read_invoices(spark, path))
    assert sorted(map(str, again.collect())) == sorted(map(str, cleaning.clean_invoices(export(spark)).collect()))


def test_clean_twice_changes_nothing(spark):
    once = cleaning.clean_invoices(export(spark))
    back = once.select(
        F.col("invoice_id").alias("Folio"), F.col("client").alias("Cliente"),
        F.col("invoice_date").alias("Fecha"), F.col("concept").alias("Concepto"),
        F.col("total").alias("Total"), F.col("paid_date").alias("FECHA DE PAGO"),
    )
    assert sorted(map(str, cleaning.clean_invoices(back).collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize("block", [None, 64])
def test_sheet_scan_skips_banner_and_headers(spark, tmp_path, block):
    folder = tmp_path / "sheets"
    folder.mkdir()
    for n in range(2):
        lines = ["REPORTE,,,,", "", "H1,H2,H3,H4,H5"]
        lines += [f"F{n}-{i},OC{i},{i}.5,1,11/03/2026" for i in range(40)] + [",OC,9,9,x"]
        (folder / f"s{n}.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        raw = invoice_export.read_sheet(spark, str(folder), K.LEDGER, banner_rows=2)
        out = cleaning.clean_ledger(raw).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.factura for r in out) == sorted(f"F{n}-{i}" for n in range(2) for i in range(40))
    assert sum(r.curtrxam for r in out) == 2 * sum(i + 0.5 for i in range(40))
    assert {r.fecha_calculo for r in out} == {D(2026, 3, 11)}


def test_sheet_scan_can_start_at_a_later_column(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text("t,,,,\nx,,,,\ny,,,,\nz,COT,SUC,IMP,CON\n1,C1,S,10,\"a, b\"\n2,,S,5,c\n3,C3,S,n/a,d\n")
    out = cleaning.clean_quotes(
        invoice_export.read_sheet(spark, str(path), K.QUOTES, banner_rows=3, skip_columns=1)
    ).collect()
    assert [(r.cot, r.importe, r.concepto) for r in out] == [("C1", 10.0, "a, b"), ("C3", None, "d")]


@pytest.mark.parametrize("block", [47, 1000])
def test_records_over_many_splits(spark, tmp_path, block):
    """Cells longer than a split, escaped quotes, line ends of both kinds, two files with other headers."""
    giant = "\n".join(f"linea {k}" for k in range(60))
    cells = ["plain", "two\nlines", giant, 'say ""yes""\n', "\n\n", 'last ""\n"", end']
    rows = [(f"c{k}", cells[k % len(cells)]) for k in range(40)]
    (tmp_path / "a.csv").write_bytes(
        ("\ufeffconcepto,etiqueta_auto,\"categoria\n_modelo\",categoria_modelo\r\n" + "".join(f'{a},"{b}",x,m\r\n' for a, b in rows)).encode()
    )
    (tmp_path / "b.csv").write_text("categoria_modelo,etiqueta_auto,concepto\n" + "".join(f'm,"{b}",d{a}\n' for a, b in rows))
    (tmp_path / "c.csv").write_text("etiqueta_auto,categoria_modelo,concepto\nno breaks,m,e\n")
    with invoice_export.quoted_records.splits_of(spark, block):
        found = invoice_export.read_labels(spark, f"{tmp_path}/*.csv").collect()
    want = [(p + a, b.replace('""', '"')) for p in ("", "d") for a, b in rows] + [("e", "no breaks")]
    assert sorted((r.concepto, r.etiqueta_auto) for r in found) == sorted(want)
    assert {r.categoria_modelo for r in found} == {"m"}


def test_csv_for_spreadsheets_starts_with_a_byte_order_mark(spark, tmp_path):
    out = tmp_path / "out"
    invoice_export.write_csv(spark.sql("SELECT 'ñ' AS concepto, 'a' AS etiqueta_auto, 'b' AS categoria_modelo"), str(out), for_excel=True)
    (part,) = out.glob("part-*")
    assert part.read_bytes().startswith("\ufeffconcepto".encode())
    assert invoice_export.read_labels(spark, str(out)).first().concepto == "ñ"


def test_labels_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_bytes("﻿concepto,etiqueta_auto,categoria_modelo\nGAS,otro,venta_refaccion\n".encode())
    row = invoice_export.read_labels(spark, str(path)).first()
    assert (row.concepto, row.categoria_modelo) == ("GAS", "venta_refaccion")


def test_numbers(spark):
    df = spark.createDataFrame([("5",), (" 6.5 ",), ("1d",), ("2F",), ("nan",), ("$1,000",), ("-1e3",), (None,)], "c string")
    assert [r[0] for r in df.select(numeric.to_number(F.col("c"))).collect()] == [
        5.0, 6.5, None, None, None, None, -1000.0, None]
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (2.675,)], "x double")
    assert [r[0] for r in df.select(numeric.round_even(F.col("x"), 2)).collect()] == [0.12, 0.38, -0.12, 2.68]


def test_conform_and_widen(spark):
    df = spark.sql(
        "SELECT 1L AS invoice_id, 'A' AS client, timestamp_ntz'2025-01-01 00:00:00' AS invoice_date, 'c' AS concept, "
        "1.0D AS total, CAST(NULL AS timestamp_ntz) AS paid_date, double('nan') AS days_to_pay, 0 AS is_paid"
    )
    out = cleaning.conform(df)
    assert [f.dataType for f in out.schema] == [f.dataType for f in K.INVOICES]
    assert out.first().days_to_pay is None
    assert cleaning.widen(out).schema["days_to_pay"].dataType.simpleString() == "double"


def test_normalise_matches_the_unicode_definition(spark):
    import re
    import unicodedata

    samples = ["Mantenimientó", "peça d'été", "Straße", "Ørsted Łódź Æ", "éa", "ﬁn K Å Ǖ ṩ", "a  b\t\nc", "…", "", None, "İstanbul"]
    df = spark.createDataFrame([(s,) for s in samples], "c string")
    got = [r[0] for r in df.select(text.normalize(F.col("c"))).collect()]

    def wanted(value):
        value = unicodedata.normalize("NFD", str(value).upper())
        value = "".join(ch for ch in value if unicodedata.category(ch) != "Mn")
        return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9\s]", " ", value)).strip()

    assert got == [wanted(s) for s in samples]


def test_keyword_rules(spark):
    samples = {
        "Mantenimiento correctivo": "mantenimiento_preventivo",
        "reparacion de FUGA": "mantenimiento_correctivo",
        "INST. de equipo": "instalacion_nueva",
        "INSTRUMENTO": "otro",
        "gas r410": "venta_refaccion",
        None: "otro",
    }
    df = spark.createDataFrame([(k,) for k in samples], "c string")
    assert [r[0] for r in df.select(text.keyword_category(F.col("c"))).collect()] == list(samples.values())


def test_terms_keep_single_characters_and_counts(spark):
    df = spark.createDataFrame([("A B A B",), ("X",), ("",)], "c string")
    out = df.select(text.unigrams(F.col("c")).alias("u")).select("u", text.bigrams(F.col("u")).alias("b")).collect()
    assert out[0].u == ["A", "B", "A", "B"] and out[0].b == ["A B", "B A", "A B"]
    assert out[1].u == ["X"] and out[1].b == []
    assert out[2].u == [] and out[2].b == []


def test_filters(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "y")], "client string, kind string")
    assert cleaning.equal_if_present(df, "kind", "x").count() == 1
    assert cleaning.equal_if_present(df, "missing", "x").count() == 2
    assert cleaning.equal_if_present(df, "kind", None).count() == 2
    assert cleaning.only_members(df, "client", []).count() == 2
    assert cleaning.only_members(df, "client", ["B"]).count() == 1


def test_a_rule_table_equals_the_expression(spark):
    texts = ["Mantenimiento correctivo", "inst. de equipo", "instalar", "GAS R22", "", None, "fuga", "venta de compresor"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    words = [(p, c, w) for p, (c, ws) in enumerate(K.KEYWORD_RULES.items()) for w in ws]
    rules = spark.createDataFrame(words, "priority int, category string, keyword string")
    got = {r.id: r.found for r in keyword_rules.categories_by_rules(df, "c", rules, "found").collect()}
    want = {r.id: r.want for r in df.select("id", text.keyword_category(F.col("c")).alias("want")).collect()}
    assert got == want and len(set(want.values())) == 5


def test_ten_thousand_rules_by_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ABÉ.") for _ in range(rng.randint(1, 12)))
    rules = [(rng.randint(0, 4000), f"c{i % 7}", word()) for i in range(10_000)] + [(1, "n", None)]
    # one keyword's runs in very many others, and a text that is one long run
    rules += [(5000 + i, "z", "AAAAAAAAAAAA" + str(i)) for i in range(300)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 4))) for _ in range(150)] + ["A" * 5000 + "299", "q😀r", "", None]
    rules += [(9000, "smile", "😀R")]
    rule_table = spark.createDataFrame(rules, "priority int, category string, keyword string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    found = keyword_rules.categories_by_rules(df, "c", rule_table)
    got = {r.id: r.category for r in found.collect()}
    for i, t in enumerate(texts):
        upper = (t if t is not None else "nan").upper()
        best = min(((p, c) for p, c, k in rules if k is not None and k in upper), default=(0, K.OTHER))
        assert got[i] == best[1], t
    # a plan does not grow with the rules
    few = keyword_rules.categories_by_rules(df, "c", rule_table.limit(5))
    assert len(found._jdf.queryExecution().analyzed().toString()) < 1.1 * len(few._jdf.queryExecution().analyzed().toString())


def test_empty_keywords_and_empty_tables_of_rules(spark):
    df = spark.createDataFrame([(1, "uno"), (2, None)], "id int, c string")
    none = spark.createDataFrame([], "priority int, category string, keyword string")
    every = spark.createDataFrame([(2, "all", ""), (1, "one", "UNO"), (3, "late", "NAN")], none.schema)
    assert {r.category for r in keyword_rules.categories_by_rules(df, "c", none).collect()} == {K.OTHER}
    got = {r.id: r.category for r in keyword_rules.categories_by_rules(df, "c", every).collect()}
    assert got == {1: "one", 2: "all"}
    assert keyword_rules.categories_by_rules(df.limit(0), "c", every).columns == ["id", "c", "category"]


def test_small_splits_share_tasks_and_stay_apart(spark, tmp_path):
    records = [f'{i},"a\nb ""{i}"" ' + "x" * (i % 90) + '\n\nc"' if i % 3 == 0 else f"{i},plain" for i in range(800)]
    (tmp_path / "one.csv").write_text("\n".join(records[:500]) + "\n")
    (tmp_path / "two.csv").write_text("\n".join(records[500:]) + "\n")
    with quoted_records.splits_of(spark, 256):
        found = quoted_records.lines(spark, str(tmp_path))
        tasks = found._jdf.rdd().getNumPartitions()
        assert tasks <= max(spark.sparkContext.defaultParallelism, 2)
        assert found.select("file", "start").distinct().count() > 4 * tasks
        got = quoted_records.stitched(found).orderBy("file", "start", "number").collect()
    assert [r.record for r in got] == records
    whole = quoted_records.lines(spark, str(tmp_path))
    assert whole.select("file", "start").distinct().count() == 2
