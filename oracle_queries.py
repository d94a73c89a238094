"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

from arrears import contracts as K
from arrears.sources.order_tables import SERVICE_PHRASES

AS_OF = "DATE '1999-01-01'"
COMPUTED_ON = "2026-06-11"


def r(x: str, digits: int = 2) -> str:
    """Round half to even, as both sides do."""
    scale = 10**digits
    return f"round_even(({x}) * {scale}::DOUBLE, 0) / {scale}::DOUBLE"


def case(column: str, mapping: dict[str, str], otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {arms} ELSE {otherwise} END"


PHRASE = case("p_type", SERVICE_PHRASES)
CONCEPT = f"{PHRASE} || ' ' || p_name || ', ' || p_brand"

RAW = f"""
lines AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship,
         arg_min(l_partkey, l_linenumber * 1000000000000 + l_partkey) AS part_key
  FROM lineitem GROUP BY l_orderkey
),
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS folio,
         CASE WHEN o_orderkey % 17 <> 0 THEN '  ' || lower(c_name) || ' ' END AS cliente,
         CASE WHEN o_orderkey % 29 = 0 THEN 'no date'
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS fecha,
         {CONCEPT} AS concepto,
         o_totalprice AS total,
         CASE WHEN o_orderstatus <> 'P' THEN strftime(last_ship, '%d/%m/%Y') END AS fecha_de_pago
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON p_partkey = part_key
)"""

INV = f"""{RAW},
dated AS (
  SELECT CAST(folio AS BIGINT) AS invoice_id, upper(trim(cliente)) AS client,
         CAST(coalesce(try_strptime(fecha, '%d/%m/%Y'),
                       try_strptime(fecha, '%Y-%m-%d %H:%M:%S')) AS DATE) AS invoice_date,
         concepto AS concept, total,
         CAST(try_strptime(fecha_de_pago, '%d/%m/%Y') AS DATE) AS paid_date
  FROM raw WHERE cliente IS NOT NULL
),
inv AS (
  SELECT *, CASE WHEN paid_date IS NOT NULL
                 THEN CAST(greatest(date_diff('day', invoice_date, paid_date), 0) AS INTEGER)
            END AS days_to_pay,
         CAST(CASE WHEN paid_date IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_paid
  FROM dated WHERE invoice_date IS NOT NULL
)"""

_hits = " ".join(
    "WHEN " + " OR ".join(f"contains(upper(coalesce(concept, 'nan')), '{w}')" for w in words)
    + f" THEN '{category}'"
    for category, words in K.KEYWORD_RULES.items()
)
CAT = f"""{INV},
cat AS (SELECT *, CASE {_hits} ELSE 'otro' END AS category FROM inv)"""

LEDGER = """
ledger AS (
  SELECT s_name AS factura, 'OC-' || CAST(s_suppkey AS VARCHAR) AS oc,
         CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 13 = 0 THEN NULL
              ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS curtrxam,
         CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS orctrxam1,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE DATE '2026-03-11' END AS fecha_calculo
  FROM supplier WHERE s_suppkey % 11 <> 0
)"""

QUOTES = f"""
quotes AS (
  SELECT 'C-' || CAST(p_partkey AS VARCHAR) AS cot, p_brand AS suc,
         CASE WHEN p_partkey % 23 = 0 THEN NULL
              ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS importe,
         {CONCEPT} AS concepto
  FROM part WHERE p_partkey % 19 <> 0
)"""

FEATURES = f"""{INV},
base AS (
  SELECT client, count(total) AS n_invoices, coalesce(sum(total), 0) AS total_amount,
         count(*) FILTER (is_paid = 0) AS n_unpaid,
         avg(days_to_pay) FILTER (is_paid = 1) AS paid_days
  FROM inv WHERE client IS NOT NULL AND total IS NOT NULL GROUP BY client
),
feat AS (
  SELECT client, n_invoices, total_amount, n_unpaid,
         coalesce(paid_days, (SELECT quantile_cont(days_to_pay, 0.95) FROM inv
                              WHERE total IS NOT NULL)) AS avg_days_to_pay,
         n_unpaid / n_invoices AS pct_unpaid
  FROM base
)"""

SCORES = f"""{FEATURES},
weighted AS (
  SELECT *, ln(1 + n_invoices) * ln(1 + total_amount) AS weight FROM feat
),
bounds AS (
  SELECT min(avg_days_to_pay) AS d0, max(avg_days_to_pay) AS d1, min(pct_unpaid) AS u0,
         max(pct_unpaid) AS u1, min(weight) AS w0, max(weight) AS w1 FROM weighted
),
scaled AS (
  SELECT weighted.*,
         CASE WHEN d1 = d0 THEN 0 ELSE (avg_days_to_pay - d0) / (d1 - d0) END AS d,
         CASE WHEN u1 = u0 THEN 0 ELSE (pct_unpaid - u0) / (u1 - u0) END AS u,
         CASE WHEN w1 = w0 THEN 0 ELSE (weight - w0) / (w1 - w0) END AS w
  FROM weighted, bounds
),
scores AS (
  SELECT client, n_invoices, total_amount, avg_days_to_pay, pct_unpaid,
         {r("(1 - d) * 100")} AS pay_score, {r("w * 100")} AS value_score,
         {r("(0.6 * u + 0.4 * d) * 100")} AS risk_score, '{COMPUTED_ON}' AS computed_on
  FROM scaled
)"""

SCORE_COLUMNS = f"""client, n_invoices, {r("total_amount")} AS total_amount,
  {r("avg_days_to_pay", 6)} AS avg_days_to_pay, {r("pct_unpaid", 6)} AS pct_unpaid,
  pay_score, value_score, risk_score"""

SUMMARY = f"""{INV},
summary AS (
  SELECT client, count(total) AS n_invoices, coalesce(sum(total), 0) AS total_amount,
         count(*) FILTER (is_paid = 0) AS n_unpaid,
         {r("count(*) FILTER (is_paid = 0) / count(total) * 100", 1)} AS pct_unpaid
  FROM inv GROUP BY client
)"""

COLLECTION = f"""{INV},
per_client AS (
  SELECT client, sum(total) AS invoiced, coalesce(sum(total) FILTER (is_paid = 1), 0) AS collected
  FROM inv GROUP BY client
),
collection AS (
  SELECT client, {r("invoiced")} AS invoiced, {r("collected")} AS collected,
         {r("invoiced - collected")} AS pending,
         {r("coalesce(collected / invoiced * 100, 0)", 6)} AS pct_collected
  FROM per_client
)"""

COMPACT = """CASE WHEN {0} >= 1000000 THEN '$' || format('{{:.1f}}', {0} / 1000000) || 'M'
  ELSE '$' || format('{{:.0f}}', {0} / 1000) || 'k' END"""
MONTHS = "[" + ", ".join(f"'{m}'" for m in K.MONTH_NAMES) + "]"


def with_(prefix: str, select: str) -> str:
    return f"WITH {prefix.strip()}\n{select}"


def histogram(prefix: str, source: str, column: str, bins: int) -> str:
    return with_(prefix, f"""
, vals AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source}),
lim AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS step FROM vals),
spine AS (
  SELECT CAST(i AS INTEGER) AS bin, lo + i * step AS low,
         CASE WHEN i + 1 = {bins} THEN hi ELSE lo + (i + 1) * step END AS high, hi
  FROM range({bins}) t(i), lim
)
SELECT bin, {r("low")} AS low, {r("high")} AS high, count(v) AS n
FROM spine LEFT JOIN vals ON v >= low AND (v < high OR (bin = {bins} - 1 AND v <= hi))
GROUP BY bin, low, high""")


MONTHLY = """
monthly AS (
  SELECT {key} AS series_key, CAST(date_trunc('month', paid_date) AS DATE) AS month,
         sum(total) AS amount
  FROM {source} WHERE paid_date IS NOT NULL AND total IS NOT NULL GROUP BY ALL
)"""

FILL = """
ends AS (SELECT series_key, min(month) AS lo, max(month) AS hi FROM {src} GROUP BY series_key),
spine AS (
  SELECT series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM ends
),
filled AS (
  SELECT spine.series_key, spine.month, coalesce(m.amount, 0) AS amount
  FROM spine LEFT JOIN {src} m ON m.series_key = spine.series_key AND m.month = spine.month
)"""

WINDOW = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY month DESC) AS back FROM filled
),
kept AS (
  SELECT series_key, month, amount, count(*) OVER (PARTITION BY series_key) AS n,
         count(*) OVER (PARTITION BY series_key) - back AS i
  FROM ranked WHERE back <= 6
),
stats AS (
  SELECT series_key, count(*) AS n_months,
         sum(exp(CASE WHEN n > 1 THEN i / (n - 1) ELSE 0 END) * amount)
           / sum(exp(CASE WHEN n > 1 THEN i / (n - 1) ELSE 0 END)) AS weighted_mean,
         CASE WHEN count(*) > 1 THEN regr_slope(amount, i) ELSE 0 END AS slope,
         CASE WHEN count(*) > 1 THEN stddev_samp(amount) END AS deviation
  FROM kept GROUP BY series_key
)"""

PROJECT = """
last_month AS (SELECT series_key, max(month) AS last_month FROM monthly GROUP BY series_key),
proj AS (
  SELECT series_key, CAST(h AS INTEGER) AS h,
         CAST(last_month + to_months(CAST(h AS INTEGER)) AS DATE) AS month,
         greatest(weighted_mean + slope * h, 0) AS amount,
         1.5 * coalesce(deviation, weighted_mean * 0.2) AS spread
  FROM stats JOIN last_month USING (series_key), range(1, 4) t(h)
)"""


def series(prefix: str, source: str, key: str) -> str:
    return (
        f"{prefix}, {MONTHLY.format(key=key, source=source)},"
        f" hist AS (SELECT * FROM monthly WHERE month <= {AS_OF}),"
        f" {FILL.format(src='hist')}, {WINDOW}, {PROJECT}"
    )


PROJECTED = f"""series_key, h, month, {r("amount")} AS amount,
  {r("greatest(amount - spread, 0)")} AS low, {r("amount + spread")} AS high"""

#: a fold over the months of each client and candidate; CTEs from ``cents`` to ``fitted``
FOLDED = f"""{INV}, {MONTHLY.format(key="client", source="inv")},
cents AS (SELECT series_key, month, {r("amount")} AS amount FROM monthly), {FILL.format(src="cents")},
points AS (
  SELECT series_key, amount AS y, row_number() OVER (PARTITION BY series_key ORDER BY month) AS t FROM filled
),
lengths AS (SELECT series_key, count(*) AS n, max(month) AS last_month FROM filled GROUP BY series_key),
grid AS (
  SELECT alpha, beta, phi FROM
    (SELECT unnest([0.02, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9]::DOUBLE[]) AS alpha),
    (SELECT unnest([0.01, 0.1, 0.3]::DOUBLE[]) AS beta), (SELECT unnest([0.8, 0.98]::DOUBLE[]) AS phi)
),
fold(series_key, alpha, beta, phi, t, fa, ga, fu, gu, fv, gv, aa, au, av, uu, uv, vv) AS (
  SELECT series_key, alpha, beta, phi, 0::BIGINT, 0::DOUBLE, 0::DOUBLE, 1::DOUBLE, 0::DOUBLE, phi, phi,
         0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE
  FROM lengths, grid WHERE n >= 3
  UNION ALL
  SELECT series_key, alpha, beta, phi, t, fa + alpha * e + ga2, ga2, fu - alpha * fu + gu2, gu2,
         fv - alpha * fv + gv2, gv2, aa + e * e, au + e * fu, av + e * fv, uu + fu * fu, uv + fu * fv, vv + fv * fv
  FROM (
    SELECT f.* EXCLUDE (t), p.t, y - fa AS e, phi * (ga + alpha * beta * (y - fa)) AS ga2,
           phi * (gu - alpha * beta * fu) AS gu2, phi * (gv - alpha * beta * fv) AS gv2
    FROM fold f JOIN points p ON p.series_key = f.series_key AND p.t = f.t + 1
  )
),
solved AS (
  SELECT *, uu * vv - uv * uv > 1e-12::DOUBLE * uu * vv AS two,
         CASE WHEN two THEN (au * vv - av * uv) / (uu * vv - uv * uv) ELSE au / uu END AS l,
         CASE WHEN two THEN (av * uu - au * uv) / (uu * vv - uv * uv) ELSE 0 END AS b
  FROM fold JOIN lengths USING (series_key) WHERE t = n
),
fitted AS (
  SELECT series_key, last_month, n, alpha, beta, phi, greatest(aa - l * au - b * av, 0) AS sse,
         fa + l * fu + b * fv - (ga + l * gu + b * gv) AS level, (ga + l * gu + b * gv) / phi AS trend,
         row_number() OVER (PARTITION BY series_key ORDER BY sse, alpha, beta, phi) AS place
  FROM solved
)"""

PENDING = f"""{INV},
pending AS (
  SELECT invoice_id, client, invoice_date, concept, total,
         row_number() OVER (ORDER BY invoice_date DESC, invoice_id) AS position,
         count(*) OVER () AS n_rows
  FROM inv WHERE is_paid = 0
)"""


def page(number: str, numbered: bool = True) -> str:
    prefix = PENDING
    if not numbered:
        prefix = PENDING.replace("SELECT invoice_id, client", "SELECT number AS invoice_id, client").replace(
            "invoice_date DESC, invoice_id)", "invoice_date DESC, number NULLS LAST, client, concept, total)"
        ).replace("FROM inv WHERE", "FROM (SELECT *, CASE WHEN invoice_id % 3 > 0 THEN invoice_id END AS number FROM inv) WHERE")
    return with_(prefix, f"""
, paged AS (
  SELECT *, CAST(greatest(ceil(n_rows / 15), 1) AS INTEGER) AS n_pages FROM pending
),
chosen AS (SELECT *, CAST(least({number}, n_pages - 1) AS INTEGER) AS page FROM paged)
SELECT position, page, n_pages, n_rows, invoice_id, client, invoice_date, concept, total
FROM chosen WHERE position > page * 15 AND position <= (page + 1) * 15""")


NORMAL = """trim(regexp_replace(strip_accents(upper(replace({0}, 'ß', 'ss'))), '[^A-Z0-9]+', ' ', 'g'))"""

TERMS = f"""
tok AS (
  SELECT doc_id, regexp_extract_all({NORMAL.format("text")}, '[A-Z0-9]+') AS t FROM documents
),
occ AS (
  SELECT doc_id, unnest(t) AS term FROM tok
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM tok
),
terms AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY doc_id, term)"""


def term_rows(name: str, source: str, key: str) -> str:
    """``name(key, term, tf)``: tokens and pairs of the normalised texts in ``source(key, text)``."""
    return f"""
{name}_tok AS (SELECT {key}, regexp_extract_all(text, '[A-Z0-9]+') AS t FROM {source}),
{name}_occ AS (
  SELECT {key}, unnest(t) AS term FROM {name}_tok
  UNION ALL
  SELECT {key}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM {name}_tok
),
{name} AS (SELECT {key}, term, count(*) AS tf FROM {name}_occ GROUP BY {key}, term)"""


#: predictions of the closed-form classifier for every invoice
COUNTED = f"""{INV},
lab AS (SELECT DISTINCT {CONCEPT} AS concept FROM part),
cat AS (SELECT *, CASE {_hits} ELSE 'otro' END AS label FROM lab),
train AS (SELECT concept AS key, {NORMAL.format("concept")} AS text, label FROM cat WHERE label <> 'otro'),
{term_rows("own", "train", "key")},
cls AS (SELECT label, count(*) AS n_c, ln(count(*) / (SELECT count(*) FROM train)) AS prior FROM train GROUP BY label),
vocab AS (SELECT term, ln((1 + (SELECT count(*) FROM train)) / (1 + count(*))) + 1 AS idf FROM own GROUP BY term),
tc AS (SELECT term, label, sum(tf) AS n FROM own JOIN train USING (key) GROUP BY term, label),
tot AS (SELECT label, sum(n) AS total FROM tc GROUP BY label),
coef AS (
  SELECT term, idf, label, ln((coalesce(n, 0) + 1) / (total + (SELECT count(*) FROM vocab))) AS c
  FROM vocab CROSS JOIN cls LEFT JOIN tc USING (term, label) JOIN tot USING (label)
),
texts AS (SELECT DISTINCT {NORMAL.format("coalesce(concept, 'None')")} AS text FROM inv),
{term_rows("said", "texts", "text")},
sums AS (
  SELECT text, label, sum((1 + ln(tf)) * idf * c) / sqrt(sum((1 + ln(tf)) * idf * (1 + ln(tf)) * idf)) AS m
  FROM said JOIN coef USING (term) GROUP BY text, label
),
margins AS (SELECT text, label, coalesce(m, 0) + prior AS m FROM texts CROSS JOIN cls LEFT JOIN sums USING (text, label)),
exps AS (SELECT text, label, exp(m - max(m) OVER (PARTITION BY text)) AS e FROM margins),
probs AS (SELECT text, label, e / sum(e) OVER (PARTITION BY text) AS p FROM exps),
best AS (SELECT * FROM probs QUALIFY row_number() OVER (PARTITION BY text ORDER BY p DESC, label) = 1),
predicted AS (
  SELECT invoice_id, client, invoice_date, concept, total, is_paid, label AS best,
         CASE WHEN p >= 0.4 THEN label ELSE 'otro' END AS predicted, {r("p", 4)} AS confidence
  FROM inv JOIN best ON {NORMAL.format("coalesce(concept, 'None')")} = text
)"""


def ranked(table: str, key: str, label: str) -> str:
    return (
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} "
        f"ORDER BY md5('42/' || CAST({key} AS VARCHAR)), {key}) - 1 AS class_rank, "
        f"count(*) OVER (PARTITION BY {label}) AS class_size FROM {table})"
    )


ORACLES: dict[str, str] = {
    "invoice_export": with_(RAW, "SELECT folio, cliente, fecha, fecha_de_pago, concepto, total FROM raw"),
    "clean_invoices": with_(INV, "SELECT * FROM inv"),
    "clean_invoices_from_csv": with_(INV, "SELECT * FROM inv"),
    "date_parsing_modes": with_(RAW, """
SELECT CAST(folio AS BIGINT) AS invoice_id,
  CAST(coalesce(try_strptime(fecha, '%d/%m/%Y'), try_strptime(fecha, '%Y-%m-%d %H:%M:%S')) AS DATE) AS lenient,
  CAST(try_strptime(fecha, '%d/%m/%Y') AS DATE) AS strict
FROM raw"""),
    "invoices_for_scoring": with_(INV, """
SELECT client, invoice_date, paid_date, total, days_to_pay, is_paid FROM inv
WHERE client IS NOT NULL AND total IS NOT NULL"""),
    "payments_for_cash_series": with_(INV, """
SELECT paid_date, total FROM inv WHERE paid_date IS NOT NULL AND total IS NOT NULL"""),
    "invoices_for_classifier": with_(INV, """
SELECT invoice_id, client, invoice_date, concept, total, is_paid FROM inv"""),
    "invoices_with_total": with_(INV, "SELECT * FROM inv WHERE total IS NOT NULL"),
    "ledger_balances": with_(LEDGER, "SELECT * FROM ledger"),
    "open_quotes": with_(QUOTES, "SELECT * FROM quotes"),
    "widened_invoices": with_(INV, """
SELECT invoice_id, client, CAST(invoice_date AS TIMESTAMP) AS invoice_date, concept, total,
  CAST(paid_date AS TIMESTAMP) AS paid_date, CAST(days_to_pay AS DOUBLE) AS days_to_pay, is_paid
FROM inv"""),
    "conformed_invoices": with_(INV, "SELECT * FROM inv"),
    "normalized_documents": f"SELECT doc_id, {NORMAL.format('text')} AS normalized FROM documents",
    "invoice_categories": with_(CAT, f"""
SELECT invoice_id, category, {case("category", K.CATEGORY_NAMES)} AS category_name FROM cat"""),
    "documents_by_rule_table": f"""
SELECT doc_id, coalesce(CAST(min(item_id) FILTER (contains(upper(d.text), b.keyword)) AS VARCHAR), '{K.OTHER}') AS category
FROM (SELECT doc_id, coalesce(text, 'nan') AS text FROM documents) d
LEFT JOIN (SELECT item_id, upper(left(text, 24)) AS keyword FROM benchmark) b ON contains(upper(d.text), b.keyword)
GROUP BY doc_id""",
    "report_formats": with_(INV, f"""
SELECT invoice_id, strftime(invoice_date, '%d/%m/%Y') AS day,
  strftime(invoice_date, '%Y-%m') AS year_month,
  ({MONTHS})[month(invoice_date)] || ' ' || CAST(year(invoice_date) AS VARCHAR) AS month_name,
  '$' || format('{{:,.2f}}', total) AS money, {COMPACT.format("(total * 5)")} AS compact,
  CASE WHEN length(concept) > 30 THEN left(concept, 30) || '…' ELSE concept END AS short_marked,
  left(concept, 22) AS short_plain,
  format('{{:.1f}}', total / 1000000 * 100) || '%' AS pct
FROM inv"""),
    "rounding": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  {r("l_quantity / 8", 1)} AS one, {r("l_quantity / 8", 2)} AS two,
  {r("l_extendedprice / 1024", 4)} AS four
FROM lineitem""",
    "guarded_math": with_(INV, f"""
SELECT invoice_id, {r("ln(1 + total)", 6)} AS log_total, {r("exp(is_paid * 0.5::DOUBLE)", 6)} AS exp_paid,
  {r("greatest(total - 200000, 0)", 6)} AS above,
  CASE WHEN is_paid <> 0 THEN {r("total / is_paid", 6)} END AS guarded_ratio,
  CASE WHEN days_to_pay <> 0 THEN {r("total / days_to_pay", 6)} END AS per_day
FROM inv"""),
    "business_filters": with_(CAT, f"""
SELECT invoice_id, category, days_to_pay,
  CAST(date_trunc('month', paid_date) AS DATE) <= {AS_OF} AS up_to_today
FROM cat WHERE is_paid = 1 AND days_to_pay > 0
  AND category IN ('instalacion_nueva', 'venta_refaccion')"""),
    "client_features": with_(FEATURES, f"""
SELECT client, n_invoices, {r("total_amount")} AS total_amount, n_unpaid,
  {r("avg_days_to_pay", 6)} AS avg_days_to_pay, {r("pct_unpaid", 6)} AS pct_unpaid FROM feat"""),
    "client_scores": with_(SCORES, f"SELECT {SCORE_COLUMNS}, computed_on FROM scores"),
    "top_clients_by_value": with_(SCORES, f"""
SELECT CAST(row_number() OVER (ORDER BY value_score DESC, client) AS INTEGER) AS rank, {SCORE_COLUMNS}
FROM scores ORDER BY value_score DESC, client LIMIT 10"""),
    "score_table": with_(SCORES, """
SELECT client, pay_score, value_score, risk_score,
  CASE WHEN pay_score >= 70 THEN 'green' WHEN pay_score >= 40 THEN 'orange' ELSE 'red' END AS pay_band,
  CASE WHEN value_score >= 70 THEN 'green' WHEN value_score >= 40 THEN 'orange' ELSE 'red' END AS value_band,
  CASE WHEN risk_score > 70 THEN 'ALTO' WHEN risk_score >= 40 THEN 'MEDIO' ELSE 'BAJO' END AS risk_band,
  pct_unpaid > 0.20 AS unpaid_alert
FROM scores"""),
    "payment_day_range": with_(FEATURES, f"""
SELECT {r("min(avg_days_to_pay)", 6)} AS min_days, {r("quantile_cont(avg_days_to_pay, 0.5)", 6)} AS median_days,
  {r("max(avg_days_to_pay)", 6)} AS max_days FROM feat"""),
    "client_selector": with_(INV, "SELECT DISTINCT client FROM inv WHERE client IS NOT NULL"),
    "invoice_load_problems": """
WITH batch AS (
  SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS invoice_id,
         CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS invoice_date,
         CASE WHEN l_linestatus <> 'F' THEN 'x' END AS client FROM lineitem
),
facts AS (
  SELECT count(*) AS n, count(*) FILTER (invoice_date IS NULL) AS n_null,
         count(*) FILTER (invoice_id IS NULL) AS no_id, count(*) FILTER (client IS NULL) AS no_client FROM batch
),
reps AS (
  SELECT count(*) AS n_repeated FROM (
    SELECT invoice_id FROM batch WHERE invoice_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
)
SELECT 'volume' AS rule, 'error' AS severity, n || ' rows against 1000000000 now' AS detail, n AS n_rows
FROM facts WHERE n < 900000000
UNION ALL SELECT 'repeated_key', 'error', n_repeated || ' repeated invoice_id values', n_repeated
FROM reps WHERE n_repeated > 0
UNION ALL SELECT 'null_invoice_date', 'error', n_null || ' rows without invoice_date', n_null
FROM facts WHERE n_null > 0
UNION ALL SELECT 'null_invoice_id', 'error', no_id || ' rows without invoice_id', no_id FROM facts WHERE no_id > 0
UNION ALL SELECT 'null_client', 'error', no_client || ' rows without client', no_client
FROM facts WHERE no_client > 0""",
    "clean_load_problems": with_(INV, """
SELECT 'null_total' AS rule, 'error' AS severity, count(*) || ' rows without total' AS detail, count(*) AS n_rows
FROM inv WHERE invoice_id % 10 = 0 HAVING count(*) > 0"""),
    "contract_refusals": with_(INV, """
SELECT unnest(['invoice_id', 'client', 'invoice_date', 'total']) AS column_name, CAST(1 AS INTEGER) AS n_problems,
  (SELECT count(*) FROM inv) AS n_rows"""),
    "repeats_of_a_refusal": with_(INV, "SELECT invoice_id, CAST(2 AS BIGINT) AS n FROM inv WHERE invoice_id % 7 = 0"),
    "invoices_from_shuffled_csv": with_(INV, "SELECT * FROM inv"),
    "date_spellings": """
SELECT o_orderkey AS order_key, o_orderkey % 12 AS kind,
  CASE WHEN o_orderkey % 12 = 11 THEN NULL ELSE d END AS lenient,
  CASE WHEN o_orderkey % 12 IN (5, 6, 8, 10, 11) THEN NULL ELSE d END AS strict
FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 12 = 4 AND year(o_orderdate) < 2000
                              THEN o_orderdate + INTERVAL 100 YEAR ELSE o_orderdate END AS DATE) AS d FROM orders)""",
    "dropped_invoices": with_(INV, """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN cliente IS NULL THEN 'no client'
              WHEN fecha = 'no date' THEN 'unreadable invoice date'
              WHEN CAST(folio AS BIGINT) % 31 = 0 THEN 'unreadable payment date' END AS reason FROM raw)
WHERE reason IS NOT NULL GROUP BY reason"""),
    "scanned_labels": "SELECT p_name AS concepto, p_brand AS etiqueta_auto, p_type AS categoria_modelo FROM part",
    "invoices_with_line_breaks": with_(INV, """
SELECT * REPLACE (CASE WHEN invoice_id % 3 = 0
  THEN 'uno' || chr(10) || '"dos", ' || coalesce(concept, '') || chr(10) || chr(10) || 'tres' ELSE concept END AS concept) FROM inv"""),
    "sheet_with_line_breaks": f"""WITH {LEDGER}
SELECT factura, oc || chr(10) || 'lote "B"' AS oc, {r('curtrxam')} AS curtrxam, orctrxam1, fecha_calculo FROM ledger""",
    "scanned_sheet": f"WITH {LEDGER} SELECT factura, oc, {r('curtrxam')} AS curtrxam, orctrxam1, fecha_calculo FROM ledger",
    "copied_tables": """
SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'ok' AS status FROM customer
UNION ALL SELECT 'supplier', count(*), count(*), 'ok' FROM supplier""",
    "score_load_problems": """
WITH batch AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS client FROM orders
),
facts AS (SELECT count(*) FILTER (client IS NULL) AS n_null FROM batch),
reps AS (
  SELECT count(*) AS n_repeated FROM (
    SELECT client FROM batch WHERE client IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
)
SELECT 'repeated_key' AS rule, 'error' AS severity, n_repeated || ' repeated client values' AS detail,
  n_repeated AS n_rows FROM reps WHERE n_repeated > 0
UNION ALL SELECT 'null_client', 'error', n_null || ' rows without client', n_null
FROM facts WHERE n_null > 0""",
    "repeated_invoice_keys": """
SELECT l_orderkey AS invoice_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "constraint_obstacles": """
WITH rep AS (
  SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1
  ORDER BY n DESC, l_orderkey LIMIT 10
)
SELECT 'repeated_key' AS kind, CAST(l_orderkey AS VARCHAR) AS item, n FROM rep
UNION ALL SELECT 'null', 'client', count(*) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'null', 'total', count(*) FROM lineitem WHERE l_linestatus <> 'F'""",
    "invoice_null_profile": with_(INV, ", facts AS (SELECT count(*) AS n, " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}" for c in K.INVOICES.fieldNames()
    ) + " FROM inv)\n" + "\nUNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, n AS n_rows, "
        f"{f.name} AS n_null, {r(f.name + ' / n * 100', 1)} AS pct_null FROM facts"
        for f in K.INVOICES.fields
    )),
    "table_reconciliation": """
WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders),
o2 AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P'),
p AS (SELECT count(*) AS n FROM part), s AS (SELECT count(*) AS n FROM supplier),
na AS (SELECT count(*) AS n FROM nation)
SELECT 'customer' AS table_name, n AS source_rows, n AS target_rows, 'ok' AS status FROM c
UNION ALL SELECT 'orders', o.n, o2.n, 'row count differs' FROM o, o2
UNION ALL SELECT 'part', n, n, 'content differs' FROM p
UNION ALL SELECT 'supplier', n, NULL, 'missing in target' FROM s
UNION ALL SELECT 'nation', NULL, n, 'missing in source' FROM na""",
    "changed_order_keys": """
SELECT o_orderkey, source_rows, target_rows,
  CASE WHEN target_rows = 0 THEN 'missing in target' WHEN source_rows = 0 THEN 'missing in source'
       WHEN target_rows > source_rows THEN 'row count differs' ELSE 'content differs' END AS status
FROM (
  SELECT o_orderkey, 1::BIGINT AS source_rows,
    CASE WHEN o_orderkey % 1013 = 0 THEN 0 WHEN o_orderkey % 2003 = 0 THEN 2 ELSE 1 END::BIGINT AS target_rows,
    o_orderkey % 997 = 0 AND o_orderstatus IS NOT NULL AS edited
  FROM orders
  UNION ALL SELECT -o_orderkey, 0, 1, false FROM orders WHERE o_orderkey % 1511 = 0 AND o_orderkey > 0
) WHERE edited OR source_rows <> target_rows""",
    "guarded_load": with_(INV, f"""
SELECT count(*) AS n_rows, {r("sum(total + 1)")} AS total, CAST(sum(is_paid) AS BIGINT) AS n_paid,
  CAST(1 AS INTEGER) AS n_refusals FROM inv"""),
    "portfolio_kpis": with_(INV, f"""
SELECT count(*) AS n_invoices, count(*) FILTER (is_paid = 1) AS n_paid,
  count(*) FILTER (is_paid = 0) AS n_pending, {r("sum(total)")} AS invoiced,
  {r("sum(total) FILTER (is_paid = 1)")} AS collected, {r("sum(total) FILTER (is_paid = 0)")} AS pending,
  {r("avg(days_to_pay) FILTER (is_paid = 1)", 6)} AS avg_days_to_pay,
  min(invoice_date) AS first_date, max(invoice_date) AS last_date, count(DISTINCT client) AS n_clients,
  {r("sum(total) FILTER (is_paid = 1) / sum(total) * 100", 6)} AS pct_collected,
  {r("count(*) FILTER (is_paid = 1) / count(*) * 100", 6)} AS pct_paid,
  {r("count(*) FILTER (is_paid = 0) / count(*) * 100", 6)} AS pct_pending
FROM inv"""),
    "client_collection": with_(COLLECTION, "SELECT * FROM collection"),
    "aligned_client_totals": with_(COLLECTION, "SELECT client, invoiced, collected FROM collection"),
    "client_summary": with_(SUMMARY, f"""
SELECT client, n_invoices, {r("total_amount")} AS total_amount, n_unpaid, pct_unpaid,
  pct_unpaid > 30 AS unpaid_alert FROM summary"""),
    "top_clients_by_amount": with_(COLLECTION, f"""
SELECT *, {COMPACT.format("invoiced")} AS label FROM collection ORDER BY invoiced DESC, client LIMIT 10"""),
    "top_clients_by_count": with_(SUMMARY, f"""
SELECT client, n_invoices, {r("total_amount")} AS total_amount, n_unpaid, pct_unpaid
FROM summary ORDER BY n_invoices DESC, client LIMIT 10"""),
    "risk_map": with_(SUMMARY, f"""
, med AS (SELECT quantile_cont(total_amount, 0.5) AS ma, quantile_cont(pct_unpaid, 0.5) AS mp FROM summary)
SELECT client, n_invoices, {r("total_amount")} AS total_amount, n_unpaid, pct_unpaid,
  {r("ma")} AS median_amount, {r("mp")} AS median_pct_unpaid,
  CASE WHEN total_amount > ma AND pct_unpaid > mp THEN 'high value, high risk'
       WHEN total_amount > ma THEN 'high value, low risk'
       WHEN pct_unpaid > mp THEN 'low value, high risk' ELSE 'low value, low risk' END AS quadrant
FROM summary, med"""),
    "median_days_per_client": with_(INV, f"""
, m AS (SELECT client, quantile_cont(days_to_pay, 0.5) AS md FROM inv
        WHERE is_paid = 1 AND days_to_pay > 0 GROUP BY client)
SELECT client, {r("md")} AS median_days,
  CASE WHEN md <= 30 THEN '<=30' WHEN md <= 60 THEN '31-60' ELSE '>60' END AS speed FROM m"""),
    "days_centre": with_(INV, f"""
SELECT {r("avg(days_to_pay)", 6)} AS mean, {r("quantile_cont(days_to_pay, 0.5)", 6)} AS median
FROM inv WHERE is_paid = 1 AND days_to_pay > 0"""),
    "total_centre": with_(INV, f"""
SELECT {r("avg(total)")} AS mean, {r("quantile_cont(total, 0.5)")} AS median FROM inv"""),
    "balance_centre": with_(LEDGER, f"""
SELECT {r("avg(curtrxam)")} AS mean, {r("quantile_cont(curtrxam, 0.5)")} AS median FROM ledger"""),
    "total_description": with_(INV, f"""
SELECT count(total) AS count, {r("avg(total)")} AS mean, {r("stddev_samp(total)")} AS std,
  {r("min(total)")} AS min, {r("quantile_cont(total, 0.25)")} AS p25,
  {r("quantile_cont(total, 0.5)")} AS p50, {r("quantile_cont(total, 0.75)")} AS p75,
  {r("max(total)")} AS max FROM inv"""),
    "payment_speed": with_(INV, f"""
, b AS (SELECT CASE WHEN days_to_pay <= 30 THEN '<=30' WHEN days_to_pay <= 60 THEN '31-60' ELSE '>60' END AS speed
        FROM inv WHERE is_paid = 1 AND days_to_pay > 0)
SELECT speed, count(*) AS n, {r("count(*) / sum(count(*)) OVER () * 100", 6)} AS pct FROM b GROUP BY speed"""),
    "total_histogram": histogram(INV, "inv WHERE total IS NOT NULL", "total", 45),
    "days_histogram": histogram(INV, "inv WHERE is_paid = 1 AND days_to_pay > 0", "days_to_pay", 35),
    "balance_histogram": histogram(LEDGER, "ledger WHERE curtrxam IS NOT NULL", "curtrxam", 30),
    "total_box_plot": with_(INV, f"""
, q AS (SELECT is_paid, quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.5) AS q2,
               quantile_cont(total, 0.75) AS q3 FROM inv GROUP BY is_paid),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT is_paid, {r("q1")} AS q1, {r("q2")} AS median, {r("q3")} AS q3, count(*) AS n,
  {r("least(min(total) FILTER (total BETWEEN lo AND hi), q1)")} AS low_whisker,
  {r("greatest(max(total) FILTER (total BETWEEN lo AND hi), q3)")} AS high_whisker,
  count(*) FILTER (NOT total BETWEEN lo AND hi) AS n_outliers
FROM inv JOIN f USING (is_paid) GROUP BY is_paid, q1, q2, q3"""),
    "line_box_plot_outliers": f"""
WITH t AS (
  SELECT l_orderkey * 10 + l_linenumber AS invoice_id,
         CAST(l_linestatus = 'F' AS INTEGER) AS is_paid, exp(l_extendedprice / 15000) AS total
  FROM lineitem
),
q AS (SELECT is_paid, quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.75) AS q3 FROM t GROUP BY 1)
SELECT invoice_id, is_paid, {r("total")} AS total FROM t JOIN q USING (is_paid)
WHERE NOT total BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
    "category_counts": with_(CAT, f"""
SELECT category, count(*) AS n, {r("count(*) / sum(count(*)) OVER ()", 6)} AS share FROM cat GROUP BY category"""),
    "collected_by_category": with_(CAT, f"""
SELECT category, {case("category", K.CATEGORY_SHORT_NAMES)} AS category_name,
  {r("sum(total)")} AS collected, count(total) AS n_invoices, {r("avg(total)")} AS avg_ticket
FROM cat WHERE is_paid = 1 GROUP BY category"""),
    "category_coverage": with_(CAT, f"""
SELECT count(*) FILTER (category <> 'otro') AS n_classified, count(*) AS n_rows,
  {r("count(*) FILTER (category <> 'otro') / count(*)", 6)} AS coverage FROM cat"""),
    "monthly_collected": with_(INV, f"""
SELECT CAST(date_trunc('month', paid_date) AS DATE) AS month, {r("sum(total)")} AS amount
FROM inv WHERE paid_date IS NOT NULL GROUP BY 1"""),
    "month_highlights": with_(INV, f"""
, m AS (SELECT CAST(date_trunc('month', paid_date) AS DATE) AS month, sum(total) AS amount
        FROM inv WHERE paid_date IS NOT NULL GROUP BY 1)
SELECT month, {r("amount")} AS amount, amount >= avg(amount) OVER () AS above_average,
  row_number() OVER (ORDER BY amount DESC, month) = 1 AS is_best,
  row_number() OVER (ORDER BY amount, month) = 1 AS is_worst FROM m"""),
    "receivables_kpis": with_(f"{LEDGER}, {QUOTES}", f"""
, l AS (SELECT sum(curtrxam) AS b, count(*) AS n, avg(curtrxam) AS a FROM ledger),
q AS (SELECT sum(importe) AS p FROM quotes)
SELECT {r("b")} AS open_balance, {r("p")} AS pipeline, {r("b + p")} AS exposure, n AS n_ledger,
  {r("a")} AS avg_balance FROM l, q"""),
    "financial_panorama": with_(f"{INV}, {LEDGER}, {QUOTES}", f"""
SELECT 1 AS position, 'invoiced' AS measure, {r("sum(total)")} AS value FROM inv
UNION ALL SELECT 2, 'collected', {r("sum(total) FILTER (is_paid = 1)")} FROM inv
UNION ALL SELECT 3, 'open_balance', {r("sum(curtrxam)")} FROM ledger
UNION ALL SELECT 4, 'pipeline', {r("sum(importe)")} FROM quotes"""),
    "pending_invoices": with_(INV, """
SELECT invoice_id, client, strftime(invoice_date, '%d/%m/%Y') AS invoice_date,
  CASE WHEN length(concept) > 55 THEN left(concept, 55) || '…' ELSE concept END AS concept,
  '$' || format('{:,.2f}', total) AS total,
  '$' || format('{:,.2f}', (SELECT sum(total) FROM inv WHERE is_paid = 0)) AS grand_total
FROM inv WHERE is_paid = 0"""),
    "pending_total": with_(INV, f"""
SELECT count(*) AS n_pending, {r("sum(total)")} AS pending_total FROM inv WHERE is_paid = 0"""),
    "pending_page": page("3"),
    "last_pending_page": page("1000000000"),
    "pending_page_without_numbers": page("3", numbered=False),
    "filled_months": with_(
        f"{INV}, {MONTHLY.format(key='client', source='inv')}, {FILL.format(src='monthly')}",
        f"SELECT series_key, month, {r('amount')} AS amount FROM filled",
    ),
    "recent_window_per_client": with_(series(INV, "inv", "client"), f"""
SELECT series_key, n_months, {r("weighted_mean")} AS weighted_mean, {r("slope", 4)} AS slope,
  {r("deviation")} AS deviation FROM stats"""),
    "cash_projection": with_(series(INV, "inv", "'all'"), f"""
SELECT {PROJECTED}, ({MONTHS})[month(month)] || ' ' || CAST(year(month) AS VARCHAR) AS label FROM proj"""),
    "cash_projection_by_category": with_(series(CAT, "cat", "category"), f"SELECT {PROJECTED} FROM proj"),
    "cash_projection_by_client": with_(series(INV, "inv", "client"), f"SELECT {PROJECTED} FROM proj"),
    "cash_projection_total": with_(series(INV, "inv", "client"), f"""
SELECT series_key, {r("sum(amount)")} AS expected_total FROM proj GROUP BY series_key"""),
    "cash_forecast_short_clients": with_(
        f"{INV}, {MONTHLY.format(key='client', source='inv')}, {FILL.format(src='monthly')}, {WINDOW}, {PROJECT}",
        f"""
SELECT series_key, h, strftime(month, '%Y-%m') AS month, {r("amount")} AS expected,
  {r("greatest(amount - spread, 0)")} AS p10, {r("amount + spread")} AS p90, 'weighted mean' AS method
FROM proj WHERE series_key IN (SELECT series_key FROM stats WHERE n_months < 3)"""),
    "folded_fits": f"""WITH RECURSIVE {FOLDED.strip()}
SELECT series_key, last_month, CAST(n AS INTEGER) AS n_months, alpha, beta, phi, {r("level")} AS level,
  {r("trend")} AS trend, {r("sse", 0)} AS sse,
  {r("CASE WHEN sse > 0 THEN n * ln(sse / n) + 10 END", 4)} AS aic
FROM fitted WHERE place = 1""",
    "folded_forecast": f"""WITH RECURSIVE {FOLDED.strip()}, {WINDOW}, {PROJECT},
ahead AS (
  SELECT *, CASE h WHEN 1 THEN phi WHEN 2 THEN phi + phi * phi ELSE phi + phi * phi + phi * phi * phi END AS damp,
    CASE h WHEN 1 THEN 1 WHEN 2 THEN sqrt(1 + power(alpha * (1 + beta * phi), 2))
      ELSE sqrt(1 + power(alpha * (1 + beta * phi), 2) + power(alpha * (1 + beta * (phi + phi * phi)), 2)) END
      * 1.2815515655446004 * sqrt(sse / n) AS band
  FROM fitted, range(1, 4) t(h) WHERE place = 1
)
SELECT series_key, CAST(h AS INTEGER) AS h, strftime(last_month + to_months(CAST(h AS INTEGER)), '%Y-%m') AS month,
  {r("greatest(level + damp * trend, 0)")} AS expected, {r("greatest(level + damp * trend - band, 0)")} AS p10,
  {r("greatest(level + damp * trend + band, 0)")} AS p90, 'smoothing' AS method
FROM ahead
UNION ALL
SELECT series_key, h, strftime(month, '%Y-%m'), {r("amount")}, {r("greatest(amount - spread, 0)")},
  {r("amount + spread")}, 'weighted mean'
FROM proj WHERE series_key IN (SELECT series_key FROM stats WHERE n_months < 3)""",
    "forecast_clients": with_(
        f"{INV}, {MONTHLY.format(key='client', source='inv')}, {FILL.format(src='monthly')}", """
SELECT series_key, CASE WHEN count(*) < 3 THEN 'weighted mean' ELSE 'smoothing' END AS method,
  CAST(3 AS BIGINT) AS n_months FROM filled GROUP BY series_key"""),
    "forecast_bands": f"""
WITH c AS (SELECT c_name, 0.1 + (c_custkey % 7) / 10 AS a, 0.01 + (c_custkey % 5) / 10 AS b,
                  0.8 + (c_custkey % 4) / 20 AS p, c_acctbal + 2000 AS level, c_acctbal / 100 AS trend,
                  sqrt(abs(c_acctbal) * 50 / 40) AS sigma FROM customer),
e AS (SELECT *, h, CASE h WHEN 1 THEN p WHEN 2 THEN p + p * p ELSE p + p * p + p * p * p END AS damp,
        CASE h WHEN 1 THEN 1 WHEN 2 THEN sqrt(1 + power(a * (1 + b * p), 2))
          ELSE sqrt(1 + power(a * (1 + b * p), 2) + power(a * (1 + b * (p + p * p)), 2)) END AS growth
      FROM c, range(1, 4) t(h))
SELECT c_name AS series_key, CAST(h AS INTEGER) AS h, '1999-0' || h AS month,
  {r("greatest(level + damp * trend, 0)")} AS expected,
  {r("greatest(level + damp * trend - 1.2815515655446004 * sigma * growth, 0)")} AS p10,
  {r("greatest(level + damp * trend + 1.2815515655446004 * sigma * growth, 0)")} AS p90 FROM e""",
    "cash_outlook": with_(series(CAT, "cat", "category"), f"""
SELECT series_key, month, 'history' AS kind, {r("amount")} AS amount, NULL::DOUBLE AS low, NULL::DOUBLE AS high
FROM filled
UNION ALL SELECT series_key, month, 'programmed', {r("amount")}, NULL, NULL FROM monthly WHERE month > {AS_OF}
UNION ALL SELECT series_key, month, 'projected', {r("amount")}, {r("greatest(amount - spread, 0)")},
  {r("amount + spread")} FROM proj"""),
    "document_terms": with_(TERMS, "SELECT doc_id, term, tf FROM terms"),
    "term_weights": with_(TERMS, f"""
, dfs AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
w AS (
  SELECT doc_id, term, tf,
         (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS raw
  FROM terms JOIN dfs USING (term)
)
SELECT doc_id, term, tf, {r("raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id))", 6)} AS weight FROM w"""),
    "language_folds": with_(ranked("documents", "doc_id", "lang"), """
SELECT doc_id, lang, CAST(class_rank % 5 AS INTEGER) AS fold FROM ranked"""),
    "language_holdout": with_(ranked("documents", "doc_id", "lang"), """
SELECT doc_id, lang, class_rank < round_even(class_size * 0.25::DOUBLE, 0) AS held_out FROM ranked"""),
    "label_agreement_report": f"""
WITH d AS (
  SELECT quality AS y, CAST(n_chars % 3 AS INTEGER) AS p FROM labels JOIN documents USING (doc_id)
),
c AS (SELECT DISTINCT y AS k FROM d UNION SELECT DISTINCT p FROM d),
m AS (
  SELECT k, (SELECT count(*) FROM d WHERE y = k) AS support, (SELECT count(*) FROM d WHERE p = k) AS predicted,
         (SELECT count(*) FROM d WHERE y = k AND p = k) AS hits FROM c
),
s AS (
  SELECT k, support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS pr,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS rc,
         CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f FROM m
)
SELECT CAST(k AS VARCHAR) AS class, {r("pr", 6)} AS precision, {r("rc", 6)} AS recall, {r("f", 6)} AS f1,
  support FROM s
UNION ALL SELECT 'accuracy', NULL, NULL, {r("sum(hits) / sum(support)", 6)}, CAST(sum(support) AS BIGINT) FROM s
UNION ALL SELECT 'macro avg', {r("avg(pr)", 6)}, {r("avg(rc)", 6)}, {r("avg(f)", 6)},
  CAST(sum(support) AS BIGINT) FROM s
UNION ALL SELECT 'weighted avg', {r("sum(pr * support) / sum(support)", 6)},
  {r("sum(rc * support) / sum(support)", 6)}, {r("sum(f * support) / sum(support)", 6)},
  CAST(sum(support) AS BIGINT) FROM s""",
    "label_agreement_by_fold": with_(ranked("labels", "doc_id", "quality"), f"""
, f AS (
  SELECT CAST(class_rank % 5 AS INTEGER) AS fold, count(*) AS n,
         avg(CASE WHEN quality = toxic THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a FROM ranked GROUP BY 1
)
SELECT fold, n, {r("a", 6)} AS accuracy, {r("avg(a) OVER ()", 6)} AS mean_accuracy,
  {r("stddev_pop(a) OVER ()", 6)} AS std_accuracy FROM f"""),
    "classified_by_counts": with_(COUNTED, "SELECT * FROM predicted"),
    "counted_prediction_summary": with_(COUNTED, f"""
SELECT predicted, count(*) AS n_invoices, {r("coalesce(sum(total), 0)")} AS amount, {r("avg(confidence)", 4)} AS avg_confidence
FROM predicted GROUP BY predicted"""),
    "counted_invoices_to_review": with_(COUNTED, """
SELECT invoice_id, predicted, confidence, left(concept, 52) AS concept, n AS n_doubtful, greatest(n - 8, 0) AS n_more
FROM (SELECT *, count(*) OVER () AS n FROM predicted WHERE confidence < 0.6) ORDER BY confidence, invoice_id LIMIT 8"""),
    "concept_training_set": f"""
WITH inv AS (SELECT DISTINCT {CONCEPT} AS concept FROM part),
cat AS (SELECT *, CASE {_hits} ELSE 'otro' END AS label FROM inv)
SELECT {NORMAL.format("concept")} AS text, label FROM cat WHERE label <> 'otro'""",
}
