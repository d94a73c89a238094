"""Table contracts and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Table contracts
# --------------------------------------------------------------------------

#: Invoice export as it arrives: six text columns, headers may carry spaces.
RAW_INVOICES = T.StructType(
    [
        T.StructField("Folio", T.StringType()),
        T.StructField("Cliente", T.StringType()),
        T.StructField("Fecha", T.StringType()),
        T.StructField("Concepto", T.StringType()),
        T.StructField(" Total ", T.StringType()),
        T.StructField("FECHA DE PAGO", T.StringType()),
    ]
)

INVOICES = T.StructType(
    [
        T.StructField("invoice_id", T.LongType(), False),
        T.StructField("client", T.StringType(), False),
        T.StructField("invoice_date", T.DateType(), False),
        T.StructField("concept", T.StringType()),
        T.StructField("total", T.DoubleType(), False),
        T.StructField("paid_date", T.DateType()),
        T.StructField("days_to_pay", T.IntegerType()),
        T.StructField("is_paid", T.IntegerType(), False),
    ]
)

CLIENT_SCORES = T.StructType(
    [
        T.StructField("client", T.StringType(), False),
        T.StructField("n_invoices", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_days_to_pay", T.DoubleType()),
        T.StructField("pct_unpaid", T.DoubleType()),
        T.StructField("pay_score", T.DoubleType()),
        T.StructField("value_score", T.DoubleType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("computed_on", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("factura", T.StringType()),
        T.StructField("oc", T.StringType()),
        T.StructField("curtrxam", T.StringType()),
        T.StructField("orctrxam1", T.StringType()),
        T.StructField("fecha_calculo", T.StringType()),
    ]
)

QUOTES = T.StructType(
    [
        T.StructField("cot", T.StringType()),
        T.StructField("suc", T.StringType()),
        T.StructField("importe", T.StringType()),
        T.StructField("concepto", T.StringType()),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("concepto", T.StringType()),
        T.StructField("etiqueta_auto", T.StringType()),
        T.StructField("categoria_modelo", T.StringType()),
    ]
)

# --------------------------------------------------------------------------
# These must stay as they are for the results to be right.
# --------------------------------------------------------------------------

VOLUME_FLOOR = 0.9  # a new batch below this share of the current rows is suspect
LATE_QUANTILE = 0.95  # imputation of clients that never paid
UNPAID_WEIGHT = 0.6  # risk score
DELAY_WEIGHT = 0.4
RISK_HIGH = 70.0
RISK_MEDIUM = 40.0
UNPAID_ALERT = 0.20
UNPAID_ALERT_PCT = 30.0
FAST_DAYS = 30
SLOW_DAYS = 60
PAGE_SIZE = 15

OTHER = "otro"
CONFIDENCE_FLOOR = 0.40
REVIEW_BELOW = 0.60
REVIEW_ROWS = 8
INVERSE_REGULARISATION = 5.0
MAX_ITERATIONS = 1000
FOLDS = 5
HOLDOUT_SHARE = 0.25
SEED = 42

WINDOW_MONTHS = 6
BAND_SIGMAS = 1.5
SINGLE_POINT_BAND = 0.2
HORIZON = 3
SEASON = 12
SEASONAL_FROM = 24
PATHS = 1000
LOW_QUANTILE = 0.10
HIGH_QUANTILE = 0.90

AMOUNT_BINS = 45
DAYS_BINS = 35
BALANCE_BINS = 30

# Keyword rules, first match wins (fixed values).
KEYWORD_RULES = {
    "mantenimiento_preventivo": [
        "MANTENIMIENTO", "LIMPIEZA", "REVISION", "SERVICIO DE MANT",
        "PREVENTIVO", "TRIMESTRAL", "MENSUAL", "SEMESTRAL",
    ],
    "mantenimiento_correctivo": [
        "CORRECTIVO", "REPARACION", "FUGA", "FALLA", "DIAGNOSTICO",
        "COMPLEMENTO", "RECONSTRUIDO",
    ],
    "instalacion_nueva": [
        "INSTALACION", "INST.", "MINISPLIT", "SPLIT", "CHILLER",
        "EQUIPO NUEVO", "SUMINISTRO E INST",
    ],
    "venta_refaccion": [
        "COMPRESOR", "REFACCION", "PIEZA", "MOTOR", "VALVULA",
        "CONDENSADOR", "EVAPORADOR", "CAPACITOR", "GAS R",
    ],
}

# Category display names (fixed values).
CATEGORY_NAMES = {
    "mantenimiento_preventivo": "Mantenimiento Preventivo",
    "venta_refaccion": "Venta de Refacciones",
    "instalacion_nueva": "Instalación Nueva",
    "mantenimiento_correctivo": "Mantenimiento Correctivo",
    "otro": "Otro",
}

# Category names for the revenue chart (fixed values).
CATEGORY_SHORT_NAMES = {
    "mantenimiento_preventivo": "Mtto. Preventivo",
    "venta_refaccion": "Venta Refacciones",
    "instalacion_nueva": "Instalacion Nueva",
    "mantenimiento_correctivo": "Mtto. Correctivo",
    "otro": "Otro",
}

# Month names (fixed values).
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
