"""Classification of scores, shares and days into bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from arrears import contracts as K


def risk_band(score: Column) -> Column:
    return (
        F.when(score > K.RISK_HIGH, "ALTO")
        .when(score >= K.RISK_MEDIUM, "MEDIO")
        .when(score.isNotNull(), "BAJO")
    )


def score_band(score: Column) -> Column:
    return (
        F.when(score >= K.RISK_HIGH, "green")
        .when(score >= K.RISK_MEDIUM, "orange")
        .when(score.isNotNull(), "red")
    )


def unpaid_alert(share: Column) -> Column:
    return share > K.UNPAID_ALERT


def unpaid_alert_pct(pct: Column) -> Column:
    return pct > K.UNPAID_ALERT_PCT


def speed_band(days: Column) -> Column:
    return (
        F.when(days <= K.FAST_DAYS, "<=30")
        .when(days <= K.SLOW_DAYS, "31-60")
        .when(days.isNotNull(), ">60")
    )
