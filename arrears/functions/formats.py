"""Report formats.  ``format_number`` rounds half to even, as needed here."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from arrears import contracts as K


def day_month_year(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_name_year(c: Column) -> Column:
    names = F.array(*[F.lit(name) for name in K.MONTH_NAMES])
    return F.concat(F.element_at(names, F.month(c)), F.lit(" "), F.year(c).cast("string"))


def money(c: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, digits))


def _pattern(c: Column, pattern: str) -> Column:
    return F.call_function("format_number", c, F.lit(pattern))


def compact_money(c: Column) -> Column:
    millions = F.concat(F.lit("$"), _pattern(c / 1_000_000, "0.0"), F.lit("M"))
    thousands = F.concat(F.lit("$"), _pattern(c / 1_000, "0"), F.lit("k"))
    return F.when(c >= 1_000_000, millions).otherwise(thousands)


def percent(c: Column) -> Column:
    """A share such as 0.256 as ``25.6%``."""
    return F.concat(_pattern(c * 100, "0.0"), F.lit("%"))


def shorten(c: Column, length: int = 55, mark: str = "…") -> Column:
    return F.when(F.length(c) > length, F.concat(F.left(c, F.lit(length)), F.lit(mark))).otherwise(c)


def display_name(c: Column, names: dict[str, str] = K.CATEGORY_NAMES) -> Column:
    """Display name of a category; unknown categories show as they are."""
    shown = F.lit(None).cast("string")
    for key, name in names.items():
        shown = F.when(c == key, name).otherwise(shown)
    return F.coalesce(shown, c)
