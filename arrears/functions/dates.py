"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


#: a time of day that may follow a date, which it does not change
_TIME = r"(?:[ T]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?[AaPp]\.?[Mm]\.?)?(?:Z|[+-]\d{2}:?\d{2})?)?"
#: day, month and year of four or two digits between slashes, hyphens or dots
_DAY_FIRST = rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_TIME}$"
#: between the parts of a date that was recognised
_MARK = "\x1f"
#: year, month and day
_YEAR_FIRST = rf"^(\d{{4}})([/.-])(\d{{1,2}})\2(\d{{1,2}}){_TIME}$"


def mixed_date(c: Column, iso_text: bool = True) -> Column:
    """Day-first text to DATE; unreadable text becomes NULL.

    Read are, in this order and with blanks around them ignored: ``d/M/yyyy``,
    ``d/M/yy`` (2000 to 2099), both also with ``-`` or ``.``, and with
    ``iso_text=True`` ``yyyy-M-d``, also with ``/`` or ``.``.  A time of day
    may follow.  ``iso_text=False`` reads day-first text only, so ISO text is
    lost.  The rule looks at one row at a time, never at the rest of the
    column.
    """
    # each rule rewrites its text once, to day, month and year between marks that no spelling has
    text = F.regexp_replace(F.trim(c), _DAY_FIRST, f"$1{_MARK}$3{_MARK}$4")
    if iso_text:
        text = F.regexp_replace(text, _YEAR_FIRST, f"$4{_MARK}$3{_MARK}$1")
    return F.try_to_date(text, f"d{_MARK}M{_MARK}[yyyy][yy]")


def as_date(c: Column, data_type: T.DataType, iso_text: bool = True) -> Column:
    """``mixed_date`` for text; typed dates and timestamps pass through."""
    if isinstance(data_type, T.StringType):
        return mixed_date(c, iso_text)
    return c.cast("date")


def days_to_pay(paid: Column, invoiced: Column) -> Column:
    """Whole days from invoice to payment, never negative, NULL if unpaid.

    Both sides must be DATE: on timestamps the day count would ignore the
    time of day.  A payment before the invoice counts as 0 days.
    """
    return F.when(paid.isNotNull(), F.greatest(F.datediff(paid, invoiced), F.lit(0)))


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")
