"""Day-first dates and Portuguese prose dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import bind, grab, strip


def parse_dmy(c: Column) -> Column:
    """``d/m/yyyy`` text to a date; null on anything else."""
    t = strip(c)
    return F.when(t.rlike(r"\A\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_date(t, "d/M/yyyy"))


def month_number(name: Column) -> Column:
    months = F.create_map(*[F.lit(x) for pair in K.MONTHS_PT.items() for x in pair])
    return F.try_element_at(months, F.lower(name))


def prose_date(match: Column, pattern: str, unknown_month: str | None) -> Column:
    """A ``day … month-name … year`` match as ``dd/mm/yyyy``.

    An unknown month name gives ``unknown_month``, or null when that is None.
    The text was searched once; the parts come from the short match.
    """
    def date(match: Column) -> Column:
        day = grab(match, pattern, 1, "i")
        month = month_number(grab(match, pattern, 2, "i"))
        if unknown_month is not None:
            month = F.coalesce(month, F.lit(unknown_month))
        year = grab(match, pattern, 3, "i")
        return F.when(match.isNotNull(), F.concat(F.lpad(day, 2, "0"), F.lit("/"), month, F.lit("/"), year))

    return bind(match, date)


def masthead(text: Column) -> Column:
    """The words of the first masthead date."""
    return grab(text, K.MASTHEAD_DATE, 0, "i")


def masthead_date(text: Column, found: Column | None = None) -> Column:
    return prose_date(masthead(text) if found is None else found, K.MASTHEAD_DATE, None)


def opening_date(text: Column) -> Column:
    return prose_date(grab(text, K.HEADER_DATE_PROSE, 0, "i"), K.HEADER_DATE_PROSE, "??")
