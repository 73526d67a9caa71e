"""Date helpers for statement text dates and month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statement text dates look like "07 FEB 2026" or "7 Feb 2026";
# the one-letter day pattern accepts both one- and two-digit days, any case.
STATEMENT_DATE_FORMAT = "d MMM yyyy"
MONTH_FORMAT = "yyyy-MM"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_statement_date(c: Column | str, on_bad: str = "error") -> Column:
    """Parse a statement date string.

    ``on_bad='error'`` fails the job on an unparseable value (ANSI); ``'null'``
    yields NULL instead so the caller can quarantine the row.
    """
    # Month names in source files may be upper case; normalise to the
    # "Feb" form the pattern expects.
    text = F.initcap(F.lower(F.trim(_c(c))))
    if on_bad == "null":
        return F.try_to_date(text, STATEMENT_DATE_FORMAT)
    return F.to_date(text, STATEMENT_DATE_FORMAT)


def year_month(c: Column | str) -> Column:
    return F.date_format(_c(c), MONTH_FORMAT)


def month_start(c: Column | str) -> Column:
    """First day of the month as DATE (``trunc`` keeps DATE, ``date_trunc`` would not)."""
    return F.trunc(_c(c).cast("date"), "MM")


def month_start_of_ym(c: Column | str) -> Column:
    """'YYYY-MM' -> DATE of its first day."""
    return F.concat(_c(c), F.lit("-01")).cast("date")
