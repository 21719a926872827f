"""Date and key expressions. All are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_TEXT = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
MONDAY, SUNDAY = 0, 6


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; NULL for anything else (also under ANSI mode).

    The cast alone also takes ``2026-3-1`` or ``2026``. Pattern and cast together are strict,
    and bad text seldom gets as far as an exception, which is what makes it slow to refuse.
    """
    return F.when(text.rlike(DATE_TEXT), text.try_cast("date"))


def run_date_text(day: Column | None = None) -> Column:
    """The run day (default: today in the session zone) as ``yyyy-MM-dd`` text."""
    return (F.current_date() if day is None else day).cast("date").cast("string")


def last_trading_day(day: Column) -> Column:
    """The weekday before ``day``: Friday for Sunday and Monday, else the day before.

    Weekends are all it knows; exchange holidays count as trading days.
    """
    weekday = F.weekday(day)
    return (
        F.when(weekday == MONDAY, F.date_sub(day, 3))
        .when(weekday == SUNDAY, F.date_sub(day, 2))
        .otherwise(F.date_sub(day, 1))
    )


def doc_key(ticker: Column, day: Column) -> Column:
    """Name of the document landed for one ticker and day."""
    return F.concat(ticker, F.lit("_"), run_date_text(day), F.lit(".json"))


def day_start(day: Column) -> Column:
    """ISO text of the first instant of ``day`` in UTC, the lower bound of "today"."""
    return F.concat(run_date_text(day), F.lit("T00:00:00Z"))
