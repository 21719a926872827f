"""Numeric expressions shared by sources, operators and models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH_ACTIVITY_COMMITS = 10


NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(text: Column, kind: str = "double") -> Column:
    """Decimal text to ``double`` or ``bigint``; NULL where the text is not such a number.

    The cast alone also takes ``12d``, ``0x1p3``, ``NaN`` and infinities, also as overflow.
    """
    number = F.when(text.rlike(NUMBER_TEXT), text.try_cast(kind))
    return number if kind != "double" else F.when(F.abs(number) < float("inf"), number)


def to_count(text: Column) -> Column:
    """JSON number text to ``bigint`` (``12.0`` and ``12`` are both 12); NULL for a real fraction."""
    number = to_number(text)
    return F.coalesce(to_number(text, "bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def is_malformed(text: Column, parsed: Column) -> Column:
    """True where a value was given but could not be read."""
    return text.isNotNull() & parsed.isNull()


def default0(value: Column) -> Column:
    """0 for a missing number."""
    return F.coalesce(value, F.lit(0))


def round4(value: Column) -> Column:
    """Round to four places, with binary noise beyond the eighth place removed first.

    Sums of doubles differ in their last bits with the order of addition. Without the snap
    such a bit decides which way an exact tie goes. Values outside decimal(28,8) (infinite,
    or 1e20 and more) are rounded directly.
    """
    snapped = F.round(value.try_cast("decimal(28,8)"), 4).cast("double")
    return F.coalesce(snapped, F.round(value, 4))


def pct_change(current: Column, previous: Column) -> Column:
    """Change from ``previous`` to ``current`` in percent; NULL when ``previous`` is 0 or NULL."""
    return F.try_divide(current - previous, previous) * 100


def activity_score(commits: Column, open_prs: Column) -> Column:
    """Commits plus open pull requests, a missing one counting as 0."""
    return default0(commits) + default0(open_prs)


def high_activity(commits: Column, threshold: int = HIGH_ACTIVITY_COMMITS) -> Column:
    """True for strictly more than ``threshold`` commits; false when unknown."""
    return F.coalesce(commits > threshold, F.lit(False))
