from tickloom.functions.dates import day_start, doc_key, last_trading_day, parse_date, run_date_text
from tickloom.functions.numbers import (
    activity_score,
    default0,
    high_activity,
    is_malformed,
    pct_change,
    round4,
    to_count,
    to_number,
)

__all__ = [
    "activity_score",
    "day_start",
    "default0",
    "doc_key",
    "high_activity",
    "is_malformed",
    "last_trading_day",
    "parse_date",
    "pct_change",
    "round4",
    "run_date_text",
    "to_count",
    "to_number",
]
