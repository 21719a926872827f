"""The model layer: staging, intermediate and mart frames over the combined table.

Every model is a function of frames, so a mart is one logical plan down to the scan; nothing
is stored in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import activity_score, high_activity
from tickloom.functions.numbers import HIGH_ACTIVITY_COMMITS
from tickloom.operators.windows import with_rolling
from tickloom.schemas import ACTIVITY, ACTIVITY_VALUES, AGGREGATES, BAR_VALUES, COMPUTED_VALUES, KEYS
from tickloom.sources.frames import empty_like

_POLYGON_NAMES = {
    "poly_open": "polygon_open",
    "poly_high": "polygon_high",
    "poly_low": "polygon_low",
    "poly_close": "polygon_close",
    "poly_volume": "polygon_volume",
    "vwap": "vwap",
    "transactions": "transactions",
}
_STOCK_COLUMNS = (*KEYS, *BAR_VALUES, "daily_return_pct")
_DAILY_POLYGON = ("polygon_open", "polygon_close", "polygon_volume", "vwap", "transactions")


def _stamp(df: DataFrame) -> list[str]:
    return [c for c in ("processed_at",) if c in df.columns]


# --- staging -----------------------------------------------------------------------------


def stg_stock_prices(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("close_price").isNotNull()).select(*_STOCK_COLUMNS, *_stamp(raw))


def stg_polygon_trades(raw: DataFrame) -> DataFrame:
    renamed = [F.col(old).alias(new) for old, new in _POLYGON_NAMES.items()]
    return raw.where(F.col("vwap").isNotNull()).select(*KEYS, *renamed)


def stg_github_activity(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("total_commits_today").isNotNull()).select(*KEYS, *ACTIVITY_VALUES)


# --- intermediate ------------------------------------------------------------------------


def int_company_daily(stocks: DataFrame, polygon: DataFrame, activity: DataFrame) -> DataFrame:
    """Three staging frames joined on the key, from stocks."""
    keys = list(KEYS)
    joined = stocks.join(polygon.select(*keys, *_DAILY_POLYGON), keys, "left").join(activity, keys, "left")
    return joined.select(*_STOCK_COLUMNS, *_DAILY_POLYGON, *ACTIVITY_VALUES, *_stamp(stocks))


def int_company_daily_single_scan(raw: DataFrame) -> DataFrame:
    """The same rows as :func:`int_company_daily` from one scan of ``raw`` and no join.

    The staging frames are slices of one table. Joining them back on its key returns each
    row's own values, masked where the slice's filter was false. Holds when the key is
    unique and not NULL, which :func:`~tickloom.plans.pipeline.run_processing` ensures.
    """
    traded, active = F.col("vwap").isNotNull(), F.col("total_commits_today").isNotNull()
    polygon = [
        F.when(traded, F.col(old)).alias(new) for old, new in _POLYGON_NAMES.items() if new in _DAILY_POLYGON
    ]
    activity = [F.when(active, F.col(c)).alias(c) for c in ACTIVITY_VALUES]
    return stg_rows(raw).select(*_STOCK_COLUMNS, *polygon, *activity, *_stamp(raw))


def stg_rows(raw: DataFrame) -> DataFrame:
    """Rows with stock data, all columns."""
    return raw.where(F.col("close_price").isNotNull())


def company_daily(raw: DataFrame, unique_key: bool = True) -> DataFrame:
    """Company-day rows from the combined table; ``unique_key=False`` takes the join form."""
    if unique_key:
        return int_company_daily_single_scan(raw)
    return int_company_daily(stg_stock_prices(raw), stg_polygon_trades(raw), stg_github_activity(raw))


# --- marts -------------------------------------------------------------------------------


def mart_stock_performance(daily: DataFrame) -> DataFrame:
    columns = (*_STOCK_COLUMNS, "vwap", "transactions")
    rolled = with_rolling(daily.select(*columns, *_stamp(daily)))
    return rolled.select(*columns, "moving_avg_7d", "moving_avg_20d", "volatility_7d", *_stamp(daily))


def mart_github_correlation(daily: DataFrame, threshold: int = HIGH_ACTIVITY_COMMITS) -> DataFrame:
    """Score and flag per company-day. Days without activity stay, with score 0 and no flag."""
    commits, open_prs = F.col("total_commits_today"), F.col("total_open_prs")
    return daily.where(F.col("close_price").isNotNull()).select(
        *KEYS,
        "close_price",
        "daily_return_pct",
        "volume",
        "vwap",
        "total_commits_today",
        "total_open_prs",
        "total_stars",
        "total_forks",
        activity_score(commits, open_prs).alias("developer_activity_score"),
        high_activity(commits, threshold).alias("is_high_activity_day"),
        *_stamp(daily),
    )


def marts_of_corrected(
    corrected: DataFrame,
    aggregates: DataFrame | None = None,
    activity: DataFrame | None = None,
    threshold: int = HIGH_ACTIVITY_COMMITS,
) -> dict[str, DataFrame]:
    """Both marts over a table of corrected bars, with the averages kept there: no window, no sort.

    ``corrected`` is what :func:`~tickloom.streaming.bars.read_corrected_bars` gives; the other feeds hold one row
    per key and may be missing. The rows are those of the marts over all landed bars, rebuilt.
    """
    spark, keys = corrected.sparkSession, list(KEYS)
    aggregates = empty_like(spark, AGGREGATES) if aggregates is None else aggregates
    activity = empty_like(spark, ACTIVITY) if activity is None else activity
    traded = aggregates.where(F.col("vwap").isNotNull()).select(*keys, "vwap", "transactions")
    active = activity.where(F.col("total_commits_today").isNotNull()).select(*keys, *ACTIVITY_VALUES)
    bars = corrected.where(F.col("close_price").isNotNull()).select(*keys, *BAR_VALUES, *COMPUTED_VALUES)
    daily = bars.join(traded, keys, "left").join(active, keys, "left")
    rolled = [c for c in COMPUTED_VALUES if c not in _STOCK_COLUMNS]
    return {
        "mart_stock_performance": daily.select(*_STOCK_COLUMNS, "vwap", "transactions", *rolled),
        "mart_github_correlation": mart_github_correlation(daily, threshold),
    }
