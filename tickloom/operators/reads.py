"""Read-side queries over bars and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import round4

# The seven preview columns.
PREVIEW_COLUMNS = ("ticker", "date", "close_price", "daily_return_pct", "vwap", "total_commits_today", "total_open_prs")


def preview(df: DataFrame, n: int = 10, columns=PREVIEW_COLUMNS) -> DataFrame:
    """First ``n`` rows in key order: a top-n per task, never a full sort."""
    return df.select([c for c in columns if c in df.columns]).orderBy("ticker", "date").limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def width(df: DataFrame) -> int:
    return len(df.columns)


def bars_on(df: DataFrame, ticker: str, date: dt.date | str) -> DataFrame:
    """Rows of one ticker and day. On the written dataset this prunes to one ticker folder."""
    return df.where((F.col("ticker") == ticker) & (F.col("date") == F.lit(str(date)).cast("date")))


def price_trend(mart: DataFrame, ticker: str) -> DataFrame:
    """Close and 7-row average of one ticker. The filter is on the window key, so it reaches the scan."""
    return mart.where(F.col("ticker") == ticker).select("ticker", "date", "close_price", "moving_avg_7d")


def returns_between(mart: DataFrame, low: dt.date | str, high: dt.date | str) -> DataFrame:
    """Daily returns of all tickers between two days, inclusive.

    Over a stored mart the date filter reaches the scan. Over a mart still being derived it
    stays above the windows, which must see the days before ``low``.
    """
    days = F.col("date").between(F.lit(str(low)).cast("date"), F.lit(str(high)).cast("date"))
    return mart.where(days).select("ticker", "date", "daily_return_pct")


def activity_by_company(mart: DataFrame) -> DataFrame:
    """Total and mean activity score per ticker."""
    score = F.col("developer_activity_score")
    return mart.groupBy("ticker").agg(
        F.sum(score).alias("total_score"),
        round4(F.avg(score)).alias("avg_score"),
        F.count_if("is_high_activity_day").alias("high_activity_days"),
    )


def volatility_by_company(mart: DataFrame) -> DataFrame:
    """7-row volatility per ticker and day, where there is one."""
    return mart.where(F.col("volatility_7d").isNotNull()).select("ticker", "date", "volatility_7d")


def activity_return_corr(mart: DataFrame) -> DataFrame:
    """Pearson correlation of activity score and daily return per ticker, over days that have both.

    NULL where either side does not vary.
    """
    both = mart.where(F.col("total_commits_today").isNotNull() & F.col("daily_return_pct").isNotNull())
    x, y = F.col("developer_activity_score").cast("double"), F.col("daily_return_pct")
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return both.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("days"), F.when(varies, round4(F.corr(x, y))).alias("score_return_corr")
    )
