"""Daily return and rolling statistics per ticker.

Task size: the input has one row per (ticker, date) (see ``latest_per_key``), so a ticker's
window partition is at most its number of calendar days - some 36,500 narrow rows for a
century - however many raw copies it arrived as. Frames count rows (trading days), not days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import pct_change, round4


#: Rows of the longest frame: what a bar changes ends as many rows after it, less one.
LONGEST = 20


def by_day() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("date")


def last_rows(n: int) -> WindowSpec:
    """The current row and the ``n - 1`` rows before it."""
    return by_day().rowsBetween(1 - n, Window.currentRow)


def with_daily_return(bars: DataFrame) -> DataFrame:
    """Add ``daily_return_pct`` against the previous bar of the ticker (NULL for the first)."""
    previous = F.lag("close_price", 1).over(by_day())
    return (
        bars.withColumn("_prev_close", previous)
        .withColumn("daily_return_pct", round4(pct_change(F.col("close_price"), F.col("_prev_close"))))
        .drop("_prev_close")
    )


def with_rolling(df: DataFrame) -> DataFrame:
    """Add 7- and 20-row moving averages of the close and 7-row volatility of returns.

    The frames share partitioning and order: one exchange, one sort, one window operator.
    """
    return df.withColumns(
        {
            "moving_avg_7d": round4(F.avg("close_price").over(last_rows(7))),
            "moving_avg_20d": round4(F.avg("close_price").over(last_rows(LONGEST))),
            "volatility_7d": round4(F.stddev_samp("daily_return_pct").over(last_rows(7))),
        }
    )
