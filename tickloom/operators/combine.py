"""Left joins of the three feeds on (ticker, date)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators.windows import with_daily_return
from tickloom.schemas import KEYS
from tickloom.sources.frames import empty_like


def combine(
    bars: DataFrame, aggregates: DataFrame | None = None, activity: DataFrame | None = None, sort: bool = False
) -> DataFrame:
    """Bars with the other two feeds where they have the same key; absent feeds give NULLs.

    All inputs hold one row per key. The joins use the key the deduplication grouped by, so
    each feed is shuffled once. The return is added after the joins: left joins on a unique
    key keep exactly the bars, and the ticker exchange of the window is then also the layout
    :func:`~tickloom.sinks.write_combined` needs. ``sort`` adds a global sort by key;
    writing does not need it.
    """
    spark = bars.sparkSession
    aggregates = empty_like(spark, schemas.AGGREGATES) if aggregates is None else aggregates
    activity = empty_like(spark, schemas.ACTIVITY) if activity is None else activity
    keys = list(KEYS)
    joined = (
        bars.select(*keys, *schemas.BAR_VALUES)
        .join(aggregates.select(*keys, *schemas.AGGREGATE_VALUES), keys, "left")
        .join(activity.select(*keys, *schemas.ACTIVITY_VALUES), keys, "left")
    )
    combined = with_daily_return(joined).select([c for c in schemas.COMBINED.names if c != "processed_at"])
    return combined.orderBy(*keys) if sort else combined


def with_processed_at(df: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Stamp all rows with one run timestamp (default: now, taken once)."""
    return df.withColumn("processed_at", F.lit(run_ts or dt.datetime.now(dt.timezone.utc)).cast("timestamp"))


def dropped_keys(bars: DataFrame, feed: DataFrame) -> DataFrame:
    """Keys of ``feed`` that no bar carries, which the left join drops (weekends, say)."""
    return feed.select(*KEYS).join(bars.select(*KEYS), list(KEYS), "left_anti")
