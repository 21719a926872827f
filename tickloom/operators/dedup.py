"""One row per key, and the newest rows of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schemas import KEYS, VERSION


def latest_per_key(df: DataFrame, keys=KEYS, order=VERSION) -> DataFrame:
    """The newest version of each key: greatest ``order``, then greatest remaining values.

    An aggregate instead of a ranking window: copies of a key are reduced to one row per map
    task before the shuffle, so a key that holds a large share of all rows reaches its
    reducer as a handful. Comparing the remaining values makes ties independent of the
    order of input. Columns must be comparable (no maps).
    """
    keys = list(keys)
    ranked = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *rest)).alias("_newest"))
    return newest.select([F.col(c) if c in keys else F.col("_newest").getField(c).alias(c) for c in df.columns])


def last_n_per_ticker(df: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` days of each ticker, ascending within it.

    The rank filter is applied per map task first (WindowGroupLimit), so at most ``n`` rows
    of a ticker leave each task.
    """
    newest_first = Window.partitionBy("ticker").orderBy(F.desc("date"))
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") <= n).drop("_rank").sortWithinPartitions("ticker", "date")
