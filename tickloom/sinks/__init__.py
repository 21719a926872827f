"""Writing the combined dataset and publishing tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.schemas import KEYS
from tickloom.sinks.versions import write_version

CODEC = "snappy"


def write_combined(df: DataFrame, path: str) -> dict:
    """Write the next version of the dataset at ``path``: Parquet, one folder per ticker, rows in day order.

    All rows of a ticker go to one task, so a ticker is one file instead of one per task. A
    ticker has at most one row per day, which bounds that task. Where the plan below already
    is partitioned and sorted that way (after the return window), Spark drops both steps.

    Readers see the version once all of it is there; a job that dies leaves the former one. Returns
    the version's facts, whose ``rows`` come from the written files.
    """
    return write_version(df, path, _write_by_ticker)


def _write_by_ticker(df: DataFrame, folder: str) -> None:
    (
        df.repartition("ticker")
        .sortWithinPartitions(*KEYS)
        .write.option("compression", CODEC)
        .partitionBy("ticker")
        .parquet(folder)
    )


def publish_table(df: DataFrame, name: str) -> None:
    """Create or replace table ``name`` from ``df``, in files of the advisory size.

    Tables with the combined key are clustered by it, so reads of one ticker skip the rest.
    """
    keyed = [key for key in KEYS if key in df.columns]
    df = df.hint("rebalance", *keyed[:1])
    df = df.sortWithinPartitions(*keyed) if keyed else df
    df.write.mode("overwrite").option("compression", CODEC).saveAsTable(name)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames queryable by name without storing them."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
