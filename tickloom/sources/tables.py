"""Reading what the pipeline has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import COMBINED
from tickloom.sinks.versions import current_version


def read_combined(spark: SparkSession, path: str) -> DataFrame:
    """The combined dataset: its last committed version, or ``path`` itself if it holds no versions.

    The declared schema keeps a numeric-looking ticker a string.
    """
    return spark.read.schema(COMBINED).parquet(current_version(spark, path) or path)


def relation(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name: how a model refers to a source that is stored."""
    return spark.table(name)
