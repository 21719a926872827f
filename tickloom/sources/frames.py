"""Small helpers for sources that may be missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.session import path_exists


class MissingSourceError(ValueError):
    """A source the job cannot run without has no rows."""


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, typed columns.

    Built as a filter that is always false, which the optimizer folds to an empty relation:
    a left join against it costs nothing, its columns become NULL literals.
    """
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(1).where(F.lit(False)).select(nulls)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself, or an error when it has no row (reads no more than one)."""
    if df.isEmpty():
        raise MissingSourceError(f"source '{name}' has no rows; cannot continue")
    return df


def present_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Those of ``paths`` that exist (a driver-side check of the few roots a job names)."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    return [root for root in roots if path_exists(spark, root)]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda left, right: left.unionByName(right), frames)
