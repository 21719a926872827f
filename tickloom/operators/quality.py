"""Data-quality checks. Each is one aggregate over the data; results are a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import KEYS
from tickloom.sources.documents import EMPTY
from tickloom.sources.frames import union_all

# The columns the models promise never to be NULL.
NOT_NULL_COLUMNS = {
    "mart_stock_performance": ("ticker", "date", "close_price"),
    "mart_github_correlation": ("ticker", "date"),
}

# What the documented columns mean.
COLUMN_COMMENTS = {
    "ticker": "Stock symbol",
    "date": "Trading day",
    "close_price": "Closing price of the day",
    "daily_return_pct": "Change of the close against the previous bar, in percent",
    "vwap": "Volume weighted average price of the day",
    "total_commits_today": "Commits of the day over the tracked repositories",
    "total_open_prs": "Open pull requests over the tracked repositories",
    "moving_avg_7d": "Mean close of the last 7 bars",
    "moving_avg_20d": "Mean close of the last 20 bars",
    "developer_activity_score": "Commits plus open pull requests of the day",
    "is_high_activity_day": "True for more than 10 commits on the day",
}


class QualityError(AssertionError):
    """A data-quality check found failing rows."""


def check_not_null(df: DataFrame, columns, check: str = "not_null") -> DataFrame:
    """``(check, column_name, failures)``, one row per column, from one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(check).alias("check"), "r.*")


def failing_rows(df: DataFrame, columns) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.where(any_null)


def check_unique(df: DataFrame, keys=KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows as ``copies``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def validate_raw(parsed: DataFrame, keys=KEYS) -> DataFrame:
    """``(check, failures)`` on parsed raw rows: rows per problem, and keys with several versions.

    One shuffle: rows are first reduced to counts per (key, problem).
    """
    counts = parsed.groupBy(*keys, "row_problem").agg(F.count(F.lit(1)).alias("n"))
    good = F.col("row_problem").isNull()
    return (
        counts.select(
            F.when(good, "several_versions").otherwise(F.col("row_problem")).alias("check"),
            F.when(good, (F.col("n") > 1).cast("bigint")).otherwise(F.col("n")).alias("n"),
        )
        .where(F.col("check") != EMPTY)
        .groupBy("check")
        .agg(F.sum("n").alias("failures"))
    )


def with_comments(df: DataFrame, comments: dict[str, str] = COLUMN_COMMENTS) -> DataFrame:
    """Attach column descriptions, which tables keep as column comments."""
    for name in df.columns:
        if name in comments:
            df = df.withMetadata(name, {**df.schema[name].metadata, "comment": comments[name]})
    return df


def describe_columns(df: DataFrame) -> dict[str, str]:
    """Column name to its description, where it has one."""
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """``(column, type)`` pairs in order."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def assert_quality(checks: DataFrame) -> None:
    """Raise when one of the few rows of ``checks`` counts failures."""
    failed = checks.where("failures > 0").collect()
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))


def _per_key(df: DataFrame, columns, keys) -> DataFrame:
    """Rows reduced to one per key, with its copies and the NULLs counted along the way."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), *nulls)


def _totals(columns) -> list[Column]:
    nulls = [F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in columns]
    return [F.count_if(F.col("copies") > 1).alias("repeated"), *nulls]


def _check_rows(totals: DataFrame, columns, name: str, keys, *beside: str) -> DataFrame:
    """``totals`` as ``(*beside, check, column_name, failures)`` rows."""
    found = {("not_null", c): f"null_{c}" for c in columns} | {("unique", ",".join(keys)): "repeated"}
    rows = [
        F.struct(F.lit(f"{name}.{kind}").alias("check"), F.lit(on).alias("column_name"), F.col(c).alias("failures"))
        for (kind, on), c in found.items()
    ]
    return totals.select(*beside, F.explode(F.array(*rows)).alias("r")).select(*beside, "r.*")


def check_table(df: DataFrame, columns, name: str, keys=KEYS) -> DataFrame:
    """Not-null and grain checks of one table as ``(check, column_name, failures)``, in one pass.

    Rows are reduced per key, NULLs counted along the way, before the grain is looked at.
    """
    return _check_rows(_per_key(df, columns, keys).agg(*_totals(columns)), columns, name, keys)


def check_state(df: DataFrame, columns, name: str, part: Column, keys=KEYS) -> DataFrame:
    """What :func:`check_table` counts, by part: ``(part, check, column_name, failures)``.

    ``part`` is an expression over ``keys`` alone (a day, a month, a bucket), so all rows of a key lie in
    one part and the counts of parts add up to those of the table. ``df`` may hold some parts
    only, but those whole. A key that gives NULL is in the part NULL.
    """
    totals = _per_key(df, columns, keys).groupBy(part.cast("string").alias("part")).agg(*_totals(columns))
    return _check_rows(totals, columns, name, keys, "part")


def merge_states(kept: DataFrame, fresh: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """The state of a table some of whose parts were checked again: their counts replaced, others as kept.

    ``parts`` (a column ``part``) names the parts checked, by default those that ``fresh`` has rows for; name them
    where a part may have lost all its rows.
    """
    again = (fresh if parts is None else parts).select(F.col("part").alias("_again")).distinct()
    return kept.join(again, F.col("part").eqNullSafe(F.col("_again")), "left_anti").unionByName(fresh)


def checks_of_state(state: DataFrame, columns, name: str, keys=KEYS) -> DataFrame:
    """The counts of :func:`check_table` from those of all parts, without the table; zeros where there is none."""
    own = state.where(F.col("check").isin(f"{name}.not_null", f"{name}.unique"))
    none = state.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("repeated"), *[F.lit(0).cast("bigint").alias(f"null_{c}") for c in columns])
    counts = own.drop("part").unionByName(_check_rows(none, columns, name, keys))
    return counts.groupBy("check", "column_name").agg(F.sum("failures").alias("failures"))


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """All promised checks of the marts."""
    return union_all([check_table(marts[name], columns, name) for name, columns in NOT_NULL_COLUMNS.items()])
