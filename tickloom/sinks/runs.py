"""Tables published together: every run's rows stay in one table per name, and one pointer picks the run.

``store_run`` writes the rows of a run beside those of earlier ones, as a partition of
``<name>__runs`` that no reader sees. ``publish_run`` then replaces the pointer, a view of one row, and
with that all names turn to the run at once: each name is a view of the rows whose run the pointer
names. A job that dies on the way leaves every name as it was.

Rows are bucketed by ticker, one sorted file per bucket and run. Read with ``stored_layout``,
windows per ticker and joins on (ticker, date) neither shuffle nor sort them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import KEYS
from tickloom.session import settings
from tickloom.sinks.versions import drop_folder

POINTER = "published_run"
RUN = "run"
#: Published runs whose rows stay: the current one, and the one that running readers may hold.
KEEP = 2


def runs_table(name: str) -> str:
    return f"{name}__runs"


def new_run() -> str:
    """A name that sorts after those of earlier runs."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


@contextmanager
def stored_layout(spark: SparkSession) -> Iterator[None]:
    """Use the order of bucketed files, and bucketing by a part of the join keys, while inside.

    Plans are made when an action runs, so the action belongs inside too.
    """
    with settings(
        spark,
        {
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
            "spark.sql.requireAllClusterKeysForCoPartition": "false",
        },
    ):
        yield


def _described(spark: SparkSession, table: str, fact: str) -> str:
    return spark.sql(f"describe extended {table}").where(F.col("col_name") == fact).first()["data_type"]


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a stored table."""
    return int(_described(spark, table, "Num Buckets"))


def store_run(df: DataFrame, name: str, run: str, buckets: int | None = None, location: str | None = None) -> None:
    """Write ``df`` (with the combined key) as the rows of ``run`` of ``name``; readers do not see them yet.

    A first run sets the number of buckets (by default the session's shuffle partitions); later ones
    follow the table. New columns are added to it, columns that a run lacks are NULL there; a column
    of another type is an error. A name that begins a new table must not be taken by one. ``location``
    is where a new table's folder goes, by default the warehouse.
    """
    spark, table, place = df.sparkSession, runs_table(name), {}
    if spark.catalog.tableExists(table):
        buckets = bucket_count(spark, table)
        have = {f.name: f.dataType for f in spark.table(table).schema}
        wrong = [f.name for f in df.schema if f.name in have and have[f.name] != f.dataType]
        if wrong:
            raise ValueError(f"{table} has other types for {wrong}")
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in have]
        if added:
            spark.sql(f"alter table {table} add columns ({', '.join(added)})")
        lacking = {c: F.lit(None).cast(kind) for c, kind in have.items() if c not in df.columns and c != RUN}
        df = df.withColumns(lacking) if lacking else df
    elif location is not None:
        place = {"path": f"{location.rstrip('/')}/{table}"}
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.withColumn(RUN, F.lit(run))
        .repartition(buckets, "ticker")
        .sortWithinPartitions(*KEYS)
        .write.mode("append")
        .format("parquet")
        .options(compression="snappy", **place)
        .partitionBy(RUN)
        .bucketBy(buckets, "ticker")
        .sortBy(*KEYS)
        .saveAsTable(table)
    )


def run_rows(spark: SparkSession, name: str, run: str) -> DataFrame:
    """The rows of one run, published or not."""
    return spark.table(runs_table(name)).where(F.col(RUN) == run).drop(RUN)


def published_run(spark: SparkSession, pointer: str = POINTER) -> str | None:
    """The run that readers see; None before the first."""
    return spark.table(pointer).first()[RUN] if spark.catalog.tableExists(pointer) else None


def publish_run(spark: SparkSession, run: str, frames: dict[str, DataFrame], pointer: str = POINTER, keep: int = KEEP) -> None:
    """Let readers of all names of ``frames`` see ``run`` from now on.

    ``frames`` gives the columns of each name, with their comments. The views are the same from run to run
    unless columns change, so replacing the pointer is the one step that shows the run. Rows of
    runs before the last ``keep`` published ones, and of runs never published, then go.
    """
    shown = [r[RUN] for r in spark.table(pointer).select(F.explode("history").alias(RUN)).collect()] if published_run(spark, pointer) else []
    if not shown:
        # No reader yet: the pointer must be there for the views to name it.
        _point(spark, pointer, "", [])
    for name, frame in frames.items():
        _view(spark, name, frame, pointer)
    stay = [run, *[r for r in shown if r != run]][: max(1, keep)]
    _point(spark, pointer, run, stay)
    for name in frames:
        _drop_runs(spark, runs_table(name), stay)


def _point(spark: SparkSession, pointer: str, run: str, history: list[str]) -> None:
    names = ", ".join(f"'{r}'" for r in history)
    spark.sql(f"create or replace view {pointer} as select '{run}' as {RUN}, cast(array({names}) as array<string>) as history")


def _view(spark: SparkSession, name: str, frame: DataFrame, pointer: str) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    columns = [f"`{f.name}`" + (f" comment {quoted(f.metadata['comment'])}" if "comment" in f.metadata else "") for f in frame.schema]
    listed = ", ".join(f"`{c}`" for c in frame.columns)
    spark.sql(
        f"create or replace view {name} ({', '.join(columns)}) as "
        f"select {listed} from {runs_table(name)} where {RUN} = (select {RUN} from {pointer})"
    )


def _drop_runs(spark: SparkSession, table: str, stay: list[str]) -> None:
    held = [r[0].split("=", 1)[1] for r in spark.sql(f"show partitions {table}").collect()]
    for run in held:
        if run not in stay:
            spark.sql(f"alter table {table} drop if exists partition ({RUN} = '{run}')")
            # A table outside the warehouse leaves the files to whoever dropped them.
            drop_folder(spark, f"{_described(spark, table, 'Location')}/{RUN}={run}")
