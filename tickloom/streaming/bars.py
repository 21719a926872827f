"""Incremental landing of bar documents with Structured Streaming.

Both jobs use the available-now trigger: they take in the files that arrived since the last
run and stop. The checkpoint remembers which files were taken, so none is processed twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickloom import schemas
from tickloom.operators.quality import NOT_NULL_COLUMNS, check_state, checks_of_state, merge_states
from tickloom.operators.windows import LONGEST, by_day, last_rows, with_daily_return, with_rolling
from tickloom.session import path_exists, shared_dir
from tickloom.sinks.versions import current_version, read_facts, write_facts, write_version
from tickloom.sources.documents import FILE_PATTERN, accepted, parse_daily_bars, source_path
from tickloom.sources.packing import pack_files, stream_packed_documents

ACCEPTED = "accepted"
#: Buckets of a new corrected table. Their number is kept beside the table, which goes by that from then on.
BUCKETS = 64
#: What the folders inside a bucket may hold.
PERIODS = ("year", "month")
LAYOUT = "_layout.json"
#: The mart whose promises the corrected rows are checked for.
CHECKED = "mart_stock_performance"


def stream_documents(spark: SparkSession, path: str, multi_line: bool = True, max_files: int = 10_000) -> DataFrame:
    """New bar documents below ``path``, at most ``max_files`` files per micro-batch."""
    return (
        spark.readStream.schema(schemas.BAR_DOCUMENT)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", FILE_PATTERN)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
        .withColumn("_file_path", F.col("_metadata.file_path"))
    )


def checkpoint_for(spark: SparkSession, job: str, target: str) -> str:
    """Where ``job`` remembers what it has taken into ``target``, the same in every run.

    In the shared folder of the cluster; without one, beside the target.
    """
    shared = shared_dir(spark)
    if shared is None:
        return f"{target.rstrip('/')}_{job}_checkpoint"
    digest = hashlib.sha256(target.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared}/streams/{job}-{digest}"


def land_incremental(
    spark: SparkSession, raw_dir: str, out: str, checkpoint: str | None = None, multi_line: bool = True, **options
) -> None:
    """Parse bar files that are new since the last run and append their rows to ``out``.

    Good and bad rows go through one exactly-once file sink; partition column ``verdict``
    (``accepted`` or the problem) keeps them apart.
    """
    documents = stream_documents(spark, source_path(raw_dir, "stocks"), multi_line, **options)
    rows = parse_daily_bars(documents).withColumn("verdict", F.coalesce("row_problem", F.lit(ACCEPTED)))
    query = (
        rows.drop("row_problem")
        .writeStream.format("parquet")
        .partitionBy("verdict")
        .option("path", out)
        .option("checkpointLocation", checkpoint or checkpoint_for(spark, "land_bars", out))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_landed_bars(spark: SparkSession, out: str) -> DataFrame:
    """Accepted rows written by :func:`land_incremental`, all versions."""
    landed = spark.read.schema(schemas.LANDED_BARS).parquet(out)
    return landed.where(F.col("verdict") == ACCEPTED).drop("verdict")


def bucket_of(ticker: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of the corrected table that holds a ticker."""
    return F.pmod(F.xxhash64(ticker), F.lit(buckets)).cast("int")


def period_of(date: Column, period: str) -> Column:
    """The second folder level of the corrected table: the year, or the month as yyyymm."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    return F.year(date) if period == "year" else F.year(date) * 100 + F.month(date)


def table_layout(spark: SparkSession, table: str) -> dict | None:
    """How the corrected table is laid out (``buckets``, ``period``); None if there is no such table."""
    if not path_exists(spark, table):
        return None
    facts = read_facts(spark, f"{table.rstrip('/')}/{LAYOUT}")
    if facts is None:
        raise ValueError(f"{table} does not say in how many buckets it is laid out; write {LAYOUT} beside its folders")
    if "period" not in facts:
        raise ValueError(f"{table} has folders for buckets alone; build it anew from the landed bars")
    return facts


def table_buckets(spark: SparkSession, table: str) -> int | None:
    """Buckets of the corrected table; None if there is no such table."""
    layout = table_layout(spark, table)
    return None if layout is None else layout["buckets"]


def _stored(spark: SparkSession, table: str) -> DataFrame:
    places = [StructField("bucket", IntegerType()), StructField("period", IntegerType())]
    return spark.read.schema(StructType([*schemas.CORRECTED_BARS.fields, *places])).parquet(table)


def read_corrected_bars(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame:
    """The corrected table, or only some of its buckets."""
    rows = _stored(spark, table)
    return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).drop("bucket", "period")


def _folders(rows: DataFrame, found: dict[int, list[int]]) -> DataFrame:
    """``rows`` (with bucket and period) of the folders ``found``, periods by bucket; a static partition filter."""
    wanted = F.lit(False)
    by_periods: dict[tuple[int, ...], list[int]] = {}
    for bucket, periods in found.items():
        by_periods.setdefault(tuple(sorted(periods)), []).append(bucket)
    for periods, buckets in by_periods.items():
        wanted = wanted | (F.col("bucket").isin(sorted(buckets)) & F.col("period").isin(list(periods)))
    return rows.where(wanted)


def _reached(marked: DataFrame) -> DataFrame:
    """Add ``_affected``: a changed bar, or one of the rows after it whose frames hold it."""
    return marked.withColumn("_affected", F.max("_changed").over(last_rows(LONGEST)))


def _touched_folders(bars: DataFrame, table: str, layout: dict) -> list[Row]:
    """(bucket, period, rewritten) of the folders that hold rows which ``bars`` affect, or rows these are computed from.

    Of the stored table only the keys of the touched tickers' buckets are read. At most one row per folder
    comes to the driver.
    """
    spark, bucket = bars.sparkSession, bucket_of(F.col("ticker"), layout["buckets"])
    buckets = [row[0] for row in bars.select(bucket).distinct().collect()]
    stored = read_corrected_bars(spark, table, buckets).select(*schemas.KEYS)
    own = stored.join(bars.select("ticker").distinct(), "ticker", "left_semi")
    keys = own.withColumn("_changed", F.lit(False)).unionByName(bars.select(*schemas.KEYS).withColumn("_changed", F.lit(True)))
    marked = _reached(keys.groupBy(*schemas.KEYS).agg(F.max("_changed").alias("_changed")))
    before = F.max("_affected").over(by_day().rowsBetween(Window.currentRow, LONGEST - 1))
    placed = marked.withColumn("_read", before).where("_read").select(
        bucket.alias("bucket"), period_of(F.col("date"), layout["period"]).alias("period"), "_affected"
    )
    return placed.groupBy("bucket", "period").agg(F.max("_affected").alias("rewritten")).collect()


def _recomputed(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """The newest version of every bar of both frames, computed anew where ``bars`` reach and as stored elsewhere.

    ``stored`` holds all rows of the affected bars' frames, so a frame of an affected row is whole; the
    rows that it leaves out lie between rows that keep what is stored.
    """
    values = [*schemas.VERSION, *schemas.BAR_VALUES]
    kept = F.struct(*schemas.COMPUTED_VALUES)
    rows = stored.select(*schemas.KEYS, F.struct(*values).alias("_version"), kept.alias("_kept"), F.lit(False).alias("_changed")).unionByName(
        bars.select(*schemas.KEYS, F.struct(*values).alias("_version"), F.lit(True).alias("_changed")), allowMissingColumns=True
    )
    newest = rows.groupBy(*schemas.KEYS).agg(*[F.max(c).alias(c) for c in ("_version", "_kept", "_changed")])
    computed = with_rolling(with_daily_return(_reached(newest.select(*schemas.KEYS, "_version.*", "_kept", "_changed"))))
    taken = {c: F.when(F.col("_affected"), F.col(c)).otherwise(F.col("_kept").getField(c)) for c in schemas.COMPUTED_VALUES}
    return computed.withColumns(taken).select(*schemas.CORRECTED_BARS.names)


def apply_corrections(
    batch: DataFrame, batch_id: int, table: str, staging: str, new_buckets: int = BUCKETS, new_period: str = "year"
) -> None:
    """Merge a batch of bar versions into ``table`` and recompute the rows that it affects.

    A bar changes its own row's return and averages and those of the 19 rows after it (:data:`LONGEST`), and these
    are computed from 19 rows before. The table is laid out by hash bucket of the ticker and by period of
    the date, so only the folders of these rows are read, and only those of affected rows
    written: a corrected day costs a few periods of one bucket, however long the history is. The
    folders' numbers go to the driver, at most one row per folder, and make a static partition filter. A new
    table gets ``new_buckets`` and ``new_period`` (``year`` or ``month``) and keeps both beside
    its folders; an old one goes by its own.

    The new content is first written to ``staging`` and only then replaces the folders. A
    batch that is run again after a crash finds its finished staging copy and repeats just the
    replacement, so a half-replaced table is never taken as input.
    """
    spark = batch.sparkSession
    staged = f"{staging.rstrip('/')}/batch_id={batch_id}"
    known = table_layout(spark, table)
    layout = known or {"buckets": new_buckets, "period": new_period}
    bucket, period = bucket_of(F.col("ticker"), layout["buckets"]), period_of(F.col("date"), layout["period"])
    if known is None:
        write_facts(spark, f"{table.rstrip('/')}/{LAYOUT}", layout)
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        bars = batch.select(*schemas.VERSIONED_BARS.names).persist()
        try:
            read, rewritten = {}, {}
            for row in _touched_folders(bars, table, layout):
                read.setdefault(row.bucket, []).append(row.period)
                if row.rewritten:
                    rewritten.setdefault(row.bucket, []).append(row.period)
            rebuilt = _recomputed(bars, _folders(_stored(spark, table), read))
            _folders(rebuilt.withColumns({"bucket": bucket, "period": period}), rewritten).drop("bucket", "period").write.mode(
                "overwrite"
            ).parquet(staged)
        finally:
            bars.unpersist()
    rewritten_rows = spark.read.schema(schemas.CORRECTED_BARS).parquet(staged)
    (
        rewritten_rows.withColumns({"bucket": bucket, "period": period})
        .hint("rebalance", "bucket", "period")
        .sortWithinPartitions("bucket", "period", *schemas.KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "period")
        .parquet(table)
    )
    _keep_checks(rewritten_rows, table, F.concat_ws("/", bucket, period))
    _drop_stale(spark, staging, batch_id)


def checks_path(table: str) -> str:
    """Beside the corrected table: what the checks counted in each of its folders, in committed versions."""
    return f"{table.rstrip('/')}_checks"


def _keep_checks(rewritten: DataFrame, table: str, folder: Column) -> None:
    """Count the failures in the rewritten folders and keep them with those of the others.

    A table without stored counts is checked whole, once. A batch that is run again counts the
    same rows again and replaces the same folders' counts.
    """
    spark, place = rewritten.sparkSession, checks_path(table)
    kept = current_version(spark, place)
    rows = rewritten if kept else read_corrected_bars(spark, table)
    state = check_state(rows, NOT_NULL_COLUMNS[CHECKED], CHECKED, folder)
    if kept:
        state = merge_states(spark.read.schema(state.schema).parquet(kept), state)
    # Four rows per folder of the table.
    write_version(state, place, lambda df, to: df.coalesce(1).write.parquet(to))


def corrected_checks(spark: SparkSession, table: str) -> DataFrame:
    """``(check, column_name, failures)`` of the corrected table, whose marts follow it row by row.

    Read from what its batches counted, each in the folders it rewrote; the table itself is not scanned.
    """
    kept = current_version(spark, checks_path(table))
    if kept is None:
        raise ValueError(f"{table} has no stored checks; its next batch makes them")
    return checks_of_state(spark.read.parquet(kept), NOT_NULL_COLUMNS[CHECKED], CHECKED)


def _drop_stale(spark: SparkSession, staging: str, batch_id: int) -> None:
    """Remove the staging copy of the batch before, which has been committed."""
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{staging.rstrip('/')}/batch_id={batch_id - 1}")
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def follow_corrections(
    spark: SparkSession, raw_dir: str, table: str, checkpoint: str | None = None, multi_line: bool = True, **options
) -> None:
    """Keep ``table`` current from bar files, later versions of a bar replacing earlier ones."""
    place = checkpoint or checkpoint_for(spark, "correct_bars", table)
    # Beside the offsets it belongs to: a fresh checkpoint never meets an old staging copy.
    staging = f"{place}/staged"
    documents = stream_documents(spark, source_path(raw_dir, "stocks"), multi_line, **options)
    _correct(documents, table, staging, place)


def follow_rewritten_files(spark: SparkSession, raw_dir: str, packed: str, table: str, checkpoint: str | None = None, **options) -> dict:
    """Keep ``table`` current from bar files that may be overwritten under their names.

    New and rewritten files are packed first (:func:`~tickloom.sources.packing.pack_files`, below
    ``packed``), and the table follows the packed documents. Of versions with one stamp that of the
    file written last wins. A bar that a rewritten file no longer holds stays in the table. Returns the
    counts of the packing.
    """
    folder = source_path(packed, "stocks")
    facts = pack_files(spark, source_path(raw_dir, "stocks"), folder)
    if facts["batch"]:
        place = checkpoint or checkpoint_for(spark, "correct_packed", table)
        documents = stream_packed_documents(spark, folder, schemas.BAR_DOCUMENT, **options)
        _correct(documents, table, f"{place}/staged", place)
    return facts


def _correct(documents: DataFrame, table: str, staging: str, checkpoint: str) -> None:
    query = (
        accepted(parse_daily_bars(documents))
        .writeStream.foreachBatch(lambda batch, batch_id: apply_corrections(batch, batch_id, table, staging))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
