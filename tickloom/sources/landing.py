"""Landing raw documents: stamps, skip-if-landed, partitioned landing, ingest summary.

A landed document is its JSON text beside its key, so fields no schema declares stay in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.functions import run_date_text
from tickloom.sources.documents import documents_from_text
from tickloom.sources.frames import empty_like, present_paths

DOCUMENT_KEYS = ("source", "ticker", "date")
LAYOUTS = ("compact", "ymd")

# What names a landed document of each source: its ticker field and its day field.
LANDING_KEYS = {
    "stocks": ("_ticker", "_ingested_at"),
    "polygon": ("_ticker", "_trading_date"),
    "github": ("ticker", "date"),
}


def with_ingest_meta(df: DataFrame, run_date: dt.date | str, ticker: str = "ticker", trading_date: str | None = None):
    """Stamp ``_ingested_at`` and ``_ticker``, and ``_trading_date`` where the feed has one."""
    stamped = df.withColumns({"_ingested_at": F.lit(str(run_date)), "_ticker": F.col(ticker)})
    if trading_date is None:
        return stamped
    return stamped.withColumn("_trading_date", run_date_text(F.col(trading_date)))


def stamped_text(payload: Column, **meta: Column) -> Column:
    """JSON object text ``payload`` on one line with fields ``meta`` after its own.

    Readers take the last of two equal names, so the stamps win over fields of the same name.
    NULL when ``payload`` does not begin and end like an object. The payload is not parsed or
    rewritten: a line break in JSON text is white space (inside strings it is escaped), so a space
    can stand for it. One closing brace goes and one comes, so an object that was cut off stays
    incomplete, which shows when it is read.
    """
    stamps = F.regexp_replace(F.to_json(F.struct(*[value.alias(name) for name, value in meta.items()])), r"^\{", "")
    own = F.regexp_replace(F.regexp_replace(payload, r"[\r\n]+", " "), r"\s*\}\s*$", "")
    comma = F.when(own.rlike(r"^\s*\{\s*$"), "").otherwise(",")
    return F.when(payload.rlike(r"^\s*\{[\s\S]*\}\s*$"), F.concat(own, comma, stamps))


def only_new(batch: DataFrame, landed: DataFrame, keys=DOCUMENT_KEYS) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``landed``.

    ``landed`` is cut to its distinct keys before the shuffle, so a key landed many times
    costs one row. A hot key in ``batch`` is split by AQE's skew-join handling.
    """
    keys = list(keys)
    return batch.join(landed.select(keys).distinct(), keys, "left_anti")


def _day_parts(day: Column, layout: str) -> dict[str, Column]:
    if layout == "compact":
        return {"dt": run_date_text(day)}
    if layout == "ymd":
        return {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")


def day_folder(root: str, source: str, day: dt.date | str | None = None, layout: str = "compact") -> str:
    """Folder of one source, or of one of its days."""
    folder = f"{root.rstrip('/')}/source={source}"
    if day is None:
        return folder
    if layout == "compact":
        return f"{folder}/dt={day}"
    year, month, dom = str(day).split("-")
    return f"{folder}/year={year}/month={month}/day={dom}"


def land_raw(documents: DataFrame, root: str, source: str, batch_id: str, layout: str = "compact") -> None:
    """Append ``(ticker, document, landing_date)`` as Parquet below ``root`` by source, day and batch.

    Nothing landed is ever replaced: a batch that is run again adds what it has not landed yet, as
    the check against landed keys decides, and a write that failed leaves no file. A document
    landed twice all the same is resolved by row when read, the later batch winning.

    One file per (source, ticker, day) would leave thousands of tiny files a day; the
    rebalance step instead packs a day into files of the advisory size and splits a large one.
    """
    parts = {"source": F.lit(source), **_day_parts(F.col("landing_date"), layout), "batch": F.lit(batch_id)}
    (
        documents.select("ticker", "document", *[value.alias(name) for name, value in parts.items()])
        .hint("rebalance", *parts)
        .write.mode("append")
        .partitionBy(*parts)
        .parquet(root)
    )


LANDED = StructType([StructField(name, StringType()) for name in ("ticker", "document")])


def scan_landed(
    spark: SparkSession, root: str, source: str, day: dt.date | str | None = None, layout: str = "compact"
) -> DataFrame:
    """Landed ``ticker`` and ``document`` with ``_file_path``; only one day's folder if given."""
    landed = _landed_columns(spark, LANDED, root, source, day, layout)
    there = present_paths(spark, day_folder(root, source, day, layout))
    return landed.withColumn("_file_path", F.col("_metadata.file_path") if there else F.lit(None).cast("string"))


def landed_tickers(
    spark: SparkSession, root: str, source: str, day: dt.date | str | None = None, layout: str = "compact"
) -> DataFrame:
    """Tickers that have a landed document. They stand beside it, so only they are read."""
    return _landed_columns(spark, StructType(LANDED.fields[:1]), root, source, day, layout)


def _landed_columns(spark: SparkSession, columns: StructType, root: str, source: str, day, layout: str) -> DataFrame:
    folder = present_paths(spark, day_folder(root, source, day, layout))
    if not folder:
        return empty_like(spark, columns)
    return spark.read.schema(columns).option("recursiveFileLookup", True).parquet(*folder)


def read_landed(
    spark: SparkSession, root: str, source: str, schema: StructType, day: dt.date | str | None = None, layout: str = "compact"
) -> DataFrame:
    """All landed documents of one source, parsed. Their rows carry what
    :func:`~tickloom.operators.dedup.latest_per_key` needs: the stamp, and a path that sorts by
    batch name (timestamps sort in order of time)."""
    return documents_from_text(scan_landed(spark, root, source, day, layout), "document", schema, "_file_path")


def ingest_summary(audit: DataFrame) -> DataFrame:
    """Per source: documents stored, skipped and failed, from ``(source, status)`` rows."""
    status = F.col("status")
    return audit.groupBy("source").agg(
        F.count_if(status == "success").alias("success_count"),
        F.count_if(status == "skipped").alias("skip_count"),
        F.count_if(status == "error").alias("error_count"),
    )
