"""Vendor documents to typed rows, on the executors.

Three steps, each a plain DataFrame transformation:

* ``scan_*`` reads JSON files (or ``documents_from_text`` a text column) under a declared schema;
* ``parse_*`` explodes and types them, adding ``row_problem`` (NULL for a good row);
* :func:`accepted` and :func:`rejected` split on it, so a bad value costs its own row only.

``read_*`` is scan + parse + accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom import schemas
from tickloom.functions import default0, is_malformed, parse_date, to_count, to_number
from tickloom.sources.frames import empty_like, present_paths

OK, EMPTY = "ok", "empty"
FILE_PATTERN = "*.json"


# --- scanning ----------------------------------------------------------------------------


def scan_documents(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    multi_line: bool = True,
    pattern: str = FILE_PATTERN,
) -> DataFrame:
    """One row per JSON document below ``paths``, with ``_file_path``.

    ``multi_line=True`` is the vendor layout (one pretty-printed document per file).
    ``multi_line=False`` reads JSON lines, which Spark can split. Missing paths give an empty
    frame of the same schema.
    """
    roots = present_paths(spark, paths)
    if not roots:
        return empty_like(spark, StructType(schema.fields)).withColumn("_file_path", F.lit(None).cast("string"))
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .json(roots)
        .withColumn("_file_path", F.col("_metadata.file_path"))
    )


def documents_from_text(df: DataFrame, text: str, schema: StructType, *keep: str) -> DataFrame:
    """One row per JSON text in column ``text``, shaped like :func:`scan_documents`.

    Columns ``keep`` stay beside the document. The parse is the input of a generator: as a
    plain projection the optimizer would copy it into every later expression that mentions a
    field, and parse the text once for each.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    document = F.inline(F.array(F.from_json(F.col(text), schema, options)))
    documents = df.select(*keep, document)
    return documents if "_file_path" in keep else documents.withColumn("_file_path", F.lit(None).cast("string"))


# --- validity ----------------------------------------------------------------------------


def has_key(name: str) -> Column:
    """Whether a document has field ``name`` (a JSON null counts as absent)."""
    return F.col(f"`{name}`").isNotNull()


def _bar_status() -> Column:
    series = F.col(f"`{schemas.SERIES_FIELD}`")
    return (
        F.when(has_key("_corrupt_record") & series.isNull(), "malformed")
        .when(has_key("Error Message"), "error")
        .when(has_key("Note"), "rate_limited")
        .when(series.isNull(), "no_series")
        .when(F.size(series) == 0, EMPTY)
        .otherwise(OK)
    )


def _aggregate_status() -> Column:
    return (
        F.when(has_key("_corrupt_record") & F.col("results").isNull(), "malformed")
        .when(F.col("status") == "ERROR", "error")
        # More results announced than given: to be fetched again, unlike a day without trades.
        .when(F.coalesce(F.col("resultsCount").cast("string").try_cast("bigint"), F.lit(0)) > F.coalesce(F.size("results"), F.lit(0)), "incomplete")
        .when(F.coalesce(F.size("results"), F.lit(0)) <= 0, EMPTY)
        .otherwise(OK)
    )


def _activity_status() -> Column:
    return F.when(has_key("_corrupt_record"), "malformed").otherwise(OK)


_STATUS = {"stocks": _bar_status, "polygon": _aggregate_status, "github": _activity_status}
SOURCES = tuple(_STATUS)


def classify_payload(documents: DataFrame, source: str) -> DataFrame:
    """Add ``payload_status``: ok, empty, error, rate_limited, no_series, incomplete or malformed."""
    return documents.withColumn("payload_status", _STATUS[source]())


def landable(documents: DataFrame, source: str) -> DataFrame:
    """Documents whose key may be marked as landed. The others are to be fetched again."""
    classified = classify_payload(documents, source)
    return classified.where(F.col("payload_status").isin(OK, EMPTY)).drop("payload_status")


# --- parsing -----------------------------------------------------------------------------


def _row_problem(status: Column, ticker: Column, date: Column, bad_number: Column) -> Column:
    return (
        F.when(status != OK, status)
        .when(F.coalesce(F.trim(ticker), F.lit("")) == "", "no_ticker")
        .when(date.isNull(), "bad_date")
        .when(bad_number, "bad_number")
        .alias("row_problem")
    )


def explode_series(documents: DataFrame, series: str = schemas.SERIES_FIELD) -> DataFrame:
    """One row per entry of the date-keyed map ``series``, as ``_day`` and ``_bar``.

    A document without entries keeps one row with NULLs, so it can be reported.
    """
    return documents.select("*", F.explode_outer(F.col(f"`{series}`")).alias("_day", "_bar")).drop(series)


def explode_results(documents: DataFrame, results: str = "results") -> DataFrame:
    """One row per element of the array ``results``, as ``_result`` (NULL for an empty one)."""
    return documents.select("*", F.explode_outer(results).alias("_result")).drop(results)


def _typed_rows(
    rows: DataFrame, ticker: str, day: str, raw: Column, fields: dict[str, str], convert, strict_nulls: bool
) -> DataFrame:
    """Key, typed values, version columns and ``row_problem`` of rows with a ``payload_status``.

    ``fields`` maps a value to its text field in struct ``raw``, ``convert(name, text)`` types
    it. The conversions are the input of a generator, so each text is converted once; in a
    projection the optimizer would repeat them for ``row_problem`` and for filters on it.
    """
    typed = [convert(name, F.col("_raw").getField(field)).alias(name) for name, field in fields.items()]
    once = rows.select(F.col(ticker).alias("ticker"), F.col(day).alias("_day"), "payload_status", *schemas.VERSION, raw.alias("_raw"))
    once = once.select("*", F.inline(F.array(F.struct(parse_date(F.col("_day")).alias("date"), *typed))))
    bad = F.lit(False)
    for name, field in fields.items():
        bad = bad | is_malformed(F.col("_raw").getField(field), F.col(name))
    values = [F.col(name) if strict_nulls else default0(F.col(name)).alias(name) for name in fields]
    problem = _row_problem(F.col("payload_status"), F.col("ticker"), F.col("date"), bad)
    return once.select("ticker", "date", *values, *schemas.VERSION, problem)


def parse_daily_bars(documents: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """``BARS`` columns, version columns and ``row_problem``, one row per bar."""
    rows = explode_series(classify_payload(documents, "stocks"))

    def convert(name: str, text: Column) -> Column:
        return to_number(text, "bigint" if name == "volume" else "double")

    return _typed_rows(rows, "_ticker", "_day", F.col("_bar"), schemas.BAR_FIELDS, convert, strict_nulls)


def parse_daily_aggregates(documents: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """``AGGREGATES`` columns, version columns and ``row_problem``, one row per result."""
    rows = explode_results(classify_payload(documents, "polygon"))

    def convert(name: str, text: Column) -> Column:
        return to_count(text) if name == "transactions" else to_number(text)

    return _typed_rows(
        rows, "_ticker", "_trading_date", F.col("_result"), schemas.AGGREGATE_FIELDS, convert, strict_nulls
    )


def parse_activity(documents: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """``ACTIVITY`` columns, version columns and ``row_problem``, one row per document."""
    fields = {name: name for name in schemas.ACTIVITY_FIELDS}
    return _typed_rows(
        classify_payload(documents, "github"), "ticker", "date", F.struct(*fields), fields, lambda _, text: to_count(text), strict_nulls
    )


def parse_repo_details(documents: DataFrame) -> DataFrame:
    """One row per repository in the nested ``repo_details`` of activity documents."""
    details = documents.select("ticker", parse_date(F.col("date")).alias("date"), F.explode("repo_details").alias("d"))
    counts = [default0(to_count(F.col(f"d.{name}"))).alias(name) for name in schemas.REPO_DETAIL_FIELDS]
    return details.select("ticker", "date", F.col("d.repo").alias("repo"), *counts)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("row_problem").isNull()).drop("row_problem")


def rejected(parsed: DataFrame) -> DataFrame:
    """Rows for quarantine. A document that is validly empty is neither accepted nor rejected."""
    return parsed.where(F.col("row_problem").isNotNull() & (F.col("row_problem") != EMPTY))


# --- directory readers -------------------------------------------------------------------

_FEEDS = {
    "stocks": (schemas.BAR_DOCUMENT, parse_daily_bars),
    "polygon": (schemas.AGGREGATE_DOCUMENT, parse_daily_aggregates),
    "github": (schemas.ACTIVITY_DOCUMENT, parse_activity),
}


DOCUMENT_SCHEMAS = {source: schema for source, (schema, _) in _FEEDS.items()}
PARSERS = {source: parse for source, (_, parse) in _FEEDS.items()}


def source_path(raw_dir: str, source: str) -> str:
    return f"{raw_dir.rstrip('/')}/{source}"


def read_parsed(
    spark: SparkSession, raw_dir: str, source: str, strict_nulls: bool = False, multi_line: bool = True
) -> DataFrame:
    """All rows of one source, good and bad, with ``row_problem``."""
    schema, parse = _FEEDS[source]
    return parse(scan_documents(spark, source_path(raw_dir, source), schema, multi_line), strict_nulls)


def read_daily_bars(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return accepted(read_parsed(spark, raw_dir, "stocks", **options))


def read_daily_aggregates(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return accepted(read_parsed(spark, raw_dir, "polygon", **options))


def read_activity(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return accepted(read_parsed(spark, raw_dir, "github", **options))


def read_repo_details(spark: SparkSession, raw_dir: str, multi_line: bool = True) -> DataFrame:
    return parse_repo_details(
        scan_documents(spark, source_path(raw_dir, "github"), schemas.ACTIVITY_DOCUMENT, multi_line)
    )
