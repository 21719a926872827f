"""The two jobs: raw documents to the combined dataset, and combined dataset to marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.combine import combine, with_processed_at
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.quality import assert_quality, check_marts, with_comments
from tickloom.operators.reads import preview
from tickloom.plans.counts import observed
from tickloom.plans.models import (
    company_daily,
    mart_github_correlation,
    mart_stock_performance,
    stg_github_activity,
    stg_polygon_trades,
    stg_stock_prices,
)
from tickloom.sinks import register_views, write_combined
from tickloom.sinks.runs import POINTER, new_run, publish_run, run_rows, store_run, stored_layout
from tickloom.sources.documents import (
    DOCUMENT_SCHEMAS,
    PARSERS,
    SOURCES,
    accepted,
    read_parsed,
    rejected,
    source_path,
)
from tickloom.sources.frames import present_paths, require_rows, union_all
from tickloom.sources.landing import day_folder, read_landed
from tickloom.sources.packing import pack_files, read_packed_documents
from tickloom.sources.tables import read_combined


def build_combined(parsed: dict[str, DataFrame]) -> DataFrame:
    """Newest version of every key of each source, joined, with daily returns."""
    latest = {source: latest_per_key(accepted(frame)) for source, frame in parsed.items()}
    return combine(latest["stocks"], latest.get("polygon"), latest.get("github"))


LAYOUTS = ("files", "lines", "landed", "packed")


def source_folder(raw_dir: str, source: str, layout: str) -> str:
    return day_folder(raw_dir, source) if layout == "landed" else source_path(raw_dir, source)


def parsed_source(
    spark: SparkSession, raw_dir: str, source: str, layout: str = "files", strict_nulls: bool = False
) -> DataFrame:
    """All rows of one source with ``row_problem``.

    ``layout`` is how ``raw_dir`` holds documents: one per file (``files``), JSON lines
    (``lines``), as :func:`~tickloom.plans.ingest.run_ingestion` left them (``landed``), or packed by
    :func:`pack_sources` (``packed``).
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    if layout == "landed":
        return PARSERS[source](read_landed(spark, raw_dir, source, DOCUMENT_SCHEMAS[source]), strict_nulls)
    if layout == "packed":
        documents = read_packed_documents(spark, source_path(raw_dir, source), DOCUMENT_SCHEMAS[source])
        return PARSERS[source](documents, strict_nulls)
    return read_parsed(spark, raw_dir, source, strict_nulls, multi_line=layout == "files")


def pack_sources(spark: SparkSession, raw_dir: str, packed_dir: str) -> dict[str, dict]:
    """Pack what is new or rewritten in every source's folder of one-document files; counts by source."""
    return {source: pack_files(spark, source_path(raw_dir, source), source_path(packed_dir, source)) for source in SOURCES}


def run_processing(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    run_ts: dt.datetime | None = None,
    layout: str = "files",
    strict_nulls: bool = False,
    quarantine: str | None = None,
) -> dict[str, dict]:
    """Read the three sources, combine them and write the next version of ``out_dir``/combined in one pass.

    Bars are required; the other sources may be missing. The combined dataset stays as it is when
    bars are missing, or when the job fails at any point. Returns row counts of the result, from the
    files it committed, and per source, observed in that same pass (for the log: a task run again
    after a lost executor may be counted again).

    With ``quarantine`` the refused rows go to that folder. Each source is still parsed once: its
    typed rows, good and bad, are written to ``out_dir``/parsed and both results read from there;
    then the counts per source come from these files too.
    """
    parsed, seen, counts = {}, {}, {}
    for source in SOURCES:
        required = source == "stocks"
        if not required and not present_paths(spark, source_folder(raw_dir, source, layout)):
            continue
        frame = parsed_source(spark, raw_dir, source, layout, strict_nulls)
        if quarantine:
            path = f"{out_dir.rstrip('/')}/parsed/{source}"
            frame.write.mode("overwrite").parquet(path)
            frame = counted = spark.read.schema(frame.schema).parquet(path)
            counts[source] = frame.agg(*_source_counts()).first().asDict()
        else:
            seen[source] = (Observation(source), frame)
            counted = frame.observe(seen[source][0], *_source_counts())
        if required:
            require_rows(accepted(frame), source)
        parsed[source] = counted
    result = write_combined(with_processed_at(build_combined(parsed), run_ts), combined_path(out_dir))
    if quarantine:
        write_refused(parsed, quarantine)
    counts |= {source: observed(*pair, _source_counts()) for source, pair in seen.items()}
    return {**counts, "combined": result}


def _source_counts() -> list[Column]:
    not_accepted = F.count_if(F.col("row_problem").isNotNull())
    return [F.count(F.lit(1)).alias("rows"), not_accepted.alias("not_accepted")]


def combined_path(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/combined"


def write_refused(parsed: dict[str, DataFrame], path: str) -> None:
    """Write what the sources' parsers refused, by source and problem, for a closer look."""
    columns = ("ticker", "date", "_ingested_at", "_file_path", "row_problem")
    bad = [rejected(rows).select(F.lit(source).alias("source"), *columns) for source, rows in parsed.items()]
    union_all(bad).write.mode("overwrite").partitionBy("source", "row_problem").parquet(path)


def write_quarantine(spark: SparkSession, raw_dir: str, path: str, layout: str = "files") -> None:
    """The refused rows alone, without processing the others."""
    write_refused({source: parsed_source(spark, raw_dir, source, layout) for source in SOURCES}, path)


def sample(spark: SparkSession, out_dir: str, n: int = 10) -> DataFrame:
    """First rows of the written dataset."""
    return preview(read_combined(spark, combined_path(out_dir)), n)


def run_models(combined: DataFrame, unique_key: bool = True, threshold: int = 10) -> dict[str, DataFrame]:
    """All models over the combined table, as lazy frames by name."""
    daily = company_daily(combined, unique_key)
    return {
        "stg_stock_prices": stg_stock_prices(combined),
        "stg_polygon_trades": stg_polygon_trades(combined),
        "stg_github_activity": stg_github_activity(combined),
        "int_company_daily": daily,
        "mart_stock_performance": with_comments(mart_stock_performance(daily)),
        "mart_github_correlation": with_comments(mart_github_correlation(daily, threshold)),
    }


MARTS = ("mart_stock_performance", "mart_github_correlation")


def publish_models(
    spark: SparkSession,
    out_dir: str,
    raw_table: str = "raw_combined",
    unique_key: bool = True,
    pointer: str = POINTER,
    prefix: str = "",
    buckets: int | None = None,
    threshold: int = 10,
    location: str | None = None,
) -> str:
    """Publish ``raw_combined`` and the marts of the combined dataset as one run; returns its name.

    The run's rows are written once, where no reader sees them, checked there, and then all names turn
    to them in one step (see :mod:`tickloom.sinks.runs`). A failure before that, of a write or a
    check, leaves every name at the run before. Staging and intermediate views follow ``raw_combined``.
    ``prefix`` goes before all names but ``raw_table`` and ``pointer``; ``location`` is the folder of new
    tables, by default the warehouse.
    """
    run = new_run()
    store_run(read_combined(spark, combined_path(out_dir)), raw_table, run, buckets, location)
    raw = run_rows(spark, raw_table, run)
    with stored_layout(spark):
        models = run_models(raw, unique_key, threshold)
        for name in MARTS:
            store_run(models[name], f"{prefix}{name}", run, buckets, location)
        assert_quality(check_marts({name: run_rows(spark, f"{prefix}{name}", run) for name in MARTS}))
    publish_run(spark, run, {raw_table: raw, **{f"{prefix}{name}": models[name] for name in MARTS}}, pointer)
    shown = run_models(spark.table(raw_table), unique_key, threshold)
    register_views({f"{prefix}{name}": frame for name, frame in shown.items() if name not in MARTS})
    return run
