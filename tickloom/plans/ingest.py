"""Landing one batch of vendor responses: skip what is landed, refuse what is no data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.plans.counts import observed
from tickloom.sources.documents import DOCUMENT_SCHEMAS, EMPTY, OK, classify_payload, documents_from_text
from tickloom.sources.landing import LANDING_KEYS, land_raw, landed_tickers, stamped_text

OUTCOMES = ("success_count", "skip_count", "error_count")


def audit_responses(
    responses: DataFrame, landed: DataFrame, source: str, day: dt.date | str, run_date: dt.date | str
) -> DataFrame:
    """One row per ticker among the ``(ticker, payload)`` responses of one day.

    ``landed`` holds the tickers that have a document of that day. ``document`` is the stamped
    payload to store (of several good ones the greatest text), NULL if there is none; the three
    counts say how many of the ticker's responses were stored, skipped (landed before, or the
    batch holds a good one already) and refused (an error, a throttling note, no series, no JSON
    object, an activity document of another ticker). Responses of landed tickers are counted
    without being parsed.
    """
    ticker_field, day_field = LANDING_KEYS[source]
    stamps = {"_ingested_at": F.lit(str(run_date))}
    if source != "github":  # activity documents carry their key themselves
        stamps |= {ticker_field: F.col("_key"), day_field: F.lit(str(day))}
    known = landed.select(F.col("ticker").alias("_key")).distinct().withColumn("_known", F.lit(True))
    marked = responses.select(F.col("ticker").alias("_key"), "payload").join(known, "_key", "left")
    text = stamped_text(F.when(F.col("_known").isNull(), F.col("payload")), **stamps)
    stamped = marked.select("_key", "_known", text.alias("document"))
    parsed = documents_from_text(stamped, "document", DOCUMENT_SCHEMAS[source], "_key", "_known", "document")
    usable = F.col("document").isNotNull() & F.col("payload_status").isin(OK, EMPTY)
    if source == "github":
        usable = usable & F.col(ticker_field).eqNullSafe(F.col("_key"))
    is_known = F.col("_known").isNotNull()
    per_key = (
        classify_payload(parsed, source)
        .groupBy("_key")
        .agg(
            F.max(F.when(usable, F.col("document"))).alias("document"),
            F.count_if(usable).alias("good"),
            F.count_if(is_known).alias("skipped"),
            F.count_if(~usable & ~is_known).alias("bad"),
        )
    )
    good = F.col("good")
    return per_key.select(
        F.col("_key").alias("ticker"),
        "document",
        F.least(good, F.lit(1)).cast("bigint").alias("success_count"),
        (F.col("skipped") + F.greatest(good - 1, F.lit(0))).cast("bigint").alias("skip_count"),
        F.col("bad").cast("bigint").alias("error_count"),
    )


def _totals() -> list[Column]:
    return [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in OUTCOMES]


def run_ingestion(
    spark: SparkSession,
    responses: DataFrame,
    root: str,
    source: str,
    day: dt.date | str,
    run_date: dt.date | str | None = None,
    batch_id: str | None = None,
    layout: str = "compact",
) -> dict[str, int]:
    """Land the good and new documents among ``responses`` and count all of them by outcome.

    Of the landing only the keys of ``day`` are read. Running a batch again, whole, in part or
    after a failure, never loses what it landed before.
    """
    landed = landed_tickers(spark, root, source, day, layout)
    audit = audit_responses(responses, landed, source, day, run_date or day)
    seen = Observation(f"ingest_{source}")
    stored = audit.observe(seen, *_totals()).where(F.col("document").isNotNull())
    documents = stored.select("ticker", "document", F.lit(str(day)).cast("date").alias("landing_date"))
    land_raw(documents, root, source, batch_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f"), layout)
    return observed(seen, audit, _totals())
