"""The given star-schema tables seen as the three daily feeds.

Functions take the tables they use, so a query that needs three feeds of ``events`` lists its
files once.

``orders`` become bars per market segment; ``events`` become bars, trade aggregates and
developer activity per user, or repository facts of the tracked companies. Each feed reads
only the columns it uses and groups straight to its key, so the shuffle carries one row per
key and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import round4, run_date_text
from tickloom.sources.companies import COMPANY_ROWS
from tickloom.sources.documents import documents_from_text


# Declared, so that no job has to read footers before a query is planned.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ohlc(price: str, order: str) -> list[Column]:
    return [
        F.min_by(price, order).alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max_by(price, order).alias("close_price"),
        F.count(F.lit(1)).alias("volume"),
    ]


def segment_bars(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Daily bars of order totals per market segment: few tickers, years of history."""
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    key = [F.col("c_mktsegment").alias("ticker"), F.col("o_orderdate").cast("date").alias("date")]
    return joined.groupBy(*key).agg(*_ohlc("o_totalprice", "o_orderkey"))


def user_key() -> list[Column]:
    return [F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"), F.col("ts").cast("date").alias("date")]


def user_bars(events: DataFrame) -> DataFrame:
    """Daily bars of event values per user: many tickers, one month."""
    return events.groupBy(*user_key()).agg(*_ohlc("value", "event_id"))


def user_aggregates(events: DataFrame) -> DataFrame:
    """Daily trade aggregates from purchases; many bars have none."""
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    count = F.count(F.lit(1))
    return (
        events
        .where(F.col("event_type") == "purchase")
        .groupBy(*user_key())
        .agg(
            F.min_by("value", "event_id").alias("poly_open"),
            F.max("value").alias("poly_high"),
            F.min("value").alias("poly_low"),
            F.max_by("value", "event_id").alias("poly_close"),
            count.cast("double").alias("poly_volume"),
            round4(cents.cast("double") / 100 / count).alias("vwap"),
            count.alias("transactions"),
        )
    )


def user_activity(events: DataFrame) -> DataFrame:
    """Daily activity: clicks as commits, signups as pull requests, views as stars."""
    kind = F.col("event_type")
    counted = ("click", "signup", "view")
    clicks, signups, views = (F.count_if(kind == k) for k in counted)
    kinds_seen = sum((F.max((kind == k).cast("bigint")) for k in counted), F.lit(0))
    return (
        events
        .where(kind.isin(*counted))
        .groupBy(*user_key())
        .agg(
            clicks.alias("total_commits_today"),
            signups.alias("total_open_prs"),
            views.alias("total_stars"),
            (views * 2).alias("total_forks"),
            kinds_seen.cast("bigint").alias("repos_tracked"),
        )
    )


def bar_snapshots(events: DataFrame) -> DataFrame:
    """Three overlapping downloads of every user bar, later ones with a revised close."""
    return (
        user_bars(events)
        .withColumn("snapshot", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .withColumn("close_price", F.col("close_price") + F.col("snapshot"))
    )


# --- repository facts of the tracked companies --------------------------------------------


def repo_events(events: DataFrame, event_type: str) -> DataFrame:
    """Events of one type as ``(ticker, repo, date, ts)`` of the tracked companies.

    A user id picks a company (id modulo 5) and one of its repositories (modulo 15).
    """
    n = len(COMPANY_ROWS)
    slot = (F.col("user_id") % 15).cast("int")
    tickers = F.array(*[F.lit(ticker) for ticker, _, _ in COMPANY_ROWS])
    repos = F.array(*[F.lit(repos[i]) for i in range(3) for _, _, repos in COMPANY_ROWS])
    return (
        events
        .where(F.col("event_type") == event_type)
        .select(
            F.element_at(tickers, slot % n + 1).alias("ticker"),
            F.element_at(repos, slot + 1).alias("repo"),
            F.col("ts").cast("date").alias("date"),
            "ts",
        )
    )


def pull_requests(orders: DataFrame) -> DataFrame:
    """Orders as pull requests: ``(repo, state)`` by customer and order status."""
    return orders.select(
        F.concat(F.lit("R"), (F.col("o_custkey") % 15).cast("string")).alias("repo"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
    )


# --- feeds as vendor documents -------------------------------------------------------------


def bar_values(bars: DataFrame, **overrides: Column) -> Column:
    """The values of one bar as the vendor names and writes them (text)."""
    values = {name: F.col(name).cast("string") for name in schemas.BAR_VALUES} | overrides
    return F.struct(*[values[name].alias(field) for name, field in schemas.BAR_FIELDS.items()])


def bars_as_monthly_documents(bars: DataFrame) -> DataFrame:
    """One date-keyed JSON document per ticker and month (at most 31 bars each)."""
    entry = F.struct(run_date_text(F.col("date")).alias("key"), bar_values(bars).alias("value"))
    series = F.map_from_entries(F.collect_list(entry))
    text = F.to_json(F.struct(F.col("ticker").alias("_ticker"), F.col("series").alias(schemas.SERIES_FIELD)))
    return bars.groupBy("ticker", F.trunc("date", "month").alias("month")).agg(series.alias("series")).select(text.alias("value"))


def bars_as_documents(
    bars: DataFrame, ticker: Column | None = None, day: Column | None = None, **overrides: Column
) -> DataFrame:
    """One JSON document per bar. A value that is NULL is left out, as a missing key."""
    ticker = F.col("ticker") if ticker is None else ticker
    day = run_date_text(F.col("date")) if day is None else day
    series = F.create_map(day, bar_values(bars, **overrides)).alias(schemas.SERIES_FIELD)
    return bars.select(F.to_json(F.struct(ticker.alias("_ticker"), series)).alias("value"))


def aggregates_as_documents(aggregates: DataFrame) -> DataFrame:
    """One JSON document per ticker and day with its result in an array."""
    result = F.struct(*[F.col(name).alias(field) for name, field in schemas.AGGREGATE_FIELDS.items()])
    document = F.struct(
        F.col("ticker").alias("_ticker"),
        run_date_text(F.col("date")).alias("_trading_date"),
        F.lit("OK").alias("status"),
        F.lit(1).alias("resultsCount"),
        F.array(result).alias("results"),
    )
    return aggregates.select(F.to_json(document).alias("value"))


def activity_as_documents(activity: DataFrame) -> DataFrame:
    """One flat JSON document per ticker and day."""
    document = F.struct("ticker", run_date_text(F.col("date")).alias("date"), *schemas.ACTIVITY_FIELDS)
    return activity.select(F.to_json(document).alias("value"))


def response_text() -> Column:
    """An event as the text of a bar response: refused, throttled, without a series, or good."""
    kind = F.col("event_type")
    bar = F.struct(F.col("value").cast("string").alias(schemas.BAR_FIELDS["close_price"]))
    return F.to_json(
        F.struct(
            F.when(kind.isin("click", "purchase"), F.create_map(run_date_text(F.col("ts")), bar)).alias(schemas.SERIES_FIELD),
            F.when(kind == "error", "unknown symbol").alias("Error Message"),
            F.when(kind == "view", "call limit reached").alias("Note"),
        )
    )


def aggregate_response_text() -> Column:
    """An event as the text of an aggregate response: refused, cut off, short of its result, empty, or good."""
    kind = F.col("event_type")
    result = F.struct(F.col("value").alias(schemas.AGGREGATE_FIELDS["vwap"]))
    text = F.to_json(
        F.struct(
            F.when(kind == "error", "ERROR").otherwise("OK").alias("status"),
            F.when(kind == "error", "unknown symbol").alias("error"),
            F.when(kind == "signup", 0).otherwise(1).alias("resultsCount"),
            F.when(kind.isin("click", "purchase"), F.array(result)).alias("results"),
        )
    )
    return F.when(kind == "click", F.substring(text, 1, 12)).otherwise(text)


def activity_response_text() -> Column:
    """An event as the text of an activity document; errors are cut off."""
    key = F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker")
    text = F.to_json(F.struct(key, run_date_text(F.col("ts")).alias("date")))
    return F.when(F.col("event_type") == "error", F.substring(text, 1, 12)).otherwise(text)


def event_responses(events: DataFrame) -> DataFrame:
    """Every event as a parsed bar response."""
    text = events.select("event_id", "event_type", response_text().alias("value"))
    return documents_from_text(text, "value", schemas.BAR_DOCUMENT, "event_id", "event_type")
