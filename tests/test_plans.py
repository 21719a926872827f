"""The plans at scale: what is shuffled, pruned and pushed down, and what must never appear."""

import re

import pytest

import __spark_entry__ as entry_module
from tests.test_operators import D, activity, aggregates, bars
from tickloom import schemas
from tickloom.operators.combine import combine
from tickloom.operators.dedup import last_n_per_ticker, latest_per_key
from tickloom.operators.reads import price_trend
from tickloom.operators.windows import with_daily_return, with_rolling
from tickloom.plans.models import company_daily, mart_stock_performance
from tickloom.plans.pipeline import build_combined, parsed_source

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|SinglePartition)", plan(df))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_no_query_pairs_everything_or_leaves_the_jvm(spark, name):
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|ScalaUDF|SinglePartition.*Window", text)
    for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", text):
        assert "props" not in schema or name == "props_json_field"


def test_return_and_rolling_share_one_shuffle_and_one_sort(spark, no_broadcast):
    df = with_rolling(with_daily_return(bars(spark, [("A", D(2026, 3, 1), 1.0)])))
    assert len(shuffles(df)) == 1
    assert plan(df).count("+- Sort [") == 1


def versioned(spark):
    return spark.createDataFrame([], schemas.VERSIONED_BARS)


def test_deduplicated_sources_are_joined_without_another_shuffle(spark, no_broadcast):
    extra = {f: s for f, s in (("polygon", schemas.AGGREGATES), ("github", schemas.ACTIVITY))}
    rows = spark.range(10).selectExpr(
        "concat('T', id) ticker", "date_add(date'2026-03-01', cast(id as int)) date", "cast(id as string) _ingested_at", "'f' _file_path", "cast(null as string) row_problem")
    frames = {"stocks": rows.selectExpr("*", *[f"cast(1 as {'bigint' if c == 'volume' else 'double'}) {c}" for c in schemas.BAR_VALUES])}
    for source, schema in extra.items():
        frames[source] = rows.selectExpr("*", *[f"cast(1 as {f.dataType.simpleString()}) {f.name}" for f in schema if f.name not in ("ticker", "date")])
    combined = build_combined(frames)
    found = shuffles(combined)
    assert len(found) == 4  # one per source, and the ticker exchange of the return
    assert sum("date" in f for f in found) == 3
    stored = combined.repartition("ticker").sortWithinPartitions("ticker", "date")
    assert len(shuffles(stored)) == 4
    assert plan(stored).count("+- Sort [ticker") == plan(combined).count("+- Sort [ticker")


def test_copies_are_reduced_before_the_shuffle(spark):
    text = plan(latest_per_key(versioned(spark).union(versioned(spark))))
    assert text.index("Exchange hashpartitioning") < text.index("partial_max")
    text = plan(last_n_per_ticker(spark.read.schema(schemas.BARS).parquet("/root/testdata/sf0.001/orders.parquet"), 5))
    assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", text)


def test_marts_are_one_scan_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "combined")
    base = combine(bars(spark, [("A", D(2026, 3, 1), 1.0)]), aggregates(spark, [("A", D(2026, 3, 1), 1.0)]), activity(spark, []))
    base.write.partitionBy("ticker").parquet(path)
    raw = spark.read.schema(base.schema).parquet(path)
    mart = mart_stock_performance(company_daily(raw))
    assert plan(mart).count("FileScan") == 1 and len(shuffles(mart)) == 1
    assert "total_stars" not in plan(mart)
    one = plan(price_trend(mart, "A"))
    assert re.search(r"PartitionFilters: \[.*ticker.* = A", one)
    assert "IsNotNull(close_price)" in one


def test_filters_and_columns_reach_the_scan(spark):
    queries = entry_module.queries()
    text = plan(queries["only_new_documents"](spark, SF_DIR))
    assert "EqualTo(event_type,purchase)" in text
    assert "GreaterThanOrEqual(ts," in plan(queries["commits_since"](spark, SF_DIR))
    text = plan(queries["price_trend_one_ticker"](spark, SF_DIR))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "o_orderpriority" not in text and "o_orderstatus" not in text


def test_landed_documents_are_parsed_once(spark, tmp_path):
    folder = tmp_path / "source=stocks" / "dt=2026-03-16" / "batch=1"
    spark.createDataFrame([("A", '{"_ticker": "A"}')], "ticker string, document string").write.parquet(str(folder))
    text = plan(parsed_source(spark, str(tmp_path), "stocks", layout="landed"))
    assert text.count("from_json") == 1
