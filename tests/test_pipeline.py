import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.test_sources import activity_document, bar, bar_document, write
from tickloom import schemas
from tickloom.plans.pipeline import MARTS, publish_models, run_models, run_processing, sample, write_quarantine
from tickloom.plans.pipeline import parsed_source as pipeline_parse
from tickloom.session import get_session, path_exists, shared_dir, shuffle_partitions_for
from tickloom.sinks import publish_table, register_views, write_combined
from tickloom.sinks.versions import current_version
from tickloom.sources.frames import MissingSourceError
from tickloom.sources.tables import read_combined, relation

RUN = dt.datetime(2026, 3, 18, 18, 0, tzinfo=dt.timezone.utc)


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    write(root / "stocks", "MSFT_a.json", bar_document("MSFT", {"2026-03-16": bar("400"), "2026-03-17": bar("404")}, "2026-03-17"))
    write(root / "stocks", "MSFT_b.json", bar_document(
        "MSFT", {"2026-03-16": bar("400"), "2026-03-17": bar("404"), "2026-03-18": bar("408")}, "2026-03-18"))
    write(root / "stocks", "007.json", bar_document("007", {"2026-03-17": bar("7"), "2026-13-01": bar("8")}))
    write(root / "stocks", "limit.json", {"_ticker": "AAPL", "Note": "limit"})
    write(root / "polygon", "1.json", {
        "_ticker": "MSFT", "_trading_date": "2026-03-17", "_ingested_at": "2026-03-18", "status": "OK", "resultsCount": 1,
        "results": [{"o": 1, "h": 2, "l": 1, "c": 2, "v": 10, "vw": 1.5, "n": 4}]})
    write(root / "github", "1.json", activity_document())
    return str(root)


def test_processing_end_to_end(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    counts = run_processing(spark, raw, out, RUN)
    assert counts["combined"] == {"rows": 4}
    assert counts["stocks"] == {"rows": 8, "not_accepted": 2}
    assert counts["polygon"]["rows"] == counts["github"]["rows"] == 1
    got = read_combined(spark, f"{out}/combined").orderBy("ticker", "date").collect()
    assert [(r.ticker, str(r.date), r.daily_return_pct, r.vwap, r.total_commits_today) for r in got] == [
        ("007", "2026-03-17", None, None, None),
        ("MSFT", "2026-03-16", None, None, None),
        ("MSFT", "2026-03-17", 1.0, 1.5, 12),
        ("MSFT", "2026-03-18", 0.9901, None, None),
    ]
    assert got[0].asDict().keys() == set(schemas.COMBINED.names)
    folder = current_version(spark, f"{out}/combined")
    assert sorted(d for d in os.listdir(folder) if d.startswith("ticker=")) == ["ticker=007", "ticker=MSFT"]
    files = [f for f in os.listdir(f"{folder}/ticker=MSFT") if f.endswith(".parquet")]
    assert len(files) == 1 and files[0].endswith(".snappy.parquet")
    assert sample(spark, out, 2).count() == 2


def test_processing_again_gives_the_same(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    rows = []
    for _ in range(2):
        run_processing(spark, raw, out, RUN)
        rows.append(sorted(map(tuple, read_combined(spark, f"{out}/combined").collect()), key=str))
    assert rows[0] == rows[1]


def test_optional_sources_may_be_missing(spark, tmp_path):
    root = tmp_path / "raw"
    write(root / "stocks", "A.json", bar_document("A", {"2026-03-16": bar()}))
    (root / "github").mkdir()
    counts = run_processing(spark, str(root), str(tmp_path / "out"), RUN)
    assert "polygon" not in counts and counts["github"]["rows"] == 0 and counts["combined"]["rows"] == 1
    write(root / "polygon", "1.json", {"_ticker": "A", "_trading_date": "2026-03-16", "status": "ERROR"})
    counts = run_processing(spark, str(root), str(tmp_path / "out"), RUN)
    assert counts["polygon"] == {"rows": 1, "not_accepted": 1} and counts["combined"]["rows"] == 1
    combined = read_combined(spark, str(tmp_path / "out" / "combined"))
    marts = run_models(combined)
    assert marts["mart_github_correlation"].first().developer_activity_score == 0
    assert marts["stg_polygon_trades"].isEmpty()


def test_required_source_is_checked_before_anything_is_overwritten(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    run_processing(spark, raw, out, RUN)
    with pytest.raises(MissingSourceError):
        run_processing(spark, str(tmp_path / "nowhere"), out, RUN)
    assert read_combined(spark, f"{out}/combined").count() == 4


def test_quarantine(spark, tmp_path, raw):
    path = str(tmp_path / "quarantine")
    write_quarantine(spark, raw, path)
    got = sorted((r.source, r.row_problem) for r in spark.read.parquet(path).collect())
    assert got == [("stocks", "bad_date"), ("stocks", "rate_limited")]


def test_quarantine_in_the_same_pass(spark, tmp_path, raw, monkeypatch):
    parsed = []

    def once(spark, raw_dir, source, *rest):
        parsed.append(source)
        return pipeline_parse(spark, raw_dir, source, *rest)

    monkeypatch.setattr("tickloom.plans.pipeline.parsed_source", once)
    out, path = str(tmp_path / "out"), str(tmp_path / "bad")
    counts = run_processing(spark, raw, out, RUN, quarantine=path)
    assert sorted(parsed) == ["github", "polygon", "stocks"]
    assert counts["stocks"] == {"rows": 8, "not_accepted": 2} and counts["combined"] == {"rows": 4}
    got = sorted((r.source, r.row_problem) for r in spark.read.parquet(path).collect())
    assert got == [("stocks", "bad_date"), ("stocks", "rate_limited")]
    with pytest.raises(MissingSourceError):
        run_processing(spark, str(tmp_path / "nowhere"), out, RUN, quarantine=path)
    assert read_combined(spark, f"{out}/combined").count() == 4


def test_publish_models(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    run_processing(spark, raw, out, RUN)
    for unique_key in (True, False):
        publish_models(spark, out, unique_key=unique_key)
        assert spark.table("raw_combined").count() == 4
        assert spark.table("int_company_daily").count() == 4
        assert {name: relation(spark, name).count() for name in MARTS} == dict.fromkeys(MARTS, 4)
    comments = {c.name: c.description for c in spark.catalog.listColumns("mart_stock_performance")}
    assert comments["moving_avg_7d"]
    row = spark.table("mart_stock_performance").where("ticker = 'MSFT' and date = '2026-03-18'").first()
    assert (row.moving_avg_7d, row.volatility_7d) == (404.0, 0.007)


def test_a_failing_check_leaves_the_published_marts(spark, tmp_path, raw, monkeypatch):
    out = str(tmp_path / "out")
    run_processing(spark, raw, out, RUN)
    publish_models(spark, out)
    before = {name: spark.table(name).count() for name in MARTS}

    def refuse(report):
        raise AssertionError("not good")

    monkeypatch.setattr("tickloom.plans.pipeline.assert_quality", refuse)
    run_processing(spark, raw, out, RUN, strict_nulls=True)
    with pytest.raises(AssertionError):
        publish_models(spark, out)
    assert {name: spark.table(name).count() for name in MARTS} == before


def test_published_tables_are_few_files(spark):
    rows = spark.range(200_000).repartition(64).select(F.concat(F.lit("T"), F.col("id") % 9).alias("ticker"), F.col("id"))
    publish_table(rows, "t_files")
    files = spark.table("t_files").inputFiles()
    assert len(files) <= 2
    assert spark.table("t_files").count() == 200_000


def test_publish_replaces_and_views_are_lazy(spark):
    publish_table(spark.range(3), "t_publish")
    publish_table(spark.range(5).withColumnRenamed("id", "x"), "t_publish")
    assert spark.table("t_publish").columns == ["x"] and spark.table("t_publish").count() == 5
    register_views({"v_publish": spark.table("t_publish").where("x > 3")})
    assert spark.table("v_publish").count() == 1


def test_write_combined_prunes_by_ticker(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    run_processing(spark, raw, out, RUN)
    df = read_combined(spark, f"{out}/combined").where("ticker = 'MSFT'")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan
    write_combined(read_combined(spark, f"{out}/combined"), str(tmp_path / "copy"))
    assert read_combined(spark, str(tmp_path / "copy")).count() == 4


def test_session_settings(spark, tmp_path):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"
    assert get_session() is spark
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "no"))
    assert shuffle_partitions_for(100 * 2**40, 4000) % 4000 == 0
    assert shuffle_partitions_for(1, 8) == 8
