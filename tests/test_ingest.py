import json

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tests.test_operators import facts, march
from tests.test_sources import bar, landed_closes
from tickloom import schemas
from tickloom.operators.activity import activity_rollup, as_responses
from tickloom.plans.ingest import run_ingestion
from tickloom.plans.pipeline import combined_path, run_processing
from tickloom.sources.companies import companies
from tickloom.sources.documents import accepted, parse_activity, parse_daily_aggregates, parse_repo_details
from tickloom.sources.landing import landed_tickers, read_landed, scan_landed
from tickloom.sources.tables import read_combined

DAY = "2026-03-16"


def payload(close):
    return json.dumps({schemas.SERIES_FIELD: {DAY: bar(close)}}, indent=2)


NOTE = json.dumps({"Note": "call frequency"})


def responses(spark, rows):
    return spark.createDataFrame(rows, "ticker string, payload string")


def counts(success, skipped, errors):
    return {"success_count": success, "skip_count": skipped, "error_count": errors}


@pytest.mark.parametrize("layout", ["compact", "ymd"])
def test_second_run_skips_what_is_landed_and_retries_what_failed(spark, tmp_path, layout):
    root = str(tmp_path)
    first = responses(spark, [("A", payload("1")), ("B", NOTE), ("C", "<html>"), ("D", None)])
    assert run_ingestion(spark, first, root, "stocks", DAY, batch_id="1", layout=layout) == counts(1, 0, 3)
    second = responses(spark, [("A", payload("9")), ("B", payload("2")), ("C", json.dumps({"Error Message": "x"}))])
    assert run_ingestion(spark, second, root, "stocks", DAY, batch_id="2", layout=layout) == counts(1, 1, 1)
    assert landed_closes(spark, root) == [("A", DAY, 1.0), ("B", DAY, 2.0)]
    assert run_ingestion(spark, second.where("ticker = 'A'"), root, "stocks", DAY, batch_id="3", layout=layout) == counts(0, 1, 0)
    assert scan_landed(spark, root, "stocks").count() == 2
    assert run_ingestion(spark, second.where("ticker = 'A'"), root, "stocks", "2026-03-17", batch_id="4", layout=layout) == counts(1, 0, 0)


def test_a_good_response_beats_refused_ones_of_the_same_ticker(spark, tmp_path):
    many = [("A", NOTE)] * 50 + [("A", payload("1"))] * 20
    got = run_ingestion(spark, responses(spark, many).repartition(6), str(tmp_path), "stocks", DAY)
    assert got == counts(1, 19, 50)
    assert landed_closes(spark, str(tmp_path)) == [("A", DAY, 1.0)]


def test_a_batch_run_again_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    steps = [
        ([("A", payload("1")), ("B", NOTE)], counts(1, 0, 1)),
        ([("A", payload("9")), ("B", payload("2"))], counts(1, 1, 0)),  # grown
        ([("B", payload("9"))], counts(0, 1, 0)),  # shrunk
        ([("A", payload("9")), ("B", payload("9"))], counts(0, 2, 0)),
    ]
    for rows, want in steps:
        assert run_ingestion(spark, responses(spark, rows), root, "stocks", DAY, batch_id="b1") == want
    assert landed_closes(spark, root) == [("A", DAY, 1.0), ("B", DAY, 2.0)]


def test_a_write_that_failed_is_made_up_for(spark, tmp_path):
    root = str(tmp_path)
    run_ingestion(spark, responses(spark, [("A", payload("1"))]), root, "stocks", DAY, batch_id="b1")
    broken = responses(spark, [("A", payload("1")), ("B", payload("2"))]).withColumn(
        "payload", F.when(F.col("ticker") == "B", F.raise_error(F.lit("lost"))).otherwise(F.col("payload")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        run_ingestion(spark, broken, root, "stocks", DAY, batch_id="b1")
    again = responses(spark, [("A", payload("1")), ("B", payload("2"))])
    assert run_ingestion(spark, again, root, "stocks", DAY, batch_id="b1") == counts(1, 1, 0)
    assert landed_closes(spark, root) == [("A", DAY, 1.0), ("B", DAY, 2.0)]


def test_stamps_win_over_the_payloads_own(spark, tmp_path):
    own = json.dumps({"_ticker": "X", "_ingested_at": "1999-01-01", schemas.SERIES_FIELD: {DAY: bar("3")}})
    for want in (counts(1, 0, 0), counts(0, 1, 0)):
        assert run_ingestion(spark, responses(spark, [("C", own)]), str(tmp_path), "stocks", DAY) == want
    assert landed_closes(spark, str(tmp_path)) == [("C", DAY, 3.0)]
    document = read_landed(spark, str(tmp_path), "stocks", schemas.BAR_DOCUMENT).first()
    assert (document._ticker, document._ingested_at) == ("C", DAY)


def test_only_the_keys_are_read_to_see_what_is_landed(spark, tmp_path):
    run_ingestion(spark, responses(spark, [("A", payload("1"))]), str(tmp_path), "stocks", DAY)
    landed = landed_tickers(spark, str(tmp_path), "stocks", DAY)
    assert "ReadSchema: struct<ticker:string>" in plan(landed)


def test_results_that_are_missing_are_no_empty_day(spark, tmp_path):
    short = json.dumps({"status": "OK", "resultsCount": 5, "results": []})
    assert run_ingestion(spark, responses(spark, [("A", short)]), str(tmp_path), "polygon", DAY) == counts(0, 0, 1)


def test_an_activity_document_of_another_company_is_refused(spark, tmp_path):
    rollup = activity_rollup(facts(spark), companies(spark), march(1))
    other = as_responses(rollup).filter("ticker = 'MSFT'").withColumn("ticker", F.lit("AAPL"))
    assert run_ingestion(spark, other, str(tmp_path), "github", march(1)) == counts(0, 0, 1)


def test_only_failures_land_nothing(spark, tmp_path):
    assert run_ingestion(spark, responses(spark, [("A", NOTE)]), str(tmp_path), "stocks", DAY) == counts(0, 0, 1)
    assert scan_landed(spark, str(tmp_path), "stocks").isEmpty()
    assert run_ingestion(spark, responses(spark, []), str(tmp_path), "stocks", DAY) == counts(0, 0, 0)


def test_aggregates_keep_their_trading_date(spark, tmp_path):
    body = json.dumps({"status": "OK", "resultsCount": 1, "results": [{"o": 1.0, "vw": 2.5, "n": 3}]})
    empty = json.dumps({"status": "OK", "resultsCount": 0})
    got = run_ingestion(spark, responses(spark, [("A", body), ("B", empty)]), str(tmp_path), "polygon", DAY, run_date="2026-03-17")
    assert got == counts(2, 0, 0)
    rows = accepted(parse_daily_aggregates(read_landed(spark, str(tmp_path), "polygon", schemas.AGGREGATE_DOCUMENT))).collect()
    assert [(r.ticker, str(r.date), r.vwap, r.transactions, r._ingested_at) for r in rows] == [("A", DAY, 2.5, 3, "2026-03-17")]


def test_rollup_is_landed_as_activity_documents(spark, tmp_path):
    rollup = activity_rollup(facts(spark), companies(spark), march(1))
    assert run_ingestion(spark, as_responses(rollup), str(tmp_path), "github", march(1)) == counts(5, 0, 0)
    documents = read_landed(spark, str(tmp_path), "github", schemas.ACTIVITY_DOCUMENT)
    parsed = {r.ticker: r for r in accepted(parse_activity(documents)).collect()}
    assert (parsed["MSFT"].total_stars, parsed["MSFT"].date, parsed["AAPL"].total_stars) == (11, march(1), 0)
    assert parse_repo_details(documents).where(F.col("commits_today") > 0).count() == 2
    assert run_ingestion(spark, as_responses(rollup), str(tmp_path), "github", march(1)) == counts(0, 5, 0)


def test_processing_reads_the_landing(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for day, close in ((DAY, "400"), ("2026-03-17", "404")):
        series = {DAY: bar("400")} if day == DAY else {DAY: bar("402"), day: bar(close)}
        run_ingestion(spark, responses(spark, [("MSFT", json.dumps({schemas.SERIES_FIELD: series}))]), root, "stocks", day)
    counted = run_processing(spark, root, out, layout="landed")
    assert counted == {"stocks": {"rows": 3, "not_accepted": 0}, "combined": {"rows": 2}}
    rows = read_combined(spark, combined_path(out)).orderBy("date").collect()
    assert [(str(r.date), r.close_price, r.daily_return_pct) for r in rows] == [(DAY, 402.0, None), ("2026-03-17", 404.0, 0.4975)]
    with pytest.raises(ValueError, match="layout"):
        run_processing(spark, root, out, layout="tape")
