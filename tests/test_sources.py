import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators.dedup import latest_per_key
from tickloom.sources.documents import (
    accepted,
    classify_payload,
    documents_from_text,
    landable,
    parse_daily_aggregates,
    parse_daily_bars,
    read_activity,
    read_daily_aggregates,
    read_daily_bars,
    read_parsed,
    read_repo_details,
    rejected,
    scan_documents,
)
from tickloom.sources.landing import (
    ingest_summary,
    land_raw,
    only_new,
    read_landed,
    scan_landed,
    stamped_text,
    with_ingest_meta,
)

D = dt.date


def bar(close="404.0", **other):
    return {"1. open": "212.25", "2. high": "219.75", "3. low": "208.50", "4. close": close, "5. volume": "100", **other}


def bar_document(ticker, series, ingested="2026-03-18", **other):
    return {"Meta Data": {"2. Symbol": ticker}, schemas.SERIES_FIELD: series, "_ticker": ticker, "_ingested_at": ingested, **other}


def write(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (folder / name).write_text(text)


def text_documents(spark, schema, *documents):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return documents_from_text(spark.createDataFrame(rows, "value string"), "value", schema)


# --- bars ----------------------------------------------------------------------------------


def test_bar_files(spark, tmp_path):
    write(tmp_path / "stocks", "MSFT_1.json", bar_document("MSFT", {"2026-03-16": bar("400.0"), "2026-03-17": bar()}))
    write(tmp_path / "stocks", "AAPL_1.json", bar_document("AAPL", {"2026-03-17": bar("1.5")}))
    write(tmp_path / "stocks", "notes.txt", "not a document")
    got = read_daily_bars(spark, str(tmp_path))
    assert [f.name for f in got.schema] == schemas.VERSIONED_BARS.names
    rows = {(r.ticker, r.date): r for r in got.collect()}
    assert set(rows) == {("MSFT", D(2026, 3, 16)), ("MSFT", D(2026, 3, 17)), ("AAPL", D(2026, 3, 17))}
    one = rows["MSFT", D(2026, 3, 17)]
    assert (one.open_price, one.high_price, one.low_price, one.close_price, one.volume) == (212.25, 219.75, 208.5, 404.0, 100)
    assert one._ingested_at == "2026-03-18" and one._file_path.endswith("MSFT_1.json")


def test_many_dates_do_not_widen_the_schema(spark, tmp_path):
    series = {f"2026-{m:02d}-{d:02d}": bar() for m in range(1, 13) for d in range(1, 29)}
    write(tmp_path / "stocks", "A.json", bar_document("A", series))
    assert read_daily_bars(spark, str(tmp_path)).count() == 336


def test_missing_and_malformed_values(spark):
    without_close = {k: v for k, v in bar().items() if k != "4. close"}
    documents = text_documents(
        spark, schemas.BAR_DOCUMENT,
        bar_document("OK", {"2026-03-16": without_close}),
        bar_document("BAD", {"2026-03-16": bar("n/a"), "2026-03-17": bar("5")}),
        bar_document("DAY", {"2026-13-01": bar()}),
        bar_document("", {"2026-03-16": bar()}),
        bar_document("VOL", {"2026-03-16": bar(**{"5. volume": "1.5"})}),
    )
    parsed = parse_daily_bars(documents)
    good = {(r.ticker, str(r.date)): r.close_price for r in accepted(parsed).collect()}
    assert good == {("OK", "2026-03-16"): 0.0, ("BAD", "2026-03-17"): 5.0}
    problems = sorted((r.ticker, r.row_problem) for r in rejected(parsed).collect())
    assert problems == [("", "no_ticker"), ("BAD", "bad_number"), ("DAY", "bad_date"), ("VOL", "bad_number")]
    strict = accepted(parse_daily_bars(documents, strict_nulls=True)).where("ticker = 'OK'").first()
    assert strict.close_price is None and strict.open_price == 212.25


def test_numbers_given_as_numbers(spark):
    document = bar_document("A", {"2026-03-16": {"1. open": 1, "2. high": 2.5, "3. low": 1e0, "4. close": 2, "5. volume": 7}})
    row = accepted(parse_daily_bars(text_documents(spark, schemas.BAR_DOCUMENT, document))).first()
    assert (row.open_price, row.high_price, row.low_price, row.close_price, row.volume) == (1.0, 2.5, 1.0, 2.0, 7)


def test_payload_status_of_bars(spark):
    documents = text_documents(
        spark, schemas.BAR_DOCUMENT,
        bar_document("ok", {"2026-03-16": bar()}),
        {"_ticker": "error", "Error Message": "no such symbol"},
        {"_ticker": "limit", "Note": "call frequency"},
        {"_ticker": "none", "Information": "premium"},
        bar_document("empty", {}),
        "{ this is not json",
    )
    got = sorted((r._ticker or "", r.payload_status) for r in classify_payload(documents, "stocks").collect())
    assert got == [("", "malformed"), ("empty", "empty"), ("error", "error"), ("limit", "rate_limited"), ("none", "no_series"), ("ok", "ok")]
    assert sorted(r._ticker for r in landable(documents, "stocks").collect()) == ["empty", "ok"]
    parsed = parse_daily_bars(documents)
    assert [r.ticker for r in accepted(parsed).collect()] == ["ok"]
    assert sorted(r.row_problem for r in rejected(parsed).collect()) == ["error", "malformed", "no_series", "rate_limited"]


def test_a_broken_file_does_not_stop_the_others(spark, tmp_path):
    write(tmp_path / "stocks", "A.json", bar_document("A", {"2026-03-16": bar()}))
    write(tmp_path / "stocks", "B.json", '{"_ticker": "B", "Time Ser')
    parsed = read_parsed(spark, str(tmp_path), "stocks")
    assert [r.ticker for r in accepted(parsed).collect()] == ["A"]
    bad = rejected(parsed).first()
    assert bad.row_problem == "malformed" and bad._file_path.endswith("B.json")


# --- aggregates and activity ------------------------------------------------------------------


def test_aggregate_files(spark, tmp_path):
    result = {"o": 1, "h": 2.5, "l": "0.5", "c": 2, "v": 1.2e3, "vw": 1.75, "n": 12.0}
    base = {"_ticker": "MSFT", "_trading_date": "2026-03-16", "_ingested_at": "2026-03-17", "status": "OK"}
    write(tmp_path / "polygon", "1.json", {**base, "resultsCount": 2, "results": [result, {"o": 9}]})
    write(tmp_path / "polygon", "2.json", {**base, "resultsCount": 0})
    write(tmp_path / "polygon", "3.json", {**base, "resultsCount": 0, "results": []})
    write(tmp_path / "polygon", "4.json", {**base, "status": "ERROR", "error": "no plan"})
    rows = sorted(read_daily_aggregates(spark, str(tmp_path)).collect(), key=lambda r: r.poly_open)
    assert [tuple(r[:9]) for r in rows] == [
        ("MSFT", D(2026, 3, 16), 1.0, 2.5, 0.5, 2.0, 1200.0, 1.75, 12),
        ("MSFT", D(2026, 3, 16), 9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0),
    ]
    assert [r.row_problem for r in rejected(read_parsed(spark, str(tmp_path), "polygon")).collect()] == ["error"]


def test_bad_trading_date_is_rejected(spark):
    document = {"_ticker": "A", "_trading_date": "", "status": "OK", "results": [{"o": 1}]}
    parsed = parse_daily_aggregates(text_documents(spark, schemas.AGGREGATE_DOCUMENT, document))
    assert [r.row_problem for r in parsed.collect()] == ["bad_date"]


def activity_document(ticker="MSFT", date="2026-03-17", **other):
    return {
        "ticker": ticker, "github_org": "microsoft", "date": date, "total_commits_today": 12, "total_open_prs": 3,
        "total_stars": 100, "total_forks": 50, "repos_tracked": 3, "_ingested_at": date,
        "repo_details": [
            {"repo": "vscode", "stars": 60, "forks": 30, "commits_today": 10, "open_prs": 1},
            {"repo": "terminal", "stars": 40, "forks": 20, "commits_today": 2},
        ],
        **other,
    }


def test_activity_files(spark, tmp_path):
    write(tmp_path / "github", "1.json", activity_document())
    write(tmp_path / "github", "2.json", {"ticker": "AAPL", "date": "2026-03-17"})
    write(tmp_path / "github", "3.json", activity_document(ticker=None))
    rows = {r.ticker: tuple(r[1:7]) for r in read_activity(spark, str(tmp_path)).collect()}
    assert rows == {"MSFT": (D(2026, 3, 17), 12, 3, 100, 50, 3), "AAPL": (D(2026, 3, 17), 0, 0, 0, 0, 0)}
    details = sorted(tuple(r) for r in read_repo_details(spark, str(tmp_path)).where("ticker is not null").collect())
    assert details == [("MSFT", D(2026, 3, 17), "terminal", 40, 20, 2, 0), ("MSFT", D(2026, 3, 17), "vscode", 60, 30, 10, 1)]


# --- missing sources, several roots ------------------------------------------------------------


@pytest.mark.parametrize("read", [read_daily_bars, read_daily_aggregates, read_activity, read_repo_details])
def test_missing_directory_gives_typed_empty_frame(spark, tmp_path, read):
    present = tmp_path / "present"
    for source in ("stocks", "polygon", "github"):
        (present / source).mkdir(parents=True)
    missing = read(spark, str(tmp_path / "nowhere"))
    assert missing.isEmpty()
    assert [(f.name, f.dataType) for f in missing.schema] == [(f.name, f.dataType) for f in read(spark, str(present)).schema]
    assert read(spark, str(present)).isEmpty()


def test_several_roots_and_globs(spark, tmp_path):
    for i in (1, 2, 3):
        write(tmp_path / f"day{i}", f"{i}.json", bar_document(f"T{i}", {"2026-03-16": bar()}))
    roots = [str(tmp_path / "day1"), str(tmp_path / "day[23]"), str(tmp_path / "day9")]
    assert scan_documents(spark, roots, schemas.BAR_DOCUMENT).count() == 3


# --- landing -----------------------------------------------------------------------------------


def landing_batch(spark, rows):
    """rows of (ticker, day, close)"""
    texts = [(t, json.dumps(bar_document(t, {d: bar(c)}, ingested=d, undeclared=7)), D.fromisoformat(d)) for t, d, c in rows]
    return spark.createDataFrame(texts, "ticker string, document string, landing_date date")


def landed_closes(spark, root, **options):
    parsed = latest_per_key(accepted(parse_daily_bars(read_landed(spark, root, "stocks", schemas.BAR_DOCUMENT, **options))))
    return sorted((r.ticker, str(r.date), r.close_price) for r in parsed.collect())


@pytest.mark.parametrize("layout, folder", [("compact", "dt=2026-03-16"), ("ymd", "year=2026/month=03/day=16")])
def test_copies_are_resolved_when_read_and_later_batches_win(spark, tmp_path, layout, folder):
    root = str(tmp_path / "raw")
    first = landing_batch(spark, [("A", "2026-03-16", "1"), ("B", "2026-03-16", "2"), ("A", "2026-03-17", "3")])
    for _ in range(2):
        land_raw(first, root, "stocks", "20260317T180000", layout)
    place = tmp_path / "raw" / "source=stocks" / folder / "batch=20260317T180000"
    assert place.is_dir() and "undeclared" in spark.read.parquet(str(place)).first().document
    want = [("A", "2026-03-16", 1.0), ("A", "2026-03-17", 3.0), ("B", "2026-03-16", 2.0)]
    assert landed_closes(spark, root) == want
    land_raw(landing_batch(spark, [("A", "2026-03-16", "9")]), root, "stocks", "20260318T180000", layout)
    assert landed_closes(spark, root) == [("A", "2026-03-16", 9.0), *want[1:]]
    assert landed_closes(spark, root, day="2026-03-16", layout=layout) == [("A", "2026-03-16", 9.0), want[2]]
    assert landed_closes(spark, root, day="2026-03-20", layout=layout) == []
    assert scan_landed(spark, root, "stocks").count() == 7


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        land_raw(landing_batch(spark, [("A", "2026-03-16", "1")]), str(tmp_path), "stocks", "b", layout="weekly")


@pytest.mark.parametrize(
    "payload, want",
    [
        ('{\n  "a": 1,\n  "b": {"c": "x\\ny"}\n}', {"_ticker": 'A"B', "a": 1, "b": {"c": "x\ny"}}),
        (' \n{ } ', {"_ticker": 'A"B'}), ('{"_ticker": "own", "x": [1]}', {"_ticker": 'A"B', "x": [1]}), ('{"a": 1', None),
        ("[1]", None), ("", None), (None, None), ('"text"', None),
    ],
)
def test_stamped_text(spark, payload, want):
    column = stamped_text(F.lit(payload).cast("string"), _ticker=F.lit('A"B'))
    text = spark.range(1).select(column.alias("x")).first().x
    assert (None if text is None else json.loads(text)) == want
    assert text is None or "\n" not in text


def test_only_new(spark):
    schema = "source string, ticker string, date string"
    batch = spark.createDataFrame([("stocks", t, "2026-03-16") for t in "AABC"], schema)
    landed = spark.createDataFrame([("stocks", "A", "2026-03-16"), ("polygon", "B", "2026-03-16")] * 3, schema)
    assert sorted(r.ticker for r in only_new(batch, landed).collect()) == ["B", "C"]
    assert only_new(batch, batch).isEmpty()


def test_stamps(spark):
    df = spark.createDataFrame([("A", D(2026, 3, 16))], "ticker string, day date")
    row = with_ingest_meta(df, D(2026, 3, 17), trading_date="day").first()
    assert (row._ticker, row._ingested_at, row._trading_date) == ("A", "2026-03-17", "2026-03-16")
    assert "_trading_date" not in with_ingest_meta(df, "2026-03-17").columns


def test_ingest_summary(spark):
    rows = [("stocks", "success")] * 3 + [("stocks", "skipped"), ("github", "error")]
    got = ingest_summary(spark.createDataFrame(rows, "source string, status string")).orderBy("source")
    assert [tuple(r) for r in got.collect()] == [("github", 0, 0, 1), ("stocks", 3, 1, 0)]
