"""Small files packed once, rewritten files taken again."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.test_sources import bar, bar_document, write
from tickloom import schemas
from tickloom.plans.pipeline import pack_sources, run_processing
from tickloom.sources import packing
from tickloom.sources.packing import last_batch, pack_facts, pack_files, packed_files, read_packed
from tickloom.sources.tables import read_combined
from tickloom.streaming import follow_rewritten_files
from tickloom.streaming.bars import LAYOUT, apply_corrections, read_corrected_bars, table_buckets


def put(folder, name, text, age=0):
    """Write a file; ``age`` seconds back, so that two writes never share a time."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    then = time.time() - age
    os.utime(folder / name, (then, then))


def texts(spark, packed):
    return {os.path.basename(r.path): r.document for r in read_packed(spark, packed).collect()}


def test_a_second_run_packs_only_new_and_rewritten_files(spark, tmp_path):
    raw, packed = tmp_path / "raw", str(tmp_path / "packed")
    n = 1000
    for k in range(n):
        put(raw / f"d{k % 7}", f"{k}.json", f'{{"n": {k}}}\n "é"', age=900)
    put(raw, "other.txt", "no document")
    assert pack_files(spark, str(raw), packed) == {"batch": 1, "files": n, "documents": n}
    want = {f"{k}.json": f'{{"n": {k}}}\n "é"' for k in range(n)}
    assert texts(spark, packed) == want
    stored = [f for _, _, files in os.walk(f"{packed}/documents") for f in files if f.endswith(".parquet")]
    assert len(stored) <= 8, "few packed files"
    assert pack_files(spark, str(raw), packed) == {"batch": 1, "files": 0, "documents": 0}

    put(raw, "new.json", "new", age=300)
    put(raw / "d3", "3.json", "rewritten", age=200)
    put(raw / "d4", "4.json", want["4.json"], age=100)  # touched, same text
    put(raw, "empty.json", "")
    assert pack_files(spark, str(raw), packed) == {"batch": 2, "files": 3, "documents": 2}
    want |= {"new.json": "new", "3.json": "rewritten"}
    assert texts(spark, packed) == want
    assert pack_facts(spark, packed, 2)["documents"] == 2 and packed_files(spark, packed).count() == n + 1
    assert pack_files(spark, str(raw), packed)["files"] == 0
    # Back to a former text: a change like any other. A file that goes keeps its packed text.
    put(raw / "d3", "3.json", '{"n": 3}\n "é"', age=50)
    os.remove(raw / "d5" / "5.json")
    assert pack_files(spark, str(raw), packed) == {"batch": 3, "files": 1, "documents": 1}
    assert texts(spark, packed) == want | {"3.json": '{"n": 3}\n "é"'}


def test_only_the_files_to_take_are_opened(spark, tmp_path):
    """An older file that cannot be read does not matter once it is packed."""
    raw, packed = tmp_path / "raw", str(tmp_path / "packed")
    put(raw, "old.json", "old", age=900)
    pack_files(spark, str(raw), packed)
    put(raw, "late.json", "late")
    listed = packing._listed(spark, str(raw), "*.json").where(F.col("modified") >= F.current_timestamp() - F.expr("interval 5 minutes"))
    text = listed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(modificationTime), GreaterThanOrEqual(modificationTime" in text
    assert pack_files(spark, str(raw), packed) == {"batch": 2, "files": 1, "documents": 1}


def test_a_run_that_dies_is_made_again(spark, tmp_path, monkeypatch):
    raw, packed = tmp_path / "raw", str(tmp_path / "packed")
    put(raw, "a.json", "one", age=60)
    pack_files(spark, str(raw), packed)
    put(raw, "a.json", "two")
    put(raw, "b.json", "b")

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(packing, "write_facts", dies)
        with pytest.raises(KeyboardInterrupt):
            pack_files(spark, str(raw), packed)
    assert last_batch(spark, packed) == 1 and texts(spark, packed) == {"a.json": "one"}
    assert pack_files(spark, str(raw), packed) == {"batch": 2, "files": 2, "documents": 2}
    assert texts(spark, packed) == {"a.json": "two", "b.json": "b"}


def test_nothing_to_pack(spark, tmp_path):
    packed = str(tmp_path / "packed")
    assert pack_files(spark, str(tmp_path / "nowhere"), packed) == {"batch": 0, "files": 0, "documents": 0}
    (tmp_path / "empty").mkdir()
    assert pack_files(spark, str(tmp_path / "empty"), packed) == {"batch": 0, "files": 0, "documents": 0}
    assert read_packed(spark, packed).collect() == [] and packed_files(spark, packed).collect() == []


def land(raw, name, closes, stamp, age=0, ticker="A"):
    document = bar_document(ticker, {day: bar(close) for day, close in closes.items()}, stamp)
    write(raw / "stocks", name, document)
    os.utime(raw / "stocks" / name, (time.time() - age,) * 2)


def test_processing_reads_packed_documents(spark, tmp_path):
    raw, packed, out = tmp_path / "raw", str(tmp_path / "packed"), str(tmp_path / "out")
    land(raw, "A.json", {"2026-03-16": "400", "2026-03-17": "404"}, "2026-03-17", age=60)
    assert pack_sources(spark, str(raw), packed)["stocks"]["documents"] == 1
    counts = run_processing(spark, packed, out, layout="packed")
    assert counts["combined"] == {"rows": 2}
    # The file is overwritten under its name, with the same stamp and without a day.
    land(raw, "A.json", {"2026-03-17": "100"}, "2026-03-17")
    pack_sources(spark, str(raw), packed)
    run_processing(spark, packed, out, layout="packed")
    assert [(str(r.date), r.close_price) for r in read_combined(spark, f"{out}/combined").collect()] == [("2026-03-17", 100.0)]


def test_a_rewritten_file_corrects_the_table(spark, tmp_path):
    raw, packed, table = tmp_path / "raw", str(tmp_path / "packed"), str(tmp_path / "bars")
    place = str(tmp_path / "checkpoint")

    def current():
        facts = follow_rewritten_files(spark, str(raw), packed, table, place)
        rows = read_corrected_bars(spark, table).orderBy("ticker", "date").collect()
        return facts["files"], [(r.ticker, str(r.date)[-2:], r.close_price, r.daily_return_pct) for r in rows]

    land(raw, "A.json", {"2026-03-16": "400", "2026-03-17": "404"}, "2026-03-17", age=90)
    land(raw, "B.json", {"2026-03-16": "7"}, "2026-03-17", age=90, ticker="B")
    assert current() == (2, [("A", "16", 400.0, None), ("A", "17", 404.0, 1.0), ("B", "16", 7.0, None)])
    land(raw, "A.json", {"2026-03-16": "400", "2026-03-17": "200"}, "2026-03-17", age=60)  # lower values, same stamp
    assert current() == (1, [("A", "16", 400.0, None), ("A", "17", 200.0, -50.0), ("B", "16", 7.0, None)])
    assert current()[0] == 0
    land(raw, "A.json", {"2026-03-16": "100"}, "2026-03-16")  # an older stamp does not win
    assert current()[1][0] == ("A", "16", 400.0, None)


def test_the_bucket_number_stays_with_the_table(spark, tmp_path, monkeypatch):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")

    def batch(rows):
        columns = "ticker string, date string, close_price double, _ingested_at string"
        return spark.createDataFrame(rows, columns).select(
            "ticker", F.col("date").cast("date").alias("date"), *[F.col("close_price").alias(c) for c in schemas.BAR_VALUES[:4]],
            F.lit(1).cast("bigint").alias("volume"), "_ingested_at", F.lit("f").alias("_file_path"))

    tickers = [f"T{k}" for k in range(30)]
    apply_corrections(batch([(t, "2026-03-16", 1.0, "1") for t in tickers]), 0, table, staging, new_buckets=5)
    assert table_buckets(spark, table) == 5
    # Another default does not matter: the table goes by its own number.
    apply_corrections(batch([(t, "2026-03-17", 2.0, "2") for t in tickers]), 1, table, staging, new_buckets=64)
    assert table_buckets(spark, table) == 5
    rows = read_corrected_bars(spark, table).collect()
    assert len(rows) == 60 and {r.daily_return_pct for r in rows} == {None, 100.0}
    assert len([d for d in os.listdir(table) if d.startswith("bucket=")]) <= 5
    os.remove(f"{table}/{LAYOUT}")
    with pytest.raises(ValueError):
        apply_corrections(batch([("T1", "2026-03-18", 2.0, "2")]), 2, table, staging)
