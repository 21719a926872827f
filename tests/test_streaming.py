import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.test_sources import bar, bar_document, write
from tickloom import schemas
from tickloom.operators.dedup import latest_per_key
from tickloom.operators.quality import NOT_NULL_COLUMNS, check_state, check_table
from tickloom.operators.windows import with_daily_return, with_rolling
from tickloom.plans.models import marts_of_corrected
from tickloom.plans.pipeline import MARTS, build_combined, run_models
from tickloom.sinks import versions
from tickloom.streaming import apply_corrections, bars, corrected_checks, follow_corrections, land_incremental
from tickloom.streaming.bars import CHECKED, bucket_of, checkpoint_for, read_corrected_bars, read_landed_bars


def land(tmp_path, name, ticker, closes, ingested):
    write(tmp_path / "raw" / "stocks", name, bar_document(ticker, {d: bar(c) for d, c in closes.items()}, ingested))


def test_each_file_is_landed_once(spark, tmp_path):
    raw, out, checkpoint = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    land(tmp_path, "1.json", "A", {"2026-03-16": "400", "2026-13-17": "1"}, "2026-03-16")
    for _ in range(2):
        land_incremental(spark, raw, out, checkpoint)
        assert read_landed_bars(spark, out).count() == 1
    land(tmp_path, "2.json", "A", {"2026-03-17": "404"}, "2026-03-17")
    land_incremental(spark, raw, out, checkpoint, max_files=1)
    got = read_landed_bars(spark, out).orderBy("date").collect()
    assert [(str(r.date), r.close_price, os.path.basename(r._file_path)) for r in got] == [
        ("2026-03-16", 400.0, "1.json"), ("2026-03-17", 404.0, "2.json")]
    assert spark.read.parquet(out).where("verdict = 'bad_date'").count() == 1


def folder_of(spark, table, ticker):
    return f"{table}/bucket={spark.range(1).select(bucket_of(F.lit(ticker))).first()[0]}"


def table_rows(spark, table):
    rows = read_corrected_bars(spark, table).orderBy("ticker", "date").collect()
    return [(r.ticker, str(r.date), r.close_price, r.daily_return_pct) for r in rows]


def test_corrections_rebuild_only_touched_tickers(spark, tmp_path):
    raw, table, checkpoint = str(tmp_path / "raw"), str(tmp_path / "bars"), str(tmp_path / "ckpt")
    land(tmp_path, "1.json", "A", {"2026-03-16": "400", "2026-03-17": "404", "2026-03-18": "408"}, "2026-03-18")
    land(tmp_path, "2.json", "B", {"2026-03-16": "10", "2026-03-17": "11"}, "2026-03-18")
    follow_corrections(spark, raw, table, checkpoint)
    first = table_rows(spark, table)
    assert first == [
        ("A", "2026-03-16", 400.0, None), ("A", "2026-03-17", 404.0, 1.0), ("A", "2026-03-18", 408.0, 0.9901),
        ("B", "2026-03-16", 10.0, None), ("B", "2026-03-17", 11.0, 10.0)]
    other = folder_of(spark, table, "B")
    assert other != folder_of(spark, table, "A")
    untouched = {f: os.stat(f"{other}/{f}").st_mtime_ns for f in os.listdir(other)}
    land(tmp_path, "3.json", "A", {"2026-03-17": "500"}, "2026-03-19")
    follow_corrections(spark, raw, table, checkpoint)
    assert table_rows(spark, table) == [
        ("A", "2026-03-16", 400.0, None), ("A", "2026-03-17", 500.0, 25.0), ("A", "2026-03-18", 408.0, -18.4), *first[3:]]
    assert untouched == {f: os.stat(f"{other}/{f}").st_mtime_ns for f in os.listdir(other)}
    land(tmp_path, "4.json", "A", {"2026-03-17": "1"}, "2026-03-01")  # late file with an older stamp
    follow_corrections(spark, raw, table, checkpoint)
    assert table_rows(spark, table)[1] == ("A", "2026-03-17", 500.0, 25.0)


def batch(spark, rows):
    columns = "ticker string, date string, close_price double, _ingested_at string"
    return spark.createDataFrame(rows, columns).select(
        "ticker", F.col("date").cast("date").alias("date"), *[F.col("close_price").alias(c) for c in schemas.BAR_VALUES[:4]],
        F.lit(1).cast("bigint").alias("volume"), "_ingested_at", F.lit("f").alias("_file_path"))


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    apply_corrections(batch(spark, [("A", "2026-03-16", 1.0, "1"), ("B", "2026-03-16", 5.0, "1")]), 0, table, staging)
    second = batch(spark, [("A", "2026-03-17", 2.0, "2")])
    apply_corrections(second, 1, table, staging)
    want = table_rows(spark, table)
    apply_corrections(second, 1, table, staging)
    assert table_rows(spark, table) == want == [
        ("A", "2026-03-16", 1.0, None), ("A", "2026-03-17", 2.0, 100.0), ("B", "2026-03-16", 5.0, None)]
    assert os.listdir(staging) == ["batch_id=1"]


def test_a_crash_during_replacement_loses_no_history(spark, tmp_path):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    apply_corrections(batch(spark, [("A", "2026-03-16", 1.0, "1")]), 0, table, staging)
    second = batch(spark, [("A", "2026-03-17", 2.0, "2")])
    apply_corrections(second, 1, table, staging)
    want = table_rows(spark, table)
    folder = folder_of(spark, table, "A")
    for place, _, names in os.walk(folder):  # the folder was emptied, its new files did not arrive
        for name in names:
            os.remove(f"{place}/{name}")
    apply_corrections(second, 1, table, staging)
    assert table_rows(spark, table) == want


def test_only_touched_folders_are_read(spark, tmp_path):
    table = str(tmp_path / "bars")
    tickers = [f"T{i}" for i in range(40)]
    apply_corrections(batch(spark, [(t, "2026-03-16", 1.0, "1") for t in tickers]), 0, table, str(tmp_path / "staged"))
    bucket = int(folder_of(spark, table, "T7").rpartition("=")[2])
    files = read_corrected_bars(spark, table, [bucket])
    plan = files._jdf.queryExecution().executedPlan()
    files.collect()
    assert plan.collectLeaves().head().metrics().apply("numFiles").value() == 1
    assert len(spark.read.parquet(table).inputFiles()) > 20


def days(first, n):
    """``n`` week days from ``first``."""
    out, day = [], dt.date.fromisoformat(first)
    while len(out) < n:
        if day.weekday() < 5:
            out.append(str(day))
        day += dt.timedelta(1)
    return out


def history(seed, tickers, n):
    draw = random.Random(seed)
    return [(t, d, 50 + round(draw.random() * 100, 2), "1") for t in tickers for d in days("2024-01-01", n) if draw.random() < 0.9]


def exact(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_corrections_equal_a_full_rebuild(spark, tmp_path):
    """Random corrections, late bars between old ones, stale versions: after each batch the table is what all versions give."""
    draw, table, staging = random.Random(7), str(tmp_path / "bars"), str(tmp_path / "staged")
    seen = history(1, "ABC", 150)
    batches = [seen]
    for k in range(2, 6):
        days_of = days("2023-12-20", 190)
        batches.append([(draw.choice("ABCD"), draw.choice(days_of), draw.choice([0.0, draw.random() * 90]), draw.choice(["0", str(k)])) for _ in range(4)])
    for k, rows in enumerate(batches):
        apply_corrections(batch(spark, rows), k, table, staging, new_buckets=2, new_period="month")
        seen = rows if k == 0 else seen + rows
        full = with_rolling(with_daily_return(latest_per_key(batch(spark, seen)))).select(*schemas.CORRECTED_BARS.names)
        assert exact(read_corrected_bars(spark, table)) == exact(full)


def counted(checks):
    return sorted(tuple(r) for r in checks.select("check", "column_name", "failures").collect())


def full_checks(spark, table):
    return counted(check_table(read_corrected_bars(spark, table), NOT_NULL_COLUMNS[CHECKED], CHECKED))


def test_a_batch_checks_the_folders_it_rewrites(spark, tmp_path, monkeypatch):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    with pytest.raises(ValueError, match="no stored checks"):
        corrected_checks(spark, table)
    first = batch(spark, history(1, "AB", 120))
    apply_corrections(first, 0, table, staging, new_buckets=2, new_period="month")
    assert counted(corrected_checks(spark, table)) == full_checks(spark, table) and not any(n for *_, n in full_checks(spark, table))
    seen = []
    monkeypatch.setattr(bars, "check_state", lambda df, *rest: (seen.append(df), check_state(df, *rest))[1])
    for k, close in ((1, None), (1, None), (2, None), (3, 5.0)):
        day = "2024-02-0" + str(min(k, 2))
        apply_corrections(batch(spark, [("A", day, close, str(k + 1))]), k, table, staging)
        assert counted(corrected_checks(spark, table)) == full_checks(spark, table)
    failures = {c: n for _, c, n in counted(corrected_checks(spark, table))}
    assert failures == {"ticker": 0, "date": 0, "close_price": 1, "ticker,date": 0}
    whole = read_corrected_bars(spark, table).count()
    assert all(0 < df.count() < whole / 2 for df in seen[-1:]), "only rewritten folders are checked"
    # A table from before the counts were kept is checked whole with its next batch.
    versions.drop_folder(spark, bars.checks_path(table))
    apply_corrections(batch(spark, [("C", "2024-03-01", 1.0, "9")]), 4, table, staging)
    assert counted(corrected_checks(spark, table)) == full_checks(spark, table)


def files_below(folder):
    return {f"{place}/{name}": os.stat(f"{place}/{name}").st_mtime_ns for place, _, names in os.walk(folder) for name in names if name.endswith(".parquet")}


def test_a_corrected_day_rewrites_only_the_periods_it_reaches(spark, tmp_path):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    apply_corrections(batch(spark, history(2, ["A", "B"], 500)), 0, table, staging, new_buckets=1, new_period="month")
    before = files_below(table)
    assert len(before) == 23  # months
    apply_corrections(batch(spark, [("A", "2024-06-12", 99.0, "2")]), 1, table, staging)
    after = files_below(table)
    gone = sorted(f.split("period=")[1][:6] for f in before if after.get(f) != before[f])
    assert gone == ["202406", "202407"] and len(after) == 23
    # The last bar of all is followed by none.
    before = after
    apply_corrections(batch(spark, [("A", "2025-12-31", 99.0, "2")]), 2, table, staging)
    assert all(files_below(table).get(f) == t for f, t in before.items()) and len(files_below(table)) == 24


def test_long_gaps_are_crossed(spark, tmp_path):
    """The next bar of a ticker may be years away; another ticker's bars between do not matter."""
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    rows = [("A", "2001-01-02", 10.0, "1"), ("A", "2024-01-02", 20.0, "1"), *[("B", d, 5.0, "1") for d in days("2010-01-01", 30)]]
    apply_corrections(batch(spark, rows), 0, table, staging, new_buckets=1)
    apply_corrections(batch(spark, [("A", "2001-01-02", 40.0, "2")]), 1, table, staging)
    assert [r for r in table_rows(spark, table) if r[0] == "A"] == [("A", "2001-01-02", 40.0, None), ("A", "2024-01-02", 20.0, -50.0)]


def test_marts_follow_the_corrected_table(spark, tmp_path):
    table, staging = str(tmp_path / "bars"), str(tmp_path / "staged")
    first, second = history(3, ["A", "B"], 60), [("A", "2024-01-30", 77.0, "2"), ("B", "2024-02-01", 1.0, "2")]
    for k, rows in enumerate([first, second]):
        apply_corrections(batch(spark, rows), k, table, staging, new_buckets=2, new_period="month")
    bars = batch(spark, first + second).withColumn("row_problem", F.lit(None).cast("string"))
    keys = spark.createDataFrame([(t, d) for t, d, *_ in first[::3]], "ticker string, date string").withColumn("date", F.to_date("date"))

    def feed(schema):
        values = {f.name: (F.length("ticker") + F.dayofmonth("date")).cast(f.dataType) for f in schema if f.name not in schemas.KEYS}
        return keys.withColumns(values).select(*schema.names).withColumns({"row_problem": F.lit(None).cast("string")})

    aggregates, activity = feed(schemas.AGGREGATES), feed(schemas.ACTIVITY)
    rebuilt = run_models(build_combined({"stocks": bars, "polygon": aggregates, "github": activity}))
    kept = marts_of_corrected(read_corrected_bars(spark, table), aggregates, activity)
    for name in MARTS:
        assert kept[name].columns == rebuilt[name].columns
        assert exact(kept[name]) == exact(rebuilt[name])
        assert "Window" not in kept[name]._jdf.queryExecution().executedPlan().toString()
    alone = marts_of_corrected(read_corrected_bars(spark, table))
    assert exact(alone[MARTS[0]]) == exact(run_models(build_combined({"stocks": bars}))[MARTS[0]])


def test_a_period_of_another_kind_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="period"):
        apply_corrections(batch(spark, [("A", "2026-03-16", 1.0, "1")]), 0, str(tmp_path / "bars"), str(tmp_path / "staged"), new_period="week")
    assert not os.path.exists(tmp_path / "bars")


def test_an_unfinished_staging_copy_is_written_anew(spark, tmp_path):
    table, staging = str(tmp_path / "bars"), tmp_path / "staged"
    part = staging / "batch_id=0"
    part.mkdir(parents=True)
    (part / "part-0.parquet").write_text("half a file")
    apply_corrections(batch(spark, [("A", "2026-03-16", 1.0, "1")]), 0, table, str(staging))
    assert table_rows(spark, table) == [("A", "2026-03-16", 1.0, None)]


def test_default_checkpoint_is_in_the_shared_folder(spark, tmp_path):
    land(tmp_path, "1.json", "A", {"2026-03-16": "400"}, "2026-03-16")
    out = str(tmp_path / "out")
    for _ in range(2):
        land_incremental(spark, str(tmp_path / "raw"), out)
    place = checkpoint_for(spark, "land_bars", out)
    assert place.startswith(spark.conf.get("spark.checkpoint.dir")) and os.path.isdir(f"{place}/offsets")
    assert place != checkpoint_for(spark, "land_bars", out + "2")
    assert read_landed_bars(spark, out).count() == 1


def test_checkpoint_without_a_shared_folder_is_beside_the_target(spark, monkeypatch):
    monkeypatch.setattr("tickloom.streaming.bars.shared_dir", lambda _: None)
    assert checkpoint_for(spark, "land_bars", "/data/out/") == "/data/out_land_bars_checkpoint"


def test_a_bad_source_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        land_incremental(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
