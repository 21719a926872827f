"""Versioned datasets and runs published together: what readers see while and after writers fail."""

import datetime as dt
import os
import re
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.test_pipeline import RUN, raw  # noqa: F401  (fixture)
from tickloom import schemas
from tickloom.plans import pipeline
from tickloom.plans.models import company_daily, mart_stock_performance
from tickloom.plans.pipeline import MARTS, publish_models, run_processing
from tickloom.sinks import runs, versions, write_combined
from tickloom.sources.tables import read_combined

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def combined(spark, n, ticker="A"):
    """``n`` days of one ticker."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.COMBINED if f.name not in ("ticker", "date", "close_price")]
    days = spark.range(n).select(F.lit(ticker).alias("ticker"), F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("id").cast("int")).alias("date"),
                                 F.lit(float(n)).alias("close_price"), *nulls)
    return days.select(*schemas.COMBINED.names)


# --- versions of a dataset --------------------------------------------------------------------


def test_a_write_killed_midway_leaves_the_former_rows(spark, tmp_path):
    path = str(tmp_path / "combined")
    assert write_combined(combined(spark, 5), path) == {"rows": 5}
    before = rows(read_combined(spark, path))
    broken = combined(spark, 200).withColumn(
        "volume", F.when(F.dayofyear("date") == 180, F.raise_error(F.lit("disk full"))).otherwise(1).cast("bigint")
    )
    two = combined(spark, 9, "B").unionByName(broken.select(*schemas.COMBINED.names))
    with pytest.raises(Exception, match="disk full"):
        write_combined(two, path)
    assert rows(read_combined(spark, path)) == before
    assert versions.version_facts(spark, path) == {"rows": 5}


def test_rows_without_a_marker_do_not_count(spark, tmp_path, monkeypatch):
    """A writer that dies when all files stand but the marker; the next one clears up after it."""
    path = str(tmp_path / "combined")
    write_combined(combined(spark, 3), path)

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "write_facts", die)
        with pytest.raises(KeyboardInterrupt):
            write_combined(combined(spark, 4), path)
    assert len(os.listdir(path)) == 2 and read_combined(spark, path).count() == 3
    held = read_combined(spark, path)
    assert write_combined(combined(spark, 6), path) == {"rows": 6}
    assert read_combined(spark, path).count() == 6
    assert held.count() == 3, "a reader of the version before goes on"
    assert len(os.listdir(path)) == 2 == len(versions.versions(spark, path))
    write_combined(combined(spark, 7), path)
    assert [f["rows"] for f in (versions.read_facts(spark, f"{v}/{versions.MARKER}") for v in versions.versions(spark, path))] == [6, 7]


def test_a_dataset_without_versions_and_an_empty_one(spark, tmp_path):
    plain = str(tmp_path / "plain")
    combined(spark, 2).write.partitionBy("ticker").parquet(plain)
    assert read_combined(spark, plain).count() == 2 and versions.version_facts(spark, plain) is None
    assert write_combined(combined(spark, 3), plain) == {"rows": 3}
    assert read_combined(spark, plain).count() == 3
    assert write_combined(combined(spark, 0), str(tmp_path / "none")) == {"rows": 0}
    assert read_combined(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileExistsError):
        versions.write_facts(spark, f"{versions.current_version(spark, plain)}/{versions.MARKER}", {})


def test_processing_that_fails_keeps_the_dataset(spark, tmp_path, raw, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")
    run_processing(spark, raw, out, RUN)
    before = rows(read_combined(spark, f"{out}/combined"))
    monkeypatch.setattr(pipeline, "with_processed_at", lambda df, ts: df.withColumn("processed_at", F.raise_error(F.lit("lost")).cast("timestamp")))
    with pytest.raises(Exception, match="lost"):
        run_processing(spark, raw, out, RUN)
    assert rows(read_combined(spark, f"{out}/combined")) == before


def test_counts_are_right_when_a_task_fails_once(tmp_path):
    """In a session of its own, whose tasks may be tried again: the first try writes rows and dies."""
    script = f"""
        import os, sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark import TaskContext
        from tickloom.session import get_session
        from tickloom.sinks import versions
        spark = get_session("t", master="local[2,4]", extra={{"spark.ui.enabled": "false"}})
        def once(batches):
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first try")
        df = spark.range(0, 30_000, 1, 3).mapInArrow(once, "id long")
        facts = versions.write_version(df, {str(tmp_path / "d")!r}, lambda d, folder: d.write.parquet(folder))
        print("FACTS", facts["rows"], spark.read.parquet(versions.current_version(spark, {str(tmp_path / "d")!r})).count())
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=200)
    assert "FACTS 30000 30000" in done.stdout, done.stderr[-2000:]


# --- runs published together ------------------------------------------------------------------


@pytest.fixture
def names(spark, request):
    """Names of one test's own, and its published combined dataset."""
    tag = re.sub(r"\W", "_", request.node.name)[:40].lower()
    return {"raw_table": f"raw_{tag}", "pointer": f"run_{tag}", "prefix": f"{tag}_"}


def read(spark, names):
    return {name: rows(spark.table(name)) for name in (names["raw_table"], *(names["prefix"] + m for m in MARTS))}


def put(spark, out, n):
    write_combined(combined(spark, n), f"{out}/combined")


def test_a_failure_between_the_two_marts_leaves_both(spark, tmp_path, names, monkeypatch):
    out = str(tmp_path)
    put(spark, out, 3)
    publish_models(spark, out, **names)
    before = read(spark, names)
    assert {len(r) for r in before.values()} == {3}
    put(spark, out, 8)
    real = runs.store_run

    def second_mart_fails(df, name, *rest):
        if name.endswith(MARTS[1]):
            raise OSError("no space left")
        real(df, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "store_run", second_mart_fails)
        with pytest.raises(OSError):
            publish_models(spark, out, **names)
    assert read(spark, names) == before
    publish_models(spark, out, **names)
    assert {len(r) for r in read(spark, names).values()} == {8}


def test_all_names_turn_in_the_one_step_of_the_pointer(spark, tmp_path, names, monkeypatch):
    out = str(tmp_path)
    put(spark, out, 3)
    first = publish_models(spark, out, **names)
    before, seen, real = read(spark, names), [], runs._point
    put(spark, out, 4)

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(runs, "_point", dies)
        with pytest.raises(KeyboardInterrupt):
            publish_models(spark, out, **names)
    assert read(spark, names) == before and runs.published_run(spark, names["pointer"]) == first

    def watched(*args):
        seen.append(read(spark, names))
        real(*args)
        seen.append(read(spark, names))

    monkeypatch.setattr(runs, "_point", watched)
    second = publish_models(spark, out, **names)
    assert [{len(r) for r in s.values()} for s in seen] == [{3}, {4}]
    assert runs.published_run(spark, names["pointer"]) == second > first
    # The run that died is gone, the one before stays for its readers.
    held = {r[0] for r in spark.sql(f"show partitions {names['raw_table']}__runs").collect()}
    assert held == {f"run={first}", f"run={second}"}
    assert rows(runs.run_rows(spark, names["raw_table"], first)) == before[names["raw_table"]]


def test_refused_marts_stay_unseen(spark, tmp_path, names, monkeypatch):
    out = str(tmp_path)
    put(spark, out, 2)
    publish_models(spark, out, **names)
    before = read(spark, names)
    put(spark, out, 5)

    def refuse(report):
        raise AssertionError("not good")

    monkeypatch.setattr(pipeline, "assert_quality", refuse)
    with pytest.raises(AssertionError):
        publish_models(spark, out, **names)
    assert read(spark, names) == before


def test_columns_may_be_added_and_may_lack_but_keep_their_types(spark):
    base = spark.createDataFrame([("A", dt.date(2026, 1, 1), 1)], "ticker string, date date, x int")
    frames = [base, base.withColumn("y", F.lit("new")), base.drop("x"), base.withColumn("x", F.lit("text"))]
    want = [[("A", dt.date(2026, 1, 1), 1)], [("A", dt.date(2026, 1, 1), 1, "new")], [("A", dt.date(2026, 1, 1))]]
    for frame, expected in zip(frames, want, strict=False):
        run = runs.new_run()
        runs.store_run(frame, "t_widens", run, 2)
        runs.publish_run(spark, run, {"t_widens": frame}, "t_widens_pointer")
        assert rows(spark.table("t_widens")) == expected and spark.table("t_widens").columns == frame.columns
    with pytest.raises(ValueError):
        runs.store_run(frames[3], "t_widens", "r", 2)
    assert runs.bucket_count(spark, "t_widens__runs") == 2


def test_tables_outside_the_warehouse_keep_no_old_files(spark, tmp_path, names):
    out, where = str(tmp_path / "out"), str(tmp_path / "tables")
    published = []
    for n in (2, 3, 4):
        put(spark, out, n)
        published.append(publish_models(spark, out, location=where, **names))
        assert {len(r) for r in read(spark, names).values()} == {n}
    held = {d for d in os.listdir(f"{where}/{names['raw_table']}__runs") if d.startswith("run=")}
    assert held == {f"run={r}" for r in published[1:]}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_windows_and_joins_over_the_stored_table_neither_shuffle_nor_sort(spark, tmp_path, names, no_broadcast):
    """W1-W4 and J4/J5 over ``raw_combined``: files are bucketed and sorted, one per bucket and run."""
    from tickloom.operators.windows import with_daily_return, with_rolling

    out = str(tmp_path)
    write_combined(entry_module.user_combined(spark, SF).withColumn("processed_at", F.lit(RUN)), f"{out}/combined")
    for _ in range(3):
        publish_models(spark, out, buckets=4, **names)
    stored = spark.table(names["raw_table"])
    wanted = rows(mart_stock_performance(company_daily(read_combined(spark, f"{out}/combined"))))
    with runs.stored_layout(spark):
        for frame in (
            with_rolling(with_daily_return(stored)),
            mart_stock_performance(company_daily(stored)),
            mart_stock_performance(company_daily(stored, unique_key=False)),
        ):
            text = plan(frame)
            assert "Window" in text and "Exchange" not in text and "Sort [" not in text, text
            assert "Bucketed: true" in text and text.count("PartitionFilters: [isnotnull(run") == text.count("FileScan")
        joined = mart_stock_performance(company_daily(stored, unique_key=False))
        assert "SortMergeJoin" in plan(joined)
        assert rows(joined) == wanted == rows(mart_stock_performance(company_daily(stored)))
    assert "Exchange" in plan(with_daily_return(read_combined(spark, f"{out}/combined")))
    assert rows(spark.table(names["prefix"] + MARTS[0])) == wanted
    # Only the published run's files are read.
    assert all(f"run={runs.published_run(spark, names['pointer'])}" in f for f in stored.inputFiles())
