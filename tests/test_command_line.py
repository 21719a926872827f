import json

import pytest
from pyspark.sql import functions as F

from tests.test_sources import bar, bar_document, write
from tickloom.__main__ import arguments, main


def test_process_and_publish(spark, tmp_path, capsys):
    write(tmp_path / "raw" / "stocks", "A.json", bar_document("A", {"2026-03-16": bar("1"), "2026-03-17": bar("x")}))
    out = str(tmp_path / "out")
    main(["process", str(tmp_path / "raw"), out, "--quarantine", str(tmp_path / "bad")])
    printed = capsys.readouterr().out
    assert json.loads(printed.splitlines()[0]) == {"stocks": {"rows": 2, "not_accepted": 1}, "combined": {"rows": 1}}
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    main(["publish", out])
    assert spark.table("mart_stock_performance").count() == 1


def test_ingest(spark, tmp_path, capsys):
    rows = [("A", json.dumps(bar_document("A", {"2026-03-16": bar()})).replace('"_ticker": "A", ', "").replace(
        ', "_ingested_at": "2026-03-18"', "").replace('"_ingested_at": "2026-03-18", ', ""))]
    spark.createDataFrame(rows, "ticker string, payload string").write.parquet(str(tmp_path / "responses"))
    main(["ingest", str(tmp_path / "responses"), str(tmp_path / "raw"), "stocks", "2026-03-16"])
    assert json.loads(capsys.readouterr().out) == {"success_count": 1, "skip_count": 0, "error_count": 0}


def test_activity(spark, tmp_path, capsys):
    rows = [("MSFT", "vscode", "2026-03-16", 5, 1, 3, 2), ("MSFT", "vscode", "2026-03-17", 6, 1, 4, 2)]
    facts = spark.createDataFrame(rows, "ticker string, repo string, date string, stars long, forks long, commits_today long, open_prs long")
    facts.withColumn("date", F.col("date").cast("date")).write.parquet(str(tmp_path / "facts"))
    for expected in ({"success_count": 5, "skip_count": 0, "error_count": 0}, {"success_count": 0, "skip_count": 5, "error_count": 0}):
        main(["activity", str(tmp_path / "facts"), str(tmp_path / "raw"), "2026-03-16"])
        assert json.loads(capsys.readouterr().out) == expected


def test_streams(spark, tmp_path):
    write(tmp_path / "raw" / "stocks", "A.json", bar_document("A", {"2026-03-16": bar("1")}))
    for job in ("land", "correct"):
        main([job, str(tmp_path / "raw"), str(tmp_path / job)])
        assert spark.read.parquet(str(tmp_path / job)).count() == 1


def test_unknown_source_is_refused():
    with pytest.raises(SystemExit):
        arguments(["ingest", "r", "root", "tape", "2026-03-16"])
