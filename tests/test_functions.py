import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickloom import functions as fn

D = dt.date


def evaluate(spark, column, **values):
    row = spark.range(1).select([F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x"))
    return row.first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("2026-03-17", D(2026, 3, 17)),
        ("2024-02-29", D(2024, 2, 29)),
        ("2023-02-29", None),
        ("2026-13-01", None),
        ("2026-3-1", None),
        ("2026", None),
        ("2026-03-17T00:00:00", None),
        ("", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert evaluate(spark, fn.parse_date(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "day, want",
    [
        (D(2026, 3, 16), D(2026, 3, 13)),  # Monday
        (D(2026, 3, 15), D(2026, 3, 13)),  # Sunday
        (D(2026, 3, 14), D(2026, 3, 13)),  # Saturday
        (D(2026, 3, 17), D(2026, 3, 16)),  # Tuesday
        (D(2026, 1, 1), D(2025, 12, 31)),
    ],
)
def test_last_trading_day(spark, day, want):
    assert evaluate(spark, fn.last_trading_day(F.lit(day))) == want


def test_key_texts(spark):
    day = F.lit(D(2026, 3, 7))
    assert evaluate(spark, fn.doc_key(F.lit("MSFT"), day)) == "MSFT_2026-03-07.json"
    assert evaluate(spark, fn.day_start(day)) == "2026-03-07T00:00:00Z"
    assert evaluate(spark, fn.run_date_text(day)) == "2026-03-07"
    assert evaluate(spark, fn.run_date_text()) == str(spark.sql("select current_date() d").first().d)


@pytest.mark.parametrize(
    "text, kind, want",
    [("212.25", "double", 212.25), (" 1.5 ", "double", 1.5), ("x", "double", None), ("", "double", None),
     ("1e3", "double", 1000.0), ("12", "bigint", 12), ("12.5", "bigint", None), ("-3", "bigint", -3),
     ("99999999999999999999", "bigint", None), (None, "double", None), ("12d", "double", None), ("1f", "double", None),
     ("0x1p3", "double", None), ("NaN", "double", None), ("Infinity", "double", None), ("-inf", "double", None),
     ("1e400", "double", None), (".5", "double", 0.5), ("+7.", "double", 7.0), ("12L", "bigint", None)],
)
def test_to_number(spark, text, kind, want):
    assert evaluate(spark, fn.to_number(F.lit(text).cast("string"), kind)) == want


@pytest.mark.parametrize("text, want", [("12", 12), ("12.0", 12), ("12.9", None), ("12d", None), ("1.2e1", 12), ("n", None), (None, None), ("1e400", None)])
def test_to_count(spark, text, want):
    assert evaluate(spark, fn.to_count(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "value, want",
    [(1.23454, 1.2345), (1.23456, 1.2346), (0.00005, 0.0001), (-0.00005, -0.0001), (2.0, 2.0), (None, None), (1e25, 1e25),
     (math.inf, math.inf)],
)
def test_round4(spark, value, want):
    assert evaluate(spark, fn.round4(F.lit(value).cast("double"))) == want


def test_round4_ignores_the_last_bits(spark):
    assert evaluate(spark, fn.round4(F.lit(0.12345 - 1e-15))) == evaluate(spark, fn.round4(F.lit(0.12345 + 1e-15)))


@pytest.mark.parametrize("cur, prev, want", [(404.0, 400.0, 1.0), (5.0, 0.0, None), (5.0, None, None), (None, 5.0, None), (0.0, 4.0, -100.0)])
def test_pct_change(spark, cur, prev, want):
    got = evaluate(spark, fn.pct_change(F.lit(cur).cast("double"), F.lit(prev).cast("double")))
    assert got == want


@pytest.mark.parametrize("commits, prs, want", [(2, 3, 5), (None, 3, 3), (2, None, 2), (None, None, 0)])
def test_activity_score(spark, commits, prs, want):
    assert evaluate(spark, fn.activity_score(F.lit(commits).cast("bigint"), F.lit(prs).cast("bigint"))) == want


@pytest.mark.parametrize("commits, want", [(10, False), (11, True), (None, False), (0, False)])
def test_high_activity(spark, commits, want):
    assert evaluate(spark, fn.high_activity(F.lit(commits).cast("bigint"))) is want


def test_is_malformed(spark):
    text = F.lit("x")
    assert evaluate(spark, fn.is_malformed(text, fn.to_number(text))) is True
    missing = F.lit(None).cast("string")
    assert evaluate(spark, fn.is_malformed(missing, fn.to_number(missing))) is False
