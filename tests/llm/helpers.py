"""Small tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))


def documents(spark, rows, extra=False):
    """Rows (doc_id, text) or (doc_id, text, source) as ``documents``; ``extra`` adds clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
    if extra:
        names = (
            "block", "bucket", "fp", "row", "stats", "quality", "found", "lines", "gone", "of", "size", "u", "bin", "made",
            "content", "host", "canon", "known_digest", "labelled", "is_target", "first_id", "component_id", "target",
        )
        df = df.select("*", *[F.lit(f"extra {n}").alias(n) for n in names])
    return df


def prose(seed: int, n: int, words: int = 400) -> str:
    """Seeded text of ``n`` words."""
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(words)}" for _ in range(n))


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}
