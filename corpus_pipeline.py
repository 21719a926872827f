"""A corpus pipeline: documents in, a weighted mix of good, different, uncontaminated ones out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents`` (doc_id, text, lang, source, n_chars and whatever else the table has).
Every stage judges all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import new_folder, unused_name
from tickloom.llm.decontaminate import drop_contaminated
from tickloom.llm.line_dedup import drop_boilerplate
from tickloom.llm.mixing import mix
from tickloom.llm.quality_rules import fit_rules, keep_good
from tickloom.llm.simhash import keep_one_of_each

#: A line of a source is boilerplate on over this share of its pages, and on so many pages.
BOILERPLATE_RATIO = 0.01
BOILERPLATE_PAGES = 3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The rules are learned from the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_rules(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its texts; ``n_chars`` follows. No document goes."""
    name = unused_name(docs, "lines")
    made = drop_boilerplate(docs, F.col("source"), name, BOILERPLATE_RATIO, BOILERPLATE_PAGES)
    new = {"text": F.col(f"{name}.text"), "n_chars": F.length(f"{name}.text").cast("long")}
    return made.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: those whose SimHash fingerprints link at 4 or fewer bits."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, and so how many of its words."""
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The learned rules and XXH64 are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
