"""Developer activity: counts per repository, facts, and the roll-up per company and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import default0

REPO_DAY = ("ticker", "repo", "date")
FACTS = ("stars", "forks", "commits_today", "open_prs")
TOTALS = {
    "total_commits_today": "commits_today",
    "total_open_prs": "open_prs",
    "total_stars": "stars",
    "total_forks": "forks",
}


def commits_on(commits: DataFrame, run_date: dt.date | str, ts: str = "ts") -> DataFrame:
    """Commits from the start of ``run_date`` (UTC) on. Compared as-is, so the scan gets the filter."""
    kind = commits.schema[ts].dataType.simpleString()
    return commits.where(F.col(ts) >= F.lit(f"{run_date}T00:00:00Z").cast(kind))


def open_prs(pull_requests: DataFrame, state: str = "state") -> DataFrame:
    return pull_requests.where(F.col(state) == "open")


def count_per_key(df: DataFrame, keys=REPO_DAY, name: str = "n") -> DataFrame:
    """All rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def repo_facts(stats: DataFrame, commits: DataFrame, pull_requests: DataFrame, keys=REPO_DAY) -> DataFrame:
    """Stars, forks, commits and open pull requests of repositories that have all three facts.

    Each input has one row per key and is partitioned by it already, so no join shuffles.
    """
    keys = list(keys)
    return stats.join(commits, keys).join(pull_requests, keys)


def activity_rollup(facts: DataFrame, companies: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """Totals per company and day over its tracked repositories.

    A repository without facts adds nothing but still counts in ``repos_tracked``. With
    ``run_date`` every company gets a row for that day, zeros if nothing was collected.
    """
    tracked = companies.select(
        "ticker", F.col("org").alias("github_org"), F.size("repos").cast("bigint").alias("repos_tracked"), "repos"
    )
    # Facts hold a repository once a day and only tracked ones stay, so a list is no longer than ``repos``.
    in_order = F.struct(F.array_position("repos", F.col("repo")).alias("position"), "repo", *FACTS)
    company_day = ["ticker", "github_org", "repos_tracked", "date"]
    totals = (
        facts.join(tracked, "ticker")
        .where(F.array_contains("repos", F.col("repo")))
        .groupBy(*company_day)
        .agg(
            *[F.sum(fact).alias(total) for total, fact in TOTALS.items()],
            F.sort_array(F.collect_list(in_order)).alias("_ordered"),
        )
        .withColumn("repo_details", F.transform("_ordered", lambda d: d.dropFields("position")))
    )
    if run_date is not None:
        days = tracked.drop("repos").withColumn("date", F.lit(str(run_date)).cast("date"))
        totals = days.join(totals, company_day, "left")
    no_details = F.array().cast(totals.schema["repo_details"].dataType)
    return totals.select(
        "ticker",
        "github_org",
        "date",
        *[default0(F.col(c)).alias(c) for c in TOTALS],
        "repos_tracked",
        F.coalesce("repo_details", no_details).alias("repo_details"),
    )


def repo_rows(rollup: DataFrame) -> DataFrame:
    """The nested per-repository details as rows."""
    return rollup.select("ticker", "date", F.explode("repo_details").alias("d")).select("ticker", "date", "d.*")


def as_responses(rollup: DataFrame) -> DataFrame:
    """Roll-up rows as ``(ticker, payload)`` activity documents, ready to be landed."""
    document = F.struct(*[F.col(c).cast("string").alias(c) if c == "date" else F.col(c) for c in rollup.columns])
    return rollup.select("ticker", F.to_json(document).alias("payload"))
