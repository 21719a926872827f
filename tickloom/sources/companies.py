"""The tracked companies as a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Ticker, organisation, tracked repositories.
COMPANY_ROWS = (
    ("MSFT", "microsoft", ("vscode", "TypeScript", "terminal")),
    ("GOOGL", "google", ("material-design-icons", "guava", "gson")),
    ("META", "facebook", ("react", "react-native", "folly")),
    ("AAPL", "apple", ("swift-nio", "swift-collections", "swift-algorithms")),
    ("AMZN", "aws", ("aws-cli", "aws-sdk-js-v3", "aws-cdk")),
)


def companies(spark: SparkSession, rows=COMPANY_ROWS) -> DataFrame:
    """``(ticker, org, repos)``, one row per company.

    Written as a VALUES list, so the optimizer knows its exact size and chooses by itself,
    under ``spark.sql.autoBroadcastJoinThreshold``, whether to broadcast it.
    """
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join(
        f"({quoted(ticker)}, {quoted(org)}, array({', '.join(map(quoted, repos))}))" for ticker, org, repos in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(ticker, org, repos)")
