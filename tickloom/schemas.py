"""Declared schemas: vendor documents, typed feeds, the combined table.

Numbers in vendor documents are declared as strings on purpose: bars carry them as text
anyway, and a field of the wrong kind then spoils one value instead of the whole document.
The ``parse_*`` functions give them their types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(spec: dict) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in spec.items()])


S, D, L = StringType(), DoubleType(), LongType()

KEYS = ("ticker", "date")
VERSION = ("_ingested_at", "_file_path")

# --- vendor documents (fixed field names of the three feeds) -----------------------------

SERIES_FIELD = "Time Series (Daily)"
BAR_FIELDS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "volume": "5. volume",
}
AGGREGATE_FIELDS = {
    "poly_open": "o",
    "poly_high": "h",
    "poly_low": "l",
    "poly_close": "c",
    "poly_volume": "v",
    "vwap": "vw",
    "transactions": "n",
}
ACTIVITY_FIELDS = (
    "total_commits_today",
    "total_open_prs",
    "total_stars",
    "total_forks",
    "repos_tracked",
)
REPO_DETAIL_FIELDS = ("stars", "forks", "commits_today", "open_prs")

CORRUPT = {"_corrupt_record": S}

# The dates of a series are object keys, so the series is a map: inference would add one
# struct field per date.
BAR_DOCUMENT = _struct(
    {
        "_ticker": S,
        "_ingested_at": S,
        SERIES_FIELD: MapType(S, _struct({f: S for f in BAR_FIELDS.values()})),
        "Meta Data": MapType(S, S),
        "Error Message": S,
        "Note": S,
        **CORRUPT,
    }
)
AGGREGATE_DOCUMENT = _struct(
    {
        "_ticker": S,
        "_trading_date": S,
        "_ingested_at": S,
        "status": S,
        "error": S,
        "resultsCount": S,
        "results": ArrayType(_struct({f: S for f in AGGREGATE_FIELDS.values()})),
        **CORRUPT,
    }
)
ACTIVITY_DOCUMENT = _struct(
    {
        "ticker": S,
        "github_org": S,
        "date": S,
        **{f: S for f in ACTIVITY_FIELDS},
        "_ingested_at": S,
        "repo_details": ArrayType(_struct({"repo": S, **{f: S for f in REPO_DETAIL_FIELDS}})),
        **CORRUPT,
    }
)

# --- typed feeds -------------------------------------------------------------------------

_KEY_SPEC = {"ticker": S, "date": DateType()}
_BAR_SPEC = {"open_price": D, "high_price": D, "low_price": D, "close_price": D, "volume": L}
_AGG_SPEC = {
    "poly_open": D,
    "poly_high": D,
    "poly_low": D,
    "poly_close": D,
    "poly_volume": D,
    "vwap": D,
    "transactions": L,
}
_ACTIVITY_SPEC = {f: L for f in ACTIVITY_FIELDS}
_VERSION_SPEC = {f: S for f in VERSION}

BARS = _struct({**_KEY_SPEC, **_BAR_SPEC})
VERSIONED_BARS = _struct({**_KEY_SPEC, **_BAR_SPEC, **_VERSION_SPEC})
LANDED_BARS = _struct({**_KEY_SPEC, **_BAR_SPEC, **_VERSION_SPEC, "verdict": S})
# What is computed from a bar and the bars before it.
_COMPUTED_SPEC = {"daily_return_pct": D, "moving_avg_7d": D, "moving_avg_20d": D, "volatility_7d": D}
CORRECTED_BARS = _struct({**_KEY_SPEC, **_BAR_SPEC, **_COMPUTED_SPEC, **_VERSION_SPEC})
AGGREGATES = _struct({**_KEY_SPEC, **_AGG_SPEC})
ACTIVITY = _struct({**_KEY_SPEC, **_ACTIVITY_SPEC})

BAR_VALUES = tuple(_BAR_SPEC)
COMPUTED_VALUES = tuple(_COMPUTED_SPEC)
AGGREGATE_VALUES = tuple(_AGG_SPEC)
ACTIVITY_VALUES = tuple(_ACTIVITY_SPEC)

# Width and types never depend on which sources were present.
COMBINED = _struct(
    {
        **_KEY_SPEC,
        **_BAR_SPEC,
        "daily_return_pct": D,
        **_AGG_SPEC,
        **_ACTIVITY_SPEC,
        "processed_at": TimestampType(),
    }
)
