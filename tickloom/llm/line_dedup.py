"""Boilerplate lines by their frequency relative to the site.

A line that a large share of one site's pages hold is boilerplate of that site. Pages are
grouped by host; the number of different pages with a line divided by the number of different
pages of the host is the line's ratio, and lines above a limit go. Only DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from hashlib import md5
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut, unused_name

RATIO = 0.1
MIN_PAGES = 5
#: The lists go to the tasks while they hold so many lines at most; beyond, the join shuffles.
MOST_BROADCAST = 100_000
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_KEY = md5(b"").hexdigest()


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _bare(line: Column) -> Column:
    """A line without white space at its ends. Trimming walks the whole line, so only one that has some is trimmed."""
    at_ends = [end for c in _BLANKS for end in (line.startswith(c), line.endswith(c))]
    return F.when(reduce(or_, at_ends), F.trim(line, F.lit(_BLANKS))).otherwise(line)


def _key(line: Column) -> Column:
    """A line's identity: its MD5 without white space at the ends; ``_BLANK_KEY`` for blank lines."""
    return F.md5(_bare(line))


def boilerplate_lines(docs: DataFrame, host: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_key, n_pages, n_host_pages) of the lines above ``ratio`` on ``min_pages`` pages or more.

    Copies of a page (equal host and text) count as one page, or a much copied page would make
    boilerplate of all its lines. Pages without text count for the host. A null host is a host.
    """
    page = F.xxhash64(F.coalesce("text", F.lit(""))).alias("page")
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), _key), lambda k: k != _BLANK_KEY))
    pages = docs.select(host.cast("string").alias("host"), page, F.explode(keys).alias("line_key"))
    counts = pages.distinct().groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("n_pages"))
    lines = counts.filter(F.col("n_pages") >= min_pages)
    hosts = docs.select(host.cast("string").alias("of"), page).distinct().groupBy("of").agg(F.count(F.lit(1)).alias("n_host_pages"))
    joined = lines.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    return joined.filter(F.col("n_pages") > ratio * F.col("n_host_pages")).select(
        "host", "line_key", "n_pages", "n_host_pages"
    )


def drop_boilerplate(
    docs: DataFrame,
    host: Column,
    name: str = "lines",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Add the struct ``name`` to ``docs``: n_lines, n_removed and the remaining text.

    ``docs`` needs a column ``text``. A line is what stands between newlines; it is compared
    without white space at its ends and kept as it is. Blank lines always stay. Lines are counted
    once a page, and the rest of a text is joined by newlines in its order. A null text stays null
    with no lines, an empty one has one blank line. Hosts with fewer than ``min_pages`` pages lose
    nothing.

    A page with ``n`` lines brings ``n`` entries, so a host has at most (lines per page) / ``ratio``
    boilerplate lines: that bounds the list each host's rows are compared with.
    """
    found = cut(boilerplate_lines(docs, host, ratio, min_pages))
    few = found.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    lists = found.groupBy(F.col("host").alias("of")).agg(F.sort_array(F.collect_list("line_key")).alias("gone"))
    of, gone, all_lines, rest = (unused_name(docs, c) for c in ("of", "gone", "all_lines", "rest"))
    lists = lists.select(F.col("of").alias(of), F.col("gone").alias(gone))
    joined = docs.join(F.broadcast(lists) if few else lists, host.cast("string").eqNullSafe(F.col(of)), "left")
    # Columns of their own, so that lines are split and looked up once, however often they are used.
    split = joined.withColumn(all_lines, _lines(F.col("text")))
    stays = F.filter(all_lines, lambda x: ~F.array_contains(F.col(gone), _key(x)))
    kept = split.withColumn(rest, F.when(F.col(gone).isNull(), F.col(all_lines)).otherwise(stays))
    left = F.when(F.col("text").isNotNull(), F.array_join(rest, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    n_left = F.when(F.col("text").isNull(), 0).otherwise(F.size(rest)).cast("long")
    made = F.struct(n_lines.alias("n_lines"), (n_lines - n_left).alias("n_removed"), left.alias("text"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], made.alias(name))
