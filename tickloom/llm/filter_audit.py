"""How filters interact: what each removes in every order in which they may be applied.

The sets of filters already applied form a lattice; an order is a path from the empty set to the
whole one, and applying a filter is an edge. What an edge removes depends on its state alone, not
on how the state was reached. So rows are counted once by the set of filters they fail, and each
edge's counts follow from those sums. The orders that reach a state are counted forward over the
lattice and those that leave it backward: their product is the number of orders that use an edge,
and weights its removals in the filter's sum over all orders (its Shapley value times the number
of orders). The steps of each order are read from the same edges.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from hashlib import sha256
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import cut, unused_name, with_struct

#: Orders are listed for so many filters at most (5,040 orders of 7 steps).
MOST_ORDERED = 7
#: States and edges grow with 2**filters.
MOST_FILTERS = 12

# --- the lattice -----------------------------------------------------------------------------


def orders_through(n: int) -> dict[tuple[int, int], int]:
    """Number of orders of ``n`` filters that use each edge (state as a bit set, filter)."""
    whole = (1 << n) - 1
    reaching = [0] * (whole + 1)
    leaving = [0] * (whole + 1)
    reaching[0] = leaving[whole] = 1
    # A state's subsets are smaller numbers, its supersets larger ones.
    for state in range(1, whole + 1):
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in range(whole - 1, -1, -1):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(n) if not state >> f & 1)
    return {
        (state, f): reaching[state] * leaving[state | 1 << f]
        for state in range(whole + 1)
        for f in range(n)
        if not state >> f & 1
    }


def _edge_table(spark: SparkSession, n: int) -> DataFrame:
    rows = [(state, f, weight) for (state, f), weight in orders_through(n).items()]
    return spark.createDataFrame(rows, "state int, filter int, n_orders long")


def _step_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[k] for k in order), step, state, f))
            state |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")


# --- the audit -------------------------------------------------------------------------------


def edges(failed: DataFrame, n: int, part: str = "part", mask: str = "mask", weights: Sequence[str] = ("n",)) -> DataFrame:
    """What every edge of the lattice of ``n`` filters removes, for every part.

    ``failed`` has a part, the set of filters a row fails as the bits of ``mask`` and one or more
    ``weights`` to add up, the first of which counts rows. Rows may come one by one or counted. Nulls
    in the weights count 0 and a null mask fails nothing; a null part is a part.

    Returns part, state, filter, n_orders and of the rows before the edge ``kept`` and ``removed``,
    ``redundant`` (failing the filter but removed before), ``unique_fails`` (failing it alone),
    ``removed_<weight>`` for the other weights and ``shapley``, the filter's removals summed over all
    orders. No rows give no parts.
    """
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, got {n}")
    sums = [F.sum(F.coalesce(F.col(w), F.lit(0))).cast("long").alias(f"w{k}") for k, w in enumerate(weights)]
    counted = failed.groupBy(F.col(part).alias("part"), F.coalesce(F.col(mask), F.lit(0)).cast("int").alias("mask")).agg(*sums)
    # 2**n cells a part at most.
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *[f"w{k}" for k in range(len(weights))])).alias("cells"))
    places = cells.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n * 2**n - 1))))
    places = places.select("part", "cells", (F.col("place") / n).cast("int").alias("state"), (F.col("place") % n).cast("int").alias("filter"))
    places = places.withColumn("bit", F.expr("shiftleft(1, `filter`)")).filter(F.col("state").bitwiseAND(F.col("bit")) == 0)

    def total(weight: str, test) -> Column:
        hit = F.filter("cells", lambda c: test(c["mask"]))
        return F.aggregate(hit, F.lit(0).cast("long"), lambda acc, c: acc + c[weight])

    state, bit = F.col("state"), F.col("bit")
    there = lambda m: m.bitwiseAND(state) == 0
    gone = lambda m: (m.bitwiseAND(state) == 0) & (m.bitwiseAND(bit) != 0)
    made = places.select(
        "part",
        "state",
        "filter",
        (total("w0", there) - total("w0", gone)).alias("kept"),
        total("w0", gone).alias("removed"),
        total("w0", lambda m: (m.bitwiseAND(state) != 0) & (m.bitwiseAND(bit) != 0)).alias("redundant"),
        total("w0", lambda m: m == bit).alias("unique_fails"),
        *[total(f"w{k}", gone).alias(f"removed_{w}") for k, w in enumerate(weights) if k],
    )
    joined = made.join(F.broadcast(_edge_table(failed.sparkSession, n)), ["state", "filter"])
    of_filter = joined.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("n_orders")).alias("shapley"))
    of_filter = of_filter.select(F.col("part").alias("of_part"), F.col("filter").alias("of_filter"), "shapley")
    same = joined["part"].eqNullSafe(of_filter["of_part"]) & (joined["filter"] == of_filter["of_filter"])
    return joined.join(of_filter, same).drop("of_part", "of_filter")


def steps(edge_counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The edges in every order: filter_order (``names`` joined), step from 1, and the edge's columns."""
    if len(names) > MOST_ORDERED:
        raise ValueError(f"orders are listed for {MOST_ORDERED} filters at most; read edges() instead")
    return edge_counts.join(F.broadcast(_step_table(edge_counts.sparkSession, names)), ["state", "filter"])


# --- filters on texts ------------------------------------------------------------------------

LEAST_WORDS = 200
#: Percent of words that are different, and of characters that are A-Z.
LEAST_DIFFERENT = 50
MOST_UPPER = 3
#: A: few words, B: few different words, C: many capitals, D: special characters, E: a copy of an earlier text.
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")
_SPECIAL = re.compile(rb"[#$%&*|]")
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_PIECE = 1 << 22


def _words(text: bytes) -> tuple[int, int]:
    """Number of words and of different words. Pieces of a very long text are taken in turn, so that only
    its different words are held."""
    if len(text) <= _PIECE:
        words = text.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(text):
        blank = re.compile(rb"[\x20\x09-\x0D]").search(text, at + _PIECE)
        end = blank.start() if blank else len(text)
        words = text[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    n, different = _words(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    fails = (n < LEAST_WORDS, 100 * different < LEAST_DIFFERENT * n, 100 * upper > MOST_UPPER * points, _SPECIAL.search(text))
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def document_failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """Rows of ``docs`` counted: doc_id, part, mask of the failed ``FILTERS`` and n.

    Null texts count as empty, null parts as the empty string. A document fails E if its whole text
    (by SHA-256) also stands in a row with a smaller ``doc_id``, whatever its part; rows of one id do
    not make each other copies, and a null id is neither smaller nor larger than any.

    Equal rows are counted before any shuffle, and the first id of a text comes from an aggregate,
    so neither a much copied text nor a much repeated row gathers in one task.
    """
    fields = [T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())]

    def compute(texts: list[bytes | None]) -> list:
        own = [t or b"" for t in texts]
        return [pa.array([text_failures(t) for t in own], pa.int32()), [sha256(t).digest() for t in own]]

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    name = unused_name(source, "made")
    judged = with_struct(source, "text", fields, compute, name, ["doc_id", "part"]).select("doc_id", "part", f"{name}.*")
    rows = cut(judged.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = rows.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    first = first.select(F.col("digest").alias("of_digest"), "first_id")
    same = (rows["doc_id"] == first["first_id"]) & (rows["digest"] == first["of_digest"])
    copy = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    mask = F.col("mask").bitwiseOR(F.when(copy, _COPY).otherwise(0))
    return rows.join(first, same, "left").select("doc_id", "part", mask.alias("mask"), "n")


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The five ``FILTERS`` on ``docs`` in all orders, with the good and toxic documents lost.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley; all orders and steps for every part, zeros included, and no rows for no documents.
    ``labels`` (doc_id, quality, toxic) marks a document good or toxic where any of its rows says 1; its
    rows may repeat, nulls say nothing.
    """
    said = lambda name: F.max((F.coalesce(F.col(name), F.lit(0)) == 1).cast("long"))
    known = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    )
    rows = document_failures(docs, part).join(known, F.col("doc_id") == F.col("labelled"), "left")
    weighted = rows.select("part", "mask", "n", (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"))
    found = steps(edges(weighted, len(FILTERS), weights=("n", "good", "toxic")), FILTERS)
    return found.select(
        "part",
        "filter_order",
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        F.col("removed_good").alias("good_lost"),
        F.col("removed_toxic").alias("toxic_lost"),
        "shapley",
    )
