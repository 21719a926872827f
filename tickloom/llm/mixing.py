"""Mixing sources to target weights by whole copies and Pareto order sampling.

Every source gets a target number of words; its documents are wanted ``target / source size``
times each. The whole part of that is taken for certain as copies. The rest is an inclusion
probability: documents are ranked by the odds of a random number divided by their inclusion
odds, and the first of the ranking go in until the target is filled.

A ranking within a source never meets in one task: documents fall into bins of ranks, bins are
summed before the shuffle, and only the one bin that the target ends in is sorted, for each
source. Equal rows, which share a rank, are counted before that and told apart after it. Sources
are ranked in slices, so they may be as many as hosts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import broadcast_up_to, cut, shuffle_partitions, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Bins of ranks per source; the bin that a target ends in is sorted in one task.
BINS = 1 << 12
#: Equal rows that one row of a count is spread into at a time.
_SPREAD = 1 << 16


def random_number(*key: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) that depends on the key alone: 48 bits of an MD5."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs), a row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words.
    Targets stop at ``most`` times the source's size, and the excess goes to the others by weight
    until none is above. That is one level L with targets min(most * size, L * weight): sources
    with small size per weight are full first. With ``share`` over ``most`` all are full.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = _with_running(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"place": "one"})
    ranked = ranked.withColumn("weight", F.element_at(listed, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", most * F.col("source_size").cast("double"))
    # ``before`` and ``lighter`` are the caps and weights of the sources that are full earlier.
    by_need = [F.col("cap") / F.col("weight"), F.col("place")]
    placed = cut(_with_running(ranked, by_need, {"before": "cap", "lighter": "weight"}))
    sums = placed.agg(F.sum("source_size").cast("double").alias("words"), F.sum("weight").alias("weights")).first()
    words, weighed = F.lit(sums["words"] or 0.0) * share, F.lit(sums["weights"] or 0.0)
    # The level if this source and all after it were not full.
    level = (words - F.col("before")) / (weighed - F.col("lighter"))
    reach = placed.withColumn("level", level).withColumn("need", F.col("cap") / F.col("weight"))
    open_ = reach.filter(F.col("level") * F.col("weight") <= F.col("cap"))
    first = open_.agg(F.min(F.struct("need", "place", "level"))["level"].alias("level")).first()["level"]
    target = F.col("cap") if first is None else F.least("cap", F.lit(first) * F.col("weight"))
    return reach.select("source", "source_size", "n_docs", target.alias("target"))


def _with_running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add by name the sum of a column over the rows before each one in ``order``, which must be total.

    Rows are dealt into slices by range of the order and summed within them; only the slices' sums,
    one row each, meet in one task.
    """
    sliced = cut(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("slice", F.spark_partition_id()))
    inside = W.partitionBy("slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    totals = sliced.groupBy("slice").agg(*[F.sum(c).alias(f"sum_{n}") for n, c in sums.items()])
    starts = totals.select(
        F.col("slice").alias("start_of"), *[F.coalesce(F.sum(f"sum_{n}").over(earlier), F.lit(0)).alias(f"start_{n}") for n in sums]
    )
    own = sliced.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    joined = own.join(starts, F.col("slice") == F.col("start_of")).withColumns({n: F.col(n) + F.col(f"start_{n}") for n in sums})
    return joined.drop("slice", "start_of", *[f"start_{n}" for n in sums])


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    doc_weight: Column | None = None,
    bins: int = BINS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): what the mix takes of it.

    Returns doc_id, source, size, source_size, target, copies and taken (= copies * size).
    ``size`` is the number of words, 0 for null. A source takes whole documents until one more
    would bring its words no nearer its target, so it misses it by half of its longest document at
    most. ``doc_weight`` makes documents of a source more or less likely (mean 1; default 1 each);
    no document is taken more than ``most`` times. Documents without words are never taken. Ties
    of random numbers go by id and text hash; repeated rows share a number, are counted and are taken in turn. A null
    source is a source; null ids have their text's hash for a number. Reruns agree.
    """
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark"),
        (F.lit(1.0) if doc_weight is None else doc_weight.cast("double")).alias("weight"),
    )
    marked = marked.withColumn("u", random_number(F.coalesce(F.col("doc_id"), F.col("mark"))))
    marked = cut(marked)
    sizes = marked.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = cut(source_targets(sizes, weights, share, most))
    targets = broadcast_up_to(targets.select(F.col("source").alias("of"), "source_size", "target"))
    joined = marked.join(targets, F.col("source").eqNullSafe(F.col("of")))
    wanted = F.least(F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0)) * F.col("weight"), F.lit(float(most)))
    wanted = F.greatest(F.coalesce(wanted, F.lit(0.0)), F.lit(0.0))
    joined = joined.withColumn("wanted", wanted).withColumn("certain", F.floor("wanted"))
    chance = F.col("wanted") - F.col("certain")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.greatest(chance, F.lit(1e-12)) / (1 - F.least(chance, F.lit(1 - 1e-12))))
    odds = F.when(F.col("certain") < most, odds)
    # odds / (1 + odds) has the same order and lies in (0, 1).
    ranked = joined.withColumn("odds", odds).withColumn("bin", F.floor(F.col("odds") / (1 + F.col("odds")) * bins).cast("int"))
    ranked = ranked.withColumn("bin", F.when(F.col("size") > 0, F.col("bin")))
    summed = ranked.groupBy("of", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("sure"), F.first("target").alias("target")
    )
    per_source = W.partitionBy("of")
    rising = per_source.orderBy(F.col("bin").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = (
        summed.withColumn("need", F.col("target") - F.sum("sure").over(per_source))
        .filter(F.col("bin").isNotNull())
        .withColumn("upto", F.sum("words").over(rising))
        .groupBy("of")
        .agg(
            F.min(F.when(F.col("upto") > F.col("need"), F.struct("bin", (F.col("upto") - F.col("words")).alias("before")))).alias("end"),
            F.first("need").alias("need"),
        )
        .select(F.col("of").alias("end_of"), "end", "need")
    )
    placed = ranked.join(broadcast_up_to(cut(ends)), F.col("of").eqNullSafe(F.col("end_of")), "left")
    # A need of less than a word is rounding.
    inside = F.col("bin").isNotNull() & (F.col("need") >= 0.5)
    at_end = inside & (F.col("bin") == F.col("end.bin"))
    columns = ["doc_id", "source", "size", "source_size", "target", "certain"]
    rest = placed.filter(~F.coalesce(at_end, F.lit(False)))
    rest = rest.select(*columns, F.coalesce((inside & (F.col("end").isNull() | (F.col("bin") < F.col("end.bin")))), F.lit(False)).cast("int").alias("extra"))
    last = _fill(placed.filter(F.coalesce(at_end, F.lit(False))), columns)
    copies = F.when(F.col("size") > 0, F.col("certain") + F.col("extra")).otherwise(0).cast("long")
    return rest.unionByName(last).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def _fill(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``extra`` (0 or 1) of the rows in the bins that targets end in, taken in order of rank.

    Rows go in while they fit; the first that overshoots goes in if that is nearer, and none after
    it. Equal rows are one row with a count up to here and are told apart at the end, some
    thousands at a time, by all tasks.
    """
    spark = rows.sparkSession
    equal = rows.groupBy("of", "odds", "u", "mark", "need", F.col("end.before").alias("before"), *columns).agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("of").orderBy("odds", "u", "doc_id", "mark", "size", "certain")
    words = F.col("n") * F.col("size")
    so_far = F.col("before") + F.coalesce(F.sum(words).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    room = F.col("need") - so_far
    whole = F.least(F.greatest(F.floor(room / F.col("size")), F.lit(0)), F.col("n"))
    # What is left of the need when the whole ones are in; half a document or more brings one more in.
    left = room - whole * F.col("size")
    nearer = (left > 0) & (F.abs(F.col("size") - left) < left) & (whole < F.col("n"))
    taken = equal.withColumn("fit", whole + nearer.cast("int"))
    shares = F.array(
        F.struct(F.lit(1).alias("extra"), F.col("fit").alias("rows")), F.struct(F.lit(0).alias("extra"), (F.col("n") - F.col("fit")).alias("rows"))
    )
    counted = taken.select(*columns, F.explode(shares).alias("share")).filter("share.rows > 0")
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("share.rows") - 1, F.lit(_SPREAD).cast("long"))).alias("start")
    dealt = counted.select(*columns, "share", chunks).repartition(shuffle_partitions(spark))
    many = F.least(F.lit(_SPREAD).cast("long"), F.col("share.rows") - F.col("start"))
    return dealt.select(*columns, F.col("share.extra").alias("extra"), F.explode(F.sequence(F.lit(1).cast("long"), many)).alias("nth")).drop("nth")
