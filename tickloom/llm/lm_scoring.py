"""Cross-entropy difference of documents under a target and a background n-gram model.

Both are class bigram models over one shared vocabulary, the words of the training rows. A word that makes up
at least 2**-14 of them (``FREQUENT``; so there are at most 16,384) is a class of its own; the others share
classes by their length and last byte. A word's probability is that of its class after the class before
it, interpolated with the class alone, times that of the word within its class. Both models are matched:
the background counts, taken over all training rows, are scaled to the target's number of words, so
neither is smoother for its size.

Words and class bigrams are counted in the map tasks and added up by Spark; both tables grow with the
corpus and stay in Spark. A token's loss is what its classes give if neither its bigram nor its word was ever
counted, which a table of classes tells, and a correction for each of the two that was. Corrections
of the most frequent entries (at most ``MOST_HOT``) go to the workers, which add them up per document; the
rest are joined by key. Texts are read where they lie and never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import as_bytes, broadcast_up_to, held_by_worker, mix, new_folder, text_blob, unused_name, word_ids

#: Share of all words that makes a word a class of its own.
FREQUENT = 2.0**-14
#: Pseudo-counts with which a class trusts its bigrams' back-off.
TRUST = 5.0
#: Corrections that go to the workers, 32 bytes each.
MOST_HOT = 1 << 20
#: Ids of target documents that go to the tasks; beyond, the join shuffles.
MOST_BROADCAST = 1_000_000
#: The end of a text, which also stands before its first word.
END = 0
#: First key of a word's entry, where a bigram has the class before. No class: those are END, shapes, or hashes.
WORD_KEY = 1 << 20
#: Bytes of text that a worker takes out of its batch at a time; its arrays need some twenty times as much.
_SLICE = 1 << 22


def shape(length: int, last: int) -> int:
    """The class of words that are not frequent: by bytes up to 15 and the last byte."""
    return 1 + (min(length, 15) << 8 | last)


class Tokens:
    """The words of some texts, each text with its end."""

    def __init__(self, texts: Sequence[bytes]):
        ids, different, counts = word_ids(texts)
        edges = np.zeros(1, np.int64)
        letters = b""
        if len(different):
            _, offsets, data = different.buffers()
            edges, letters = np.frombuffer(offsets, np.int64)[: len(different) + 1], data.to_pybytes()
        hashed = [xxhash.xxh3_64_intdigest(letters[a:b]) for a, b in pairwise(edges.tolist())]
        last = np.frombuffer(letters, np.uint8)[edges[1:] - 1].astype(np.int64)
        #: 64 bits of XXH3 and the shape of each different word, the end last.
        self.hashes = np.append(np.array(hashed, np.uint64).view(np.int64), END)
        self.shapes = np.append(1 + (np.minimum(np.diff(edges), 15) << 8 | last), END)
        self.n = counts + 1
        ends = np.cumsum(self.n) - 1
        #: Place of every token among the different ones.
        self.at = np.full(int(self.n.sum()), len(hashed), np.int64)
        inner = np.ones(len(self.at), bool)
        inner[ends] = False
        self.at[inner] = ids
        self.starts = ends - counts

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)

    def classes(self, frequent: np.ndarray) -> np.ndarray:
        """The class of each different word, ``frequent`` being the sorted hashes of those that are their own."""
        return np.where(np.isin(self.hashes, frequent), self.hashes, self.shapes)

    def bigrams(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different bigrams, as class before and class, and the place of every token's own among them."""
        values, dense = np.unique(classes, return_inverse=True)
        after = dense[self.at]
        before = np.concatenate([dense[-1:], after[:-1]])
        codes, own = np.unique(before * len(values) + after, return_inverse=True)
        return values[codes // len(values)], values[codes % len(values)], own


def text_slices(column: pa.Array, rows: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """``rows`` of a text column in consecutive parts of about ``_SLICE`` bytes, a longer text alone, with their texts.

    A part's texts are copied when its turn comes, so a worker never holds a batch twice.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)[rows] + 1, dtype=np.int64)
    lo = 0
    while lo < len(rows):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + _SLICE, "right")))
        yield rows[lo:hi], text_blob(as_bytes(column.take(pa.array(rows[lo:hi]))))
        lo = hi


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tokens, np.ndarray]]:
    for batch in batches:
        flags = np.array([bool(f) for f in batch.column("is_target").to_pylist()], np.int64)
        for rows, texts in text_slices(batch.column("text"), np.arange(batch.num_rows)):
            tokens = Tokens(texts)
            yield tokens, np.repeat(flags[rows], tokens.n)


def _counts(places: np.ndarray, flags: np.ndarray, size: int) -> list[np.ndarray]:
    """Target and background counts of each place."""
    return [np.bincount(places, flags, size).astype(np.int64), np.bincount(places, minlength=size)]


def _added(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy("k1", "k2").agg(F.sum("target").alias("target"), F.sum("background").alias("background"), *more)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def count_words(training: DataFrame) -> DataFrame:
    """(k1, k2, target, background, shape) of every word of ``training``; ``k2`` is its hash, or END for the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, flags in _tokens(batches):
            size = len(tokens.hashes)
            columns = [np.full(size, WORD_KEY), tokens.hashes, *_counts(tokens.at, flags, size), tokens.shapes.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "k2", "target", "background", "shape"])

    return _added(training.mapInArrow(run, "k1 long, k2 long, target long, background long, shape int"), F.max("shape").alias("shape"))


def count_bigrams(training: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(k1, k2, target, background) of every class bigram: the class before, END at the beginning, and the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, flags in _tokens(batches):
            before, after, own = tokens.bigrams(tokens.classes(frequent))
            columns = [before, after, *_counts(own, flags, len(before))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "k2", "target", "background"])

    return _added(training.mapInArrow(run, "k1 long, k2 long, target long, background long"))


class Classes:
    """The class table of both models: at most one row for each frequent word and each shape.

    ``rows`` are (class, target, background, words); ``scale`` matches the background to the target.
    """

    def __init__(self, rows: Sequence[tuple], frequent: np.ndarray, scale: float):
        rows = sorted(rows)
        self.frequent, self.scale = frequent, scale
        self.ids = np.array([r[0] for r in rows], np.int64)
        # What no training row holds comes last.
        counts = [np.array([*[r[1] for r in rows], 0], float), np.array([*[r[2] for r in rows], 0], float) * scale]
        words = np.array([*[r[3] for r in rows], 0], float)
        alone = np.isin(np.append(self.ids, -1), np.append(frequent, END))
        alone[-1] = False
        #: log(TRUST * p(class)) of each model.
        self.backed = [np.log(TRUST * (n + 1) / (n.sum() + len(n))) for n in counts]
        #: Loss of a token of the class beside what its context adds, bigram and word unseen.
        self.token = [np.where(alone, 0, np.log(n + words + 1)) - b for n, b in zip(counts, self.backed, strict=True)]
        self.context = [np.log(n + TRUST) for n in counts]

    def place(self, classes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ids, classes)
        known = self.ids[np.minimum(at, len(self.ids) - 1)] == classes if len(self.ids) else np.zeros(len(classes), bool)
        return np.where(known, at, len(self.ids))


def corrections(words: DataFrame, bigrams: DataFrame, classes: Classes) -> DataFrame:
    """(k1, k2, target, background, total): what a counted entry adds to the losses, and how often it was counted."""
    spark, scale = words.sparkSession, F.lit(classes.scale)
    total = F.col("background").alias("total")
    alone = spark.createDataFrame([(int(h),) for h in {END, *classes.frequent.tolist()}], "own long")
    rare = words.join(F.broadcast(alone), F.col("k2") == F.col("own"), "left_anti")
    of_words = rare.select("k1", "k2", (-F.log1p("target")).alias("target"), (-F.log1p(scale * F.col("background"))).alias("background"), total)
    backed = [(int(c), float(t), float(b)) for c, t, b in zip(classes.ids, *(x[:-1] for x in classes.backed), strict=True)]
    joined = bigrams.join(F.broadcast(spark.createDataFrame(backed, "own long, t double, b double")), F.col("k2") == F.col("own"))
    target = F.col("t") - F.log(F.col("target") + F.exp("t"))
    background = F.col("b") - F.log(scale * F.col("background") + F.exp("b"))
    return of_words.unionByName(joined.select("k1", "k2", target.alias("target"), background.alias("background"), total))


def hot_limit(found: DataFrame, most: int = MOST_HOT) -> int:
    """The least ``total`` that no more than ``most`` entries of ``found`` reach, by steps of a quarter of a power of two."""
    step = F.floor(4 * F.log2("total")).alias("step")
    sizes = found.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("least"), F.max("total").alias("most"))
    limit, held = None, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["step"]):
        limit = row["most"] + 1 if limit is None else limit
        if held + row["n"] > most:
            break
        held, limit = held + row["n"], row["least"]
    return limit or 1


class Hot:
    """Corrections by key, those of the frequent entries."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray, target: np.ndarray, background: np.ndarray):
        self.seed = 0
        while True:
            keys = self._key(k1, k2)
            order = np.argsort(keys)
            if len(keys) < 2 or (np.diff(keys[order]) != 0).all():
                break
            self.seed += 1
        self.keys, self.k1, self.k2 = keys[order], k1[order], k2[order]
        self.values = [target[order], background[order]]

    def _key(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return mix(mix(k1.view(np.uint64) + np.uint64(self.seed)) ^ k2.view(np.uint64))

    def find(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entries are here, and what they add to both losses, 0 for the others."""
        if not len(self.keys) or not len(k1):
            return np.zeros(len(k1), bool), np.zeros(len(k1)), np.zeros(len(k1))
        at = np.minimum(np.searchsorted(self.keys, self._key(k1, k2)), len(self.keys) - 1)
        here = (self.k1[at] == k1) & (self.k2[at] == k2)
        return here, *(np.where(here, v[at], 0.0) for v in self.values)


def score_texts(texts: Sequence[bytes], classes: Classes, hot: Hot) -> tuple[Tokens, list[np.ndarray], tuple[np.ndarray, ...]]:
    """The tokens, each text's two sums of losses as far as they are known here, and (text, k1, k2, n) of entries to look up."""
    tokens = Tokens(texts)
    own = tokens.classes(classes.frequent)
    rare = own != tokens.hashes
    before, after, pair = tokens.bigrams(own)
    pair_here, *pair_adds = hot.find(before, after)
    word_here, *word_adds = hot.find(np.full(len(own), WORD_KEY), tokens.hashes)
    at, at_before, at_after = classes.place(own), classes.place(before), classes.place(after)
    sums = []
    for which in (0, 1):
        by_pair = classes.context[which][at_before] + pair_adds[which]
        by_word = classes.token[which][at] + np.where(rare, word_adds[which], 0)
        sums.append(np.add.reduceat(by_pair[pair] + by_word[tokens.at], tokens.starts))
    text = tokens.text_of()
    missing = []
    # A bigram with a class that no training row holds was never counted.
    wanted = ~pair_here & (at_before < len(classes.ids)) & (at_after < len(classes.ids))
    for places, asked, k1, k2 in ((pair, wanted, before, after), (tokens.at, rare & ~word_here, np.full(len(own), WORD_KEY), tokens.hashes)):
        take = asked[places]
        code, n = np.unique(text[take] * len(k1) + places[take], return_counts=True)
        missing.append((code // len(k1), k1[code % len(k1)], k2[code % len(k1)], n))
    return tokens, sums, tuple(np.concatenate(c) for c in zip(*missing, strict=True))


_PARTS = "d1 long, d2 long, k1 long, k2 long, n long, n_tokens long, target double, background double"


def score_batch(batch: pa.RecordBatch, classes: Classes, hot: Hot) -> Iterator[pa.RecordBatch]:
    """The rows ``_PARTS`` of a batch (text, d1, d2), its copies once: each text's sums, and what is to be looked up for it."""
    names = [c.split()[0] for c in _PARTS.split(", ")]
    d = np.stack([batch.column(c).to_numpy() for c in ("d1", "d2")], axis=1)
    # Copies have the same mean, so one of a batch stands for all.
    _, first = np.unique(d, axis=0, return_index=True)
    for rows, texts in text_slices(batch.column("text"), np.sort(first)):
        tokens, sums, (text, k1, k2, n) = score_texts(texts, classes, hot)
        zero, none = np.zeros(len(n), np.int64), np.zeros(len(n))
        own1, own2 = d[rows].T
        # A text's own row asks for nothing; its hash for a key spreads such rows.
        for columns in ((own1, own2, own1, own2, np.zeros(len(rows), np.int64), tokens.n, *sums), (own1[text], own2[text], k1, k2, n, zero, none, none)):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)


def cross_entropy_difference(
    docs: DataFrame, training: DataFrame, name: str = "lm", keep: list[str] | None = None, most_hot: int = MOST_HOT, frequent: float = FREQUENT
) -> DataFrame:
    """Add the struct ``name``: n_tokens, target_loss, background_loss and score to all rows.

    ``training`` (text, is_target) are the rows both models are counted from. The losses are means
    per token in nats; ``score`` is target less background, so the smaller, the more a document
    resembles the training rows where ``is_target`` holds. Tokens are words, as white space parts them, and
    each text's end. Null counts as no target, and a null text as the empty one, which has one token, its
    end. Repeated rows count as often as they stand there. Without any target row the target model is
    uniform over classes, and without any training row every loss is 0. Words no training row holds
    get the room that their class leaves.

    A text's losses are summed by 128 bits of its hash and joined back to its rows, so equal texts share their
    losses and only the columns ``keep`` are shuffled; leave the text out of them. Words are told apart by 64 bits of XXH3.
    The class table (at most 1 / ``frequent`` + 4097 rows) and ``most_hot`` corrections come to the driver and go to
    the workers.
    """
    spark = docs.sparkSession
    training = training.select(F.col("text").cast("string").alias("text"), F.col("is_target").cast("boolean").alias("is_target"))
    words = _written(count_words(training), "lm-words")
    n_target, n_all = words.agg(F.coalesce(F.sum("target"), F.lit(0)), F.coalesce(F.sum("background"), F.lit(0))).first()
    is_own = (F.col("background") >= F.lit(frequent * n_all)) & (F.col("k2") != END)
    own = np.array(sorted(r[0] for r in words.filter(is_own).select("k2").collect()), np.int64)
    by_class = words.groupBy(F.when(is_own, F.col("k2")).otherwise(F.col("shape").cast("long")).alias("class"))
    rows = by_class.agg(F.sum("target").alias("t"), F.sum("background").alias("b"), F.count(F.lit(1)).alias("words")).collect()
    classes = Classes([tuple(r) for r in rows], own, n_target / n_all if n_target else 1.0)
    found = _written(corrections(words, count_bigrams(training, own), classes), "lm-corrections")
    limit = hot_limit(found, most_hot)
    table = found.filter(F.col("total") >= limit).select("k1", "k2", "target", "background").toArrow()
    hot = Hot(*(table.column(c).to_numpy() for c in table.column_names))
    model = spark.sparkContext.broadcast((classes, hot))
    key = f"lm-{uuid.uuid4()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, hot = held_by_worker(key, lambda: model.value)
        for batch in batches:
            yield from score_batch(batch, classes, hot)

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != name.lower()]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marks = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    parts = docs.select(text.alias("text"), marks[0].alias("d1"), marks[1].alias("d2")).mapInArrow(run, _PARTS)
    cold = found.filter(F.col("total") < limit).select("k1", "k2", F.col("target").alias("add_t"), F.col("background").alias("add_b"))
    joined = parts.join(cold, ["k1", "k2"], "left")

    def loss(column: str, add: str) -> Column:
        return F.sum(F.col(column) + F.col("n") * F.coalesce(F.col(add), F.lit(0.0)))

    scored = joined.groupBy("d1", "d2").agg(
        F.max("n_tokens").alias("n_tokens"), F.sum("n_tokens").alias("n_all"), loss("target", "add_t").alias("t"), loss("background", "add_b").alias("b")
    )
    target, background = F.col("t") / F.col("n_all"), F.col("b") / F.col("n_all")
    made = F.struct("n_tokens", target.alias("target_loss"), background.alias("background_loss"), (target - background).alias("score"))
    m1, m2, of1, of2, added = (unused_name(docs, c) for c in ("m1", "m2", "of1", "of2", "made"))
    scored = scored.select(F.col("d1").alias(m1), F.col("d2").alias(m2), made.alias(added))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], marks[0].alias(of1), marks[1].alias(of2))
    back = rows.join(scored, (F.col(of1) == F.col(m1)) & (F.col(of2) == F.col(m2)), "left")
    return back.select(*[F.col(f"`{c}`") for c in kept], F.col(added).alias(name))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, is_target) of ``docs`` (doc_id, text): labelled good and not toxic by every label row.

    Null labels and documents without a label are no target; null ids match nothing. The ids of
    targets go to the texts while there are at most ``MOST_BROADCAST`` of them; beyond, the join shuffles.
    """
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("labelled")).agg(
        F.min((F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(1)) == 0)).alias("is_target")
    )
    ids = broadcast_up_to(_written(good.filter("is_target"), "lm-targets"), MOST_BROADCAST)
    joined = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("labelled"), "left")
    return joined.select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
