"""Learned decision lists for document quality.

Statistics of labelled documents are covered by rules one after the other: a rule is a
conjunction of thresholds, grown condition by condition for information gain on two thirds of the
rows and pruned on the rest; the rows it covers then leave, and the next rule is sought. The list
rejects what a rule covers and keeps everything else, and is emitted as one ordered conditional
expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import (
    broadcast_up_to,
    cut,
    slices,
    text_blob,
    unused_name,
    whole_windows,
    window_hashes,
    with_struct,
    word_hashes,
)

REPEAT_WINDOW = 8
#: At most about so many labelled rows fit the rules.
MOST_LABELLED = 20_000
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!?.,;:")] = True

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punctuation", "n_distinct_words",
)
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS]


# --- Statistics ------------------------------------------------------------------------------


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _found_before(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values by text: is it there more than once, and is it the first of its kind?"""
    order = np.lexsort((hashes, text))
    again = (text[order[1:]] == text[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    more, first = np.zeros(len(hashes), bool), np.ones(len(hashes), bool)
    more[order[1:]] |= again
    more[order[:-1]] |= again
    first[order[1:]] = ~again
    return more, first


def statistics(texts: list[bytes | None]) -> list[np.ndarray]:
    """The counts of ``COUNTS`` for each text; null counts as the empty text."""
    out = [[np.zeros(0, np.int64)] for _ in COUNTS]
    own = text_blob(texts)
    for lo, hi in slices(own):
        for column, values in zip(out, _statistics(own[lo:hi]), strict=True):
            column.append(values)
    return [np.concatenate(c) for c in out]


def _statistics(texts: list[bytes]) -> list[np.ndarray]:
    flat = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    words, counts = word_hashes(texts)
    number = np.arange(len(texts))
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    chars = _per_text(((flat & 0xC0) != 0x80) & ~blank[flat], bounds)

    of_word = np.repeat(number, counts)
    _, new_word = _found_before(of_word, words[:, 0])
    distinct = np.bincount(of_word[new_word], minlength=len(texts))

    starts = np.flatnonzero(whole_windows(counts, REPEAT_WINDOW))
    windows = window_hashes(words, REPEAT_WINDOW)
    windows = windows[starts] if len(windows) else windows
    more, _ = _found_before(of_word[starts], windows)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts[more]] += 1
    edge[starts[more] + REPEAT_WINDOW] -= 1
    repeated = np.bincount(of_word[np.cumsum(edge[:-1]) > 0], minlength=len(texts))

    n_lines, duplicate = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        n_lines[i], duplicate[i] = len(lines), len(lines) - len(set(lines))
    flags = (_SYMBOLS, _UPPER, _PUNCTUATION)
    symbols, upper, punctuation = (_per_text(f[flat], bounds) for f in flags)
    return [counts, chars, symbols, duplicate, repeated, n_lines, upper, punctuation, distinct]


def with_statistics(docs: DataFrame, name: str = "stats", keep: list[str] | None = None) -> DataFrame:
    """Add the struct ``name`` of ``COUNTS``: words, their characters, ``#*$%&|<>``, lines equal
    to an earlier one, words in 8-word windows that stand in the text more than once, lines,
    A-Z, ``!?.,;:`` and different words. A null text has none of any."""
    return with_struct(docs, "text", FIELDS, lambda t: [pa.array(a.astype(np.int64)) for a in statistics(t)], name, keep)


def base_failed(stats: str = "stats") -> Column:
    """Fewer than 20 words, or over 30 % of the words repeat."""
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 20) | (100 * repeated > 30 * n)


def ratios(stats: str = "stats") -> dict[str, Column]:
    """What the rules have thresholds on; 0 where a text has no words."""
    at = lambda name: F.col(f"{stats}.{name}").cast("double")
    per = lambda a, b: F.coalesce(at(a) / F.nullif(at(b), F.lit(0.0)), F.lit(0.0))
    return {
        "n_words": at("n_words"),
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "duplicate_lines": per("n_dup_lines", "n_lines"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "upper_per_character": per("n_upper", "word_chars"),
        "punctuation_per_word": per("n_punctuation", "n_words"),
        "distinct_words": per("n_distinct_words", "n_words"),
    }


# --- Learning --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.name] > self.threshold if self.above else table[self.name] <= self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        value = columns[self.name]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), bool)
        for condition in self.conditions:
            out &= condition.holds(table)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c.name} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


@dataclass
class DecisionList:
    """Rules in order; a row that any of them covers is rejected, by the first that does."""

    rules: list[Rule] = field(default_factory=list)

    def rejected(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(table.values()))), bool)
        for rule in self.rules:
            out |= rule.covers(table)
        return out

    def expression(self, columns: dict[str, Column]) -> Column:
        """The number of the first rule that covers a row, counted from 1; 0 for none."""
        out: Column | None = None
        for number, rule in enumerate(self.rules, 1):
            holds = F.lit(True)
            for condition in rule.conditions:
                holds = holds & condition.column(columns)
            out = F.when(holds, number) if out is None else out.when(holds, number)
        return F.lit(0) if out is None else out.otherwise(0)


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray, cuts: int) -> Condition | None:
    """The condition with the largest information gain for the rows covered so far."""
    p, n = int((bad & covered).sum()), int((~bad & covered).sum())
    before, best, found = np.log2(p / (p + n)), 1e-9, None
    for name, values in table.items():
        own, label = values[covered], bad[covered]
        order = np.argsort(own, kind="stable")
        own, label = own[order], label[order]
        edge = np.flatnonzero(own[1:] > own[:-1])
        if len(edge) > cuts:
            edge = edge[np.linspace(0, len(edge) - 1, cuts).astype(int)]
        below = np.cumsum(label)[edge] if len(edge) else np.zeros(0, int)
        for above in (False, True):
            hits = p - below if above else below
            size = len(own) - edge - 1 if above else edge + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(hits > 0, hits * (np.log2(hits / size) - before), -1.0)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, found = float(gain[k]), Condition(name, above, float((own[edge[k]] + own[edge[k] + 1]) / 2))
    return found


def learn_rules(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    least_precision: float = 0.95,
    most_rules: int = 12,
    most_conditions: int = 4,
    cuts: int = 256,
) -> DecisionList:
    """Sequential covering of the ``bad`` rows. Rows are dealt to growing and pruning by place.

    A pruned rule counts only if ``least_precision`` of what it newly covers is bad, on the
    growing and the pruning rows; the first that isn't ends the list.
    """
    learned, open_ = DecisionList(), np.ones(len(bad), bool)
    grow = np.arange(len(bad)) % 3 != 2
    while len(learned.rules) < most_rules and (bad & open_ & grow).any():
        covered, conditions = open_ & grow, []
        while len(conditions) < most_conditions and (~bad & covered).any():
            condition = _best_condition(table, bad, covered, cuts)
            if condition is None:
                break
            conditions.append(condition)
            covered &= condition.holds(table)
        if not conditions:
            break
        worth = []
        for size in range(1, len(conditions) + 1):
            held = Rule(tuple(conditions[:size])).covers(table) & open_ & ~grow
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            worth.append(((p - n) / (p + n) if p + n else -1.0, size))
        # Of equals the shorter rule.
        size = max(worth, key=lambda w: (w[0], -w[1]))[1]
        rule = Rule(tuple(conditions[:size]))
        held = rule.covers(table) & open_
        parts = [held & grow, held & ~grow]
        if any((bad & part).sum() < least_precision * max(1, part.sum()) for part in parts):
            break
        learned.rules.append(rule)
        open_ &= ~held
    return learned


def fit_rules(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> DecisionList:
    """Learn from at most about ``most_labelled`` rows of ``labels`` (doc_id, quality) with text.

    Labelled ids are chosen by a hash, so reruns agree; ids may have any type. Of several rows with
    one id the one with the least statistics counts. Ids with contradicting labels, null ids and
    null labels are left out; so are documents that the base rules reject anyway. Without usable
    labels the list is empty and keeps everything.
    """
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("least"), F.max("quality").alias("quality"))
        .filter(F.col("least") == F.col("quality"))
    )
    total = usable.count()
    share = F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < F.lit(min(1.0, most_labelled / max(1, total)) * (1 << 20))
    chosen = cut(usable.filter(share).select("labelled", "quality"))
    rows = docs.select("doc_id", "text").join(broadcast_up_to(chosen, 2 * most_labelled), F.col("doc_id") == F.col("labelled"))
    made = with_statistics(rows, "stats", ["labelled", "quality"]).filter(~base_failed())
    columns = ratios()
    # Rows of one id may repeat without bound, so that each id brings the least of its statistics.
    least = F.min(F.struct(*[c.alias(n) for n, c in columns.items()])).alias("least")
    found = made.groupBy("labelled").agg(F.min("quality").alias("quality"), least)
    frame = found.select(F.xxhash64("labelled").alias("place"), "quality", "least.*").toPandas()
    frame = frame.sort_values(["place", *columns], kind="stable")
    if frame.empty:
        return DecisionList()
    # Places decide who grows and who prunes; by a hash they don't follow the ids.
    return learn_rules({n: frame[n].to_numpy(float) for n in columns}, frame["quality"].to_numpy() == 0)


def judge(docs: DataFrame, rules: DecisionList, name: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """Add the struct ``name``: the counts, base_failed, rule (first that covers, or 0) and kept."""
    inner = unused_name(docs, "stats")
    marked = with_statistics(docs, inner, keep)
    failed = base_failed(inner)
    rule = rules.expression(ratios(inner))
    kept = marked.columns[:-1]
    made = F.struct(
        *[F.col(f"{inner}.{c}").alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        rule.alias("rule"),
        (~failed & (rule == 0)).alias("kept"),
    )
    return marked.select(*[F.col(f"`{c}`") for c in kept], made.alias(name))


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` without rejected rows, all columns kept."""
    name = unused_name(docs, "quality")
    return judge(docs, rules, name).filter(F.col(f"{name}.kept")).drop(name)
