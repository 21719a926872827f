"""Periodic runs of words by a sparse dynamic program over diagonals.

The diagonal of lag ``q`` holds the words that equal the word ``q`` places before. Texts are read
from the left: each word's earlier occurrences keep the diagonals of their lags active and
increment their match lengths; a diagonal that the next word does not continue ends there, and a
stretch that matched long enough is a run and leaves at once.

A lag of ``q`` must match ``q`` words or more to be a run, so it must match a whole aligned block
of ``B`` words, where ``2B <= q < 4B``. So long lags advance by blocks instead of words: at level
``B`` the blocks of ``B`` words stand for the words, a block's earlier occurrences ``2B`` to ``4B - 1``
words before it increment the lags by ``B``, and an ended diagonal gains the fewer than ``B`` words
at either end. Each level compares ``2n`` places whatever the words, and all levels ``2n log n``: a
word that makes up half of a text costs no more than a rare one. Only lags active at the time are
held between blocks.

Blocks are compared by Rabin-Karp hashes. Every run is then compared word by word; should one not
hold, its texts are done again with another base.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import (
    WINDOW_BASES,
    WindowHasher,
    mix,
    slices,
    text_blob,
    with_struct,
    word_ids,
)

LEAST_WORDS = 12
LEAST_REPEATS = 2
#: Places of earlier occurrences compared at a time.
_AT_ONCE = 1 << 20
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


class _Sequences:
    """The words of some texts as numbers, one text after the other."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, base: int = 0):
        self.ids = ids
        self.counts = counts
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        # Numbers in order of appearance would make a weak polynomial.
        self.hasher = WindowHasher(mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), base)

    def blocks(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the aligned blocks of the texts with ``least`` words or more, and those texts."""
        texts = np.flatnonzero(self.counts >= least)
        n = self.counts[texts] // size
        number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(self.starts[texts], n) + number * size, np.repeat(texts, n)

    def matching(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, size: int, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or just before it, backward) equal those ``lag`` before.

        At most ``most``, which lies below ``size``, a power of two: the count is put together from
        halves, quarters and so on of it.
        """
        out = np.zeros(len(at), np.int64)
        part = size // 2
        while part:
            can = np.flatnonzero(out + part <= most)
            first = at[can] + out[can] if forward else at[can] - out[can] - part
            same = self.hasher.at(first, part) == self.hasher.at(first - lag[can], part)
            out[can[same]] += part
            part //= 2
        return out


def _diagonals(seq: _Sequences, size: int, lags: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Diagonals of the level of blocks of ``size`` words, as they end, in texts of ``least`` words or more.

    Yields lag, first and past-the-last matching word and text of each. Blocks go by in order; what
    stays between two parts of them is the first block of every active lag.
    """
    at, text = seq.blocks(size, least)
    hashes = seq.ids if size == 1 else seq.hasher.every(size)
    rows = max(1, _AT_ONCE // len(lags))
    active, since, last = np.zeros(len(lags), bool), np.zeros(len(lags), np.int64), -1
    for lo in range(0, len(at), rows):
        here, own = at[lo : lo + rows], text[lo : lo + rows]
        before = here[:, None] - lags
        # A text's first block has no earlier occurrences, so no diagonal leaves its text.
        same = (hashes[np.maximum(before, 0)] == hashes[here][:, None]) & (before >= seq.starts[own][:, None])
        shifted = np.concatenate([active[None], same[:-1]])
        lag_opened, opened = np.nonzero((same & ~shifted).T)
        lag_ended, ended = np.nonzero((shifted & ~same).T)
        # By lag and block: what was active, what opens; what ends, what stays active.
        old, stays = np.flatnonzero(active), np.flatnonzero(same[-1])
        first_lag, first = np.append(old, lag_opened), np.append(since[old], here[opened])
        first = first[np.lexsort((first, first_lag))]
        end_lag, end = np.append(lag_ended, stays), np.append(ended, np.full(len(stays), len(here)))
        order = np.lexsort((end, end_lag))
        end_lag, end = end_lag[order], end[order]
        done = end < len(here)
        past = np.where(end > 0, here[end - 1], last) + size
        in_text = text[lo + end[done] - 1]
        yield lags[end_lag[done]], first[done], past[done], in_text
        since[end_lag[~done]] = first[~done]
        active, last = same[-1], here[-1]
    old = np.flatnonzero(active)
    if len(old):
        yield lags[old], since[old], np.full(len(old), last + size), np.full(len(old), text[-1])


def _sufficient(seq: _Sequences, size: int, diagonals: tuple[np.ndarray, ...], least: int, repeats: int) -> np.ndarray:
    """Rows (first word, length, period) of the diagonals that are long enough with their ends."""
    lag, first, past, text = diagonals
    need = np.maximum((repeats - 1) * lag, least - lag)
    hopeful = past - first + 2 * (size - 1) >= need
    lag, first, past, text, need = (x[hopeful] for x in (lag, first, past, text, need))
    left = seq.matching(first, lag, np.minimum(first - lag - seq.starts[text], size - 1), size, False)
    right = seq.matching(past, lag, np.minimum(seq.ends[text] - past, size - 1), size, True)
    matched = past - first + left + right
    long = matched >= need
    return np.stack([first - left - lag, matched + lag, lag], axis=1)[long]


def _holds(ids: np.ndarray, runs: np.ndarray) -> bool:
    """Are the words of every run equal to those a period before?"""
    for lo in range(0, len(runs), 1024):
        start, length, period = runs[lo : lo + 1024].T
        ends = np.cumsum(length - period)
        for a in range(0, int(ends[-1]), _AT_ONCE):
            number = np.arange(a, min(a + _AT_ONCE, int(ends[-1])))
            run = np.searchsorted(ends, number, side="right")
            at = start[run] + number - (ends - (length - period))[run]
            if (ids[at] != ids[at + period[run]]).any():
                return False
    return True


def find_runs(ids: np.ndarray, counts: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[np.ndarray]:
    """Per text its maximal runs: rows (start, length, period) in that order.

    ``ids`` holds the words of all texts as numbers, ``counts`` how many each has. A run is as long as
    ``least`` and ``repeats`` (2 or more) of its smallest period, and no neighbour extends it.
    """
    for base in range(len(WINDOW_BASES)):
        seq = _Sequences(ids, counts, base)
        found, size, longest = [np.zeros((0, 3), np.int64)], 1, int(counts.max(initial=0))
        while (1 if size == 1 else 2 * size) * repeats <= longest and longest >= least:
            lags = np.arange(1 if size == 1 else 2 * size, 4 * size)
            lags = lags[lags * repeats <= longest]
            shortest = max(least, repeats * int(lags[0]))
            found += [_sufficient(seq, size, d, least, repeats) for d in _diagonals(seq, size, lags, shortest)]
            size *= 2
        runs = np.concatenate(found)
        # A multiple of a run's period gives the same stretch: the smallest stays.
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[new]
        if _holds(ids, runs):
            break
    else:
        raise AssertionError("words hash alike under every base")
    text = np.searchsorted(seq.ends, runs[:, 0], side="right")
    runs[:, 0] -= seq.starts[text]
    edges = np.searchsorted(text, np.arange(len(counts) + 1))
    return [runs[lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]


def repeated_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _collapsed(text: bytes, runs: np.ndarray) -> str:
    words = text.split()
    if len(runs):
        gone = repeated_words(len(words), runs)
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return b" ".join(words).decode()


def _describe(texts: list[bytes | None], least: int, repeats: int) -> list[pa.Array]:
    own = text_blob(texts)
    counts, runs, collapsed = [], [], []
    for lo, hi in slices(own):
        ids, _, n = word_ids(own[lo:hi])
        found = find_runs(ids, n, least, repeats)
        counts.append(n)
        runs += found
        collapsed += map(_collapsed, own[lo:hi], found)
    sizes = np.fromiter(map(len, runs), np.int32, len(runs))
    every = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    struct = pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(every.T)], names=RUN.names)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    n_words = np.concatenate([np.zeros(0, np.int64), *counts])
    return [pa.array(n_words), pa.ListArray.from_arrays(offsets, struct), pa.array(collapsed, pa.string())]


def with_runs(
    docs: DataFrame,
    name: str = "runs",
    keep: list[str] | None = None,
    least: int = LEAST_WORDS,
    repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """Add the struct ``name``: n_words, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what ASCII white space separates in ``text``, counted from 0. A run is a maximal
    stretch with smallest period ``period``, of ``least`` words and ``repeats`` periods or more.
    ``collapsed`` is the text, joined by one space, without the words that a run holds after its
    first period. Runs may overlap. A null or empty text has no words, no runs and an empty
    ``collapsed``; repeated rows are each described; other columns pass through (``keep`` chooses
    them). One text at a time must fit a task: some 100 bytes a word.
    """
    if repeats < 2 or least < 1:
        raise ValueError("a run has a word and two periods at least")
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    compute: Callable[[list[bytes | None]], list] = lambda texts: _describe(texts, least, repeats)
    return with_struct(docs, "text", fields, compute, name, keep)
