"""Removal of word windows that other documents already hold.

Every window of ``size`` consecutive words gets a Rabin-Karp hash, and Spark counts the hashes
over all documents. The documents are dealt into blocks by a hash of their key; a block stands
for its documents in the counting, so that a window which a third of all documents share costs
one entry per block:

1. Each block sends 32 bits of every different window hash to the bucket that the hash's upper
   bits name. Buckets answer one bit per entry: does another block hold it too? As buckets grow
   in number with the data, chance matches stay rare at every size, and they cost only time.
2. For windows that repeat, each block sends 128 bits and the smallest ``doc_id`` it has for
   them; the buckets answer whether another block has a smaller one.
3. With the answers each block marks its repeated windows and merges them into maximal removal
   intervals.

Everything is one lineage of shuffles, so lost executors only cost their own part again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import (
    as_bytes,
    shuffle_partitions,
    text_blob,
    window_hashes,
    window_starts,
    word_hashes,
)

NO_ID = np.iinfo(np.int64).max

_ENTRY = "bucket int, block int, a binary, b binary, d binary"
_ANSWER = "block int, bucket int, kind int, bits binary"
_RESULT = "doc_id long, n_words long, n_removed long, intervals array<struct<start:int,end:int>>, kept_text string"


class _Block:
    """The windows of one block, in an order that depends on its documents alone."""

    def __init__(self, table: pa.Table, size: int):
        ids = table.column("doc_id")
        table = table.append_column("no_id", pc.is_null(ids))
        order = pc.sort_indices(
            table.select(["no_id", "doc_id", "text"]),
            sort_keys=[("no_id", "ascending"), ("doc_id", "ascending"), ("text", "ascending")],
        )
        table = table.take(order)
        self.no_id = np.asarray(table.column("no_id"))
        self.ids = np.asarray(pc.fill_null(table.column("doc_id"), int(NO_ID))).astype(np.int64)
        self.texts = text_blob(as_bytes(table.column("text")))
        words, self.counts = word_hashes(self.texts)
        self.size = size
        self.starts = window_starts(self.counts, size)
        self.doc = np.repeat(np.arange(len(self.ids)), self.counts)[self.starts]
        self.words = words
        every = window_hashes(words, size)
        self.h1 = every[self.starts] if len(every) else every
        # Windows by hash; within a hash by document.
        self.order = np.argsort(self.h1, kind="stable")
        ordered = self.h1[self.order]
        self.new = np.ones(len(ordered), bool)
        self.new[1:] = ordered[1:] != ordered[:-1]
        self.first = np.flatnonzero(self.new)
        self.distinct = ordered[self.first]

    def shared_here(self) -> np.ndarray:
        """Per different hash: do two documents with different ids hold it?"""
        if not len(self.first):
            return np.zeros(0, bool)
        last = np.append(self.first[1:], len(self.order)) - 1
        ids = self.ids[self.doc[self.order]]
        return ids[self.first] != ids[last]

    def candidates(self, answers: list[tuple[int, bytes]], buckets: int):
        """Windows that repeat, by both hashes and document.

        Returns their place among the windows, the first of each different window, the hashes
        and the smallest id of each different window.
        """
        repeated = self.shared_here() | _unpack(self.distinct, answers, buckets)
        chosen = self.order[repeated[np.cumsum(self.new) - 1]] if len(self.order) else self.order
        chosen.sort()
        every = window_hashes(self.words, self.size, 1)
        a, b = self.h1[chosen], (every[self.starts[chosen]] if len(every) else every)
        by = np.lexsort((chosen, b, a))
        chosen, a, b = chosen[by], a[by], b[by]
        new = np.ones(len(chosen), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        return chosen, new, a[first], b[first], self.ids[self.doc[chosen[first]]]


def _bounds(ordered: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets present in an ordered array of hashes, and where each begins and ends."""
    bucket = ((ordered >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    present, begin = np.unique(bucket, return_index=True)
    return present.astype(np.int64), begin, np.append(begin[1:], len(ordered))[: len(begin)]


def _unpack(ordered: np.ndarray, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    out = np.zeros(len(ordered), bool)
    given = dict(answers)
    for bucket, lo, hi in zip(*_bounds(ordered, buckets), strict=True):
        bits = given.get(int(bucket))
        if bits is not None:
            out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    return out


def _answers(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    rows = zip(
        table.column("kind").to_pylist(), table.column("bucket").to_pylist(), table.column("bits").to_pylist(), strict=True
    )
    return [(bucket, bits) for k, bucket, bits in rows if k == kind]


def _entries(block: int, parts: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*parts, strict=True)) or [(), (), (), ()]
    n = len(columns[0])
    return pa.table(
        [
            pa.array(columns[0], pa.int32()),
            pa.array([block] * n, pa.int32()),
            *(pa.array(c, pa.binary()) for c in columns[1:]),
        ],
        names=["bucket", "block", "a", "b", "d"],
    )


def _answer_table(bucket: int, kind: int, blocks: list[int], sizes: np.ndarray, bits: np.ndarray) -> pa.Table:
    """One packed row for every block that gets at least one 1."""
    ends = np.cumsum(sizes)
    rows = [
        (block, np.packbits(bits[end - size : end]).tobytes())
        for block, size, end in zip(blocks, sizes, ends, strict=True)
        if bits[end - size : end].any()
    ]
    return pa.table(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([bucket] * len(rows), pa.int32()),
            pa.array([kind] * len(rows), pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
        ],
        names=["block", "bucket", "kind", "bits"],
    )


def remove_repeated_windows(docs: DataFrame, size: int = 50, block_bytes: int = 16 << 20) -> DataFrame:
    """Mark words inside windows of ``size`` words that start in a document with a smaller id.

    Returns per row of ``docs``: doc_id, n_words, n_removed, the maximal removal ``intervals``
    (word positions, end excluded) and the kept words joined by one space (``kept_text``).
    Windows are judged on the input. Rows of one ``doc_id`` never remove from each other. A null
    text has no words; a null ``doc_id`` counts as larger than all others, and such rows never
    remove from each other. Texts shorter than a window keep all words. Only ``doc_id`` and
    ``text`` are read; other columns, whatever their names, are left out.

    ``block_bytes`` bounds the text that one task call holds (a longer single text stands alone).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(math.ceil(total / block_bytes), 2 * shuffle_partitions(spark))
    buckets = max(math.ceil(total / block_bytes / 2), shuffle_partitions(spark))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def send_hashes(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        hashes = _Block(table, size).distinct
        short = hashes.astype(np.uint32)
        parts = zip(*_bounds(hashes, buckets), strict=True)
        return _entries(number, ((k, short[lo:hi].tobytes(), None, None) for k, lo, hi in parts))

    def count_hashes(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint32) for x in table.column("a").to_pylist()]
        every = np.concatenate(blobs)
        order = np.argsort(every, kind="stable")
        same = np.zeros(len(every) + 1, bool)
        same[1:-1] = every[order[1:]] == every[order[:-1]]
        bits = np.zeros(len(every), bool)
        bits[order] = same[1:] | same[:-1]
        return _answer_table(
            table.column("bucket")[0].as_py(),
            1,
            table.column("block").to_pylist(),
            np.fromiter(map(len, blobs), np.int64, len(blobs)),
            bits,
        )

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _entries(0, iter(()))
        block = _Block(left, size)
        _, _, a, b, ids = block.candidates(_answers(right, 1), buckets)
        parts = zip(*_bounds(a, buckets), strict=True)
        return _entries(
            left.column("block")[0].as_py(),
            ((k, a[lo:hi].tobytes(), b[lo:hi].tobytes(), ids[lo:hi].tobytes()) for k, lo, hi in parts),
        )

    def compare_windows(table: pa.Table) -> pa.Table:
        read = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        blobs = read("a", np.uint64)
        a, b, d = np.concatenate(blobs), np.concatenate(read("b", np.uint64)), np.concatenate(read("d", np.int64))
        order = np.lexsort((d, b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
        smallest = d[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        bits = np.zeros(len(a), bool)
        bits[order] = smallest < d[order]
        return _answer_table(
            table.column("bucket")[0].as_py(),
            2,
            table.column("block").to_pylist(),
            np.fromiter(map(len, blobs), np.int64, len(blobs)),
            bits,
        )

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _result([], [], [], [], [])
        block = _Block(left, size)
        chosen, new, a, _, ids = block.candidates(_answers(right, 1), buckets)
        elsewhere = _unpack(a, _answers(right, 2), buckets)
        group = np.cumsum(new) - 1
        gone = chosen[elsewhere[group] | (block.ids[block.doc[chosen]] > ids[group])] if len(chosen) else chosen
        edge = np.zeros(len(block.words) + 1, np.int64)
        np.add.at(edge, block.starts[gone], 1)
        np.add.at(edge, block.starts[gone] + size, -1)
        removed = np.cumsum(edge[:-1]) > 0
        removed_in, intervals, kept, end = [], [], [], 0
        for text, n in zip(block.texts, block.counts.tolist(), strict=True):
            flags, end = removed[end : end + n], end + n
            cuts = np.flatnonzero(np.diff(flags, prepend=False, append=False)).tolist()
            words = text.split()
            removed_in.append(int(flags.sum()))
            intervals.append([{"start": lo, "end": hi} for lo, hi in zip(cuts[0::2], cuts[1::2], strict=True)])
            at, pieces = 0, []
            for lo, hi in zip(cuts[0::2], cuts[1::2], strict=True):
                pieces += words[at:lo]
                at = hi
            kept.append(b" ".join(pieces + words[at:] if cuts else words).decode())
        shown = [None if none else i for i, none in zip(block.ids.tolist(), block.no_id.tolist(), strict=True)]
        return _result(shown, block.counts.tolist(), removed_in, intervals, kept)

    first = dealt.groupBy("block").applyInArrow(send_hashes, _ENTRY)
    repeats = first.groupBy("bucket").applyInArrow(count_hashes, _ANSWER)
    second = dealt.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(send_windows, _ENTRY)
    earlier = second.groupBy("bucket").applyInArrow(compare_windows, _ANSWER)
    return dealt.groupBy("block").cogroup(repeats.unionByName(earlier).groupBy("block")).applyInArrow(mark, _RESULT)


def _result(ids, counts, removed, intervals, kept) -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table(
        [
            pa.array(ids, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(intervals, span),
            pa.array(kept, pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "intervals", "kept_text"],
    )
