"""Near duplicates by 64-bit SimHash fingerprints, joined with themselves over binary tries.

Two fingerprints within ``BUDGET`` differing bits differ in at most half as many bits in one of
their halves. So there are two tries, one that starts with each half, and while a pair of nodes
lies within the first half only that smaller error budget is allowed; beyond it the whole one.
The first ``depth`` levels are walked by Spark: every fingerprint goes to all pairs of subtrees
whose prefixes are within the budget. A task then walks the node pairs of its two subtrees
together, adds up differing bits and drops a pair as soon as its budget is exceeded. Where many
fingerprints crowd below one prefix, Spark walks on to deeper levels until every task's share is
bounded.

Fingerprints are distinct before the join, so that copies cost nothing there, and a task returns
a star per linked set instead of its pairs. Connected components come from alternating large and
small stars, each round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import broadcast_up_to, cut, unused_name, with_struct

SHINGLE = 4
BITS = 64
BUDGET = 4
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BYTE_ONES = np.uint64(0x0101010101010101)
_LEAF_PAIRS = 1 << 21
_FRONTIER = 1 << 19
#: Fingerprints that a subtree should hold on average, and that a task may hold of a subtree pair.
SUBTREE = 1 << 16
MOST_IN_TASK = 1 << 19
#: Levels by which Spark walks on in crowded subtree pairs.
_STEP = 4


# --- Fingerprints ----------------------------------------------------------------------------


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    words = text.translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    at = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return [digest(joined, SEED)]
    return [digest(joined[lo : hi - 1], SEED) for lo, hi in zip(at, at[size:])]  # noqa: B905


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in more than half of the shingle hashes; 0 for no words."""
    hashes = np.array(shingle_hashes(text or b"", size), np.uint64)
    n = len(hashes)
    if not n:
        return 0
    out, runs = 0, np.arange(0, n, 255)
    for shift in range(8):
        # One byte of each sum counts one bit, which 255 additions cannot overflow.
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & _BYTE_ONES, runs)
        ones = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte, count in enumerate(ones.tolist()):
            if 2 * count > n:
                out |= 1 << (8 * byte + shift)
    return out


def with_fingerprint(docs: DataFrame, name: str, keep: list[str] | None = None, size: int = SHINGLE) -> DataFrame:
    """Add the struct ``name`` with the fingerprint's 64 bits as a long."""

    def compute(texts: list[bytes | None]) -> list:
        prints = np.array([fingerprint(t, size) for t in texts], np.uint64)
        return [pa.array(prints.view(np.int64))]

    return with_struct(docs, "text", [T.StructField("fp", T.LongType())], compute, name, keep)


# --- Trie self-join --------------------------------------------------------------------------


class _Trie:
    """Levels of a binary trie over sorted distinct values; a level is built when asked for."""

    def __init__(self, values: np.ndarray, depth: int):
        self.values = values
        self.depth = depth
        self.starts = {depth: np.array([0], np.int64)} if len(values) else {depth: np.zeros(0, np.int64)}
        self.children: dict[int, np.ndarray] = {}

    def level(self, depth: int) -> np.ndarray:
        """First value of each node at ``depth``."""
        if depth not in self.starts:
            self.split(depth - 1)
        return self.starts[depth]

    def split(self, depth: int) -> np.ndarray:
        """Numbers, one level down, of both children of each node at ``depth``; -1: no child."""
        if depth not in self.children:
            above = self.level(depth)
            prefix = self.values >> np.uint64(BITS - depth - 1)
            new = np.ones(len(prefix), bool)
            new[1:] = prefix[1:] != prefix[:-1]
            begin = np.flatnonzero(new)
            table = np.full((len(above), 2), -1, np.int64)
            parent = np.searchsorted(above, begin, "right") - 1
            table[parent, (prefix[begin] & np.uint64(1)).astype(np.int64)] = np.arange(len(begin))
            self.starts[depth + 1], self.children[depth] = begin, table
        return self.children[depth]

    def sizes(self, depth: int) -> np.ndarray:
        return np.diff(np.append(self.level(depth), len(self.values)))


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, errors: int, half: int, budget: int) -> Iterator[tuple]:
    """Index pairs of values within ``budget`` bits, whose first half differs in ``half`` at most.

    ``a`` and ``b`` are sorted and hold one subtree each, rooted at ``depth``, whose prefixes
    differ in ``errors`` bits; without ``b``, ``a`` is joined with itself. Yields pairs of index
    arrays.
    """
    left = _Trie(a, depth)
    right = left if b is None else _Trie(b, depth)
    if not len(left.values) or not len(right.values):
        return
    deep = depth
    while deep < BITS - 1 and len(left.level(deep)) * 3 < len(a) and deep - depth < 40:
        deep += 1
    zero = np.zeros(1, np.int64)
    stack = [(depth, zero, zero, np.full(1, errors, np.int64))]
    while stack:
        at, x, y, diff = stack.pop()
        if len(x) > _FRONTIER:
            mid = len(x) // 2
            stack += [(at, x[mid:], y[mid:], diff[mid:]), (at, x[:mid], y[:mid], diff[:mid])]
            continue
        if at == deep:
            yield from _compare(left, right, at, x, y, b is None, half, budget)
            continue
        below_x, below_y = left.split(at)[x], right.split(at)[y]
        allowed = half if at < BITS // 2 else budget
        found = []
        for i, j in ((0, 0), (1, 1), (0, 1), (1, 0)):
            grown = diff + (i != j)
            ok = (below_x[:, i] >= 0) & (below_y[:, j] >= 0) & (grown <= allowed)
            if b is None and (i, j) == (1, 0):
                ok &= x != y
            if ok.any():
                found.append((below_x[ok, i], below_y[ok, j], grown[ok]))
        if found:
            stack.append((at + 1, *(np.concatenate(c) for c in zip(*found, strict=True))))


def _compare(left, right, depth, x, y, same, half, budget) -> Iterator[tuple]:
    """The values below node pairs against each other, a bounded number of pairs at a time."""
    begin_x, begin_y = left.level(depth)[x], right.level(depth)[y]
    n_x, n_y = left.sizes(depth)[x], right.sizes(depth)[y]
    product = n_x * n_y
    total = np.cumsum(product)
    lo = 0
    while lo < len(x):
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + _LEAF_PAIRS, "right")))
        if hi == lo + 1 and product[lo] > _LEAF_PAIRS:
            step = max(1, _LEAF_PAIRS // int(n_y[lo]))
            for cut_at in range(0, int(n_x[lo]), step):
                rows = np.arange(cut_at, min(int(n_x[lo]), cut_at + step))
                i = np.repeat(begin_x[lo] + rows, n_y[lo])
                j = np.tile(begin_y[lo] + np.arange(n_y[lo]), len(rows))
                yield from _linked(left, right, i, j, same, half, budget)
        else:
            pair = np.repeat(np.arange(lo, hi), product[lo:hi])
            inner = np.arange(len(pair)) - np.repeat(total[lo:hi] - product[lo:hi] - done, product[lo:hi])
            i = begin_x[pair] + inner // n_y[pair]
            j = begin_y[pair] + inner % n_y[pair]
            yield from _linked(left, right, i, j, same, half, budget)
        lo = hi


def _linked(left, right, i, j, same, half, budget) -> Iterator[tuple]:
    if same:
        i, j = i[i < j], j[i < j]
    apart = left.values[i] ^ right.values[j]
    ok = np.bitwise_count(apart) <= budget
    ok &= np.bitwise_count(apart >> np.uint64(BITS // 2)) <= half
    if ok.any():
        yield i[ok], j[ok]


def _join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of linked places; a label is the smallest place of its set."""
    while True:
        x, y = labels[i], labels[j]
        if (open_ := x != y).any():
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            while (nearer := labels[labels] != labels).any():
                labels[nearer] = labels[labels][nearer]
        else:
            return labels


def _rotate(values: np.ndarray) -> np.ndarray:
    return (values << np.uint64(BITS // 2)) | (values >> np.uint64(BITS // 2))


def _subtree_pairs(prints: DataFrame, depth: int, half: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Every fingerprint dealt to the pairs of subtrees at ``depth``, and the crowded pairs."""
    masks = [0] + [sum(1 << b for b in bits) for k in range(1, half + 1) for bits in combinations(range(depth), k)]
    turned = F.shiftleft("fp", BITS // 2).bitwiseOR(F.shiftrightunsigned("fp", BITS // 2))
    either = prints.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"))
    either = either.withColumn("key", F.when(F.col("turn") == 0, F.col("fp")).otherwise(turned))
    either = either.withColumn("own", F.shiftrightunsigned("key", BITS - depth))
    mask = F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")
    other = F.col("own").bitwiseXOR(F.col("mask"))
    pair = ["turn", F.least("own", other).alias("low"), F.greatest("own", other).alias("high")]
    sent = either.select("turn", "key", "own", mask).select(*pair, (F.col("own") > other).alias("upper"), "key")
    # A pair holds no more than twice its larger subtree.
    full = either.groupBy("turn", "own").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most // 2)
    crowded = full.select("turn", "own", mask).select(*pair).distinct()
    return sent, crowded.withColumn("alone", F.lit(False))


def _further_down(crowd: DataFrame, depth: int, half: int, budget: int) -> DataFrame:
    """Rows of subtree pairs at ``depth``, dealt to the pairs ``_STEP`` levels below them."""
    allowed = half if depth + _STEP <= BITS // 2 else budget
    own = F.shiftrightunsigned("key", BITS - depth - _STEP).bitwiseAND(F.lit((1 << _STEP) - 1))
    errors = F.bit_count(F.col("low").bitwiseXOR(F.col("high")))
    masks = F.array(*[F.lit(m).cast("long") for m in range(1 << _STEP)])
    wide = crowd.withColumn("mask", F.explode(F.filter(masks, lambda m: errors + F.bit_count(m) <= allowed)))
    other = own.bitwiseXOR(F.col("mask"))
    low = F.shiftleft("low", _STEP).bitwiseOR(F.when(F.col("upper"), other).otherwise(own))
    high = F.shiftleft("high", _STEP).bitwiseOR(F.when(F.col("upper"), own).otherwise(other))
    # Only below a subtree paired with itself can the row's own side come out as the greater one.
    upper = F.col("upper") | (low > high)
    return wide.select(
        "turn", F.least(low, high).alias("low"), F.greatest(low, high).alias("high"), upper.alias("upper"), "key"
    )


def _crowded_pairs(sent: DataFrame, most: int) -> DataFrame:
    """Pairs with over ``most`` rows; ``alone`` where all are on one side and nothing can link."""
    counted = sent.groupBy("turn", "low", "high").agg(
        F.count(F.lit(1)).alias("n"), (F.min("upper") == F.max("upper")).alias("one_side")
    )
    alone = (F.col("low") < F.col("high")) & F.col("one_side")
    return counted.filter(F.col("n") > most).select("turn", "low", "high", alone.alias("alone"))


def fingerprint_links(
    prints: DataFrame, budget: int = BUDGET, depth: int | None = None, most: int = MOST_IN_TASK
) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all within ``budget`` bits.

    Not every pair: each task returns a star per set that it found linked. ``depth`` levels are
    walked by Spark; by default so many that a subtree holds ``SUBTREE`` fingerprints on average.
    Subtree pairs with more than ``most`` are taken some levels further down, again and again,
    so no task holds more, however the fingerprints crowd.
    """
    if depth is None:
        n = prints.count()
        depth = min(max(int(n / SUBTREE).bit_length(), 4), BITS // 2 - 1)
    half = budget // 2
    pair = ["turn", "low", "high"]
    sent, crowded = _subtree_pairs(prints, depth, half, most)
    links = None
    while True:
        crowded = cut(crowded)
        done = depth + _STEP >= BITS or crowded.isEmpty()
        here = sent if done else sent.join(broadcast_up_to(crowded.select(*pair)), pair, "left_anti")
        found = here.groupBy(*pair).applyInArrow(_walker(depth, half, budget), "a long, b long")
        links = found if links is None else links.unionByName(found)
        if done:
            return links
        wanted = crowded.filter(~F.col("alone")).select(*pair)
        sent = cut(_further_down(sent.join(broadcast_up_to(wanted), pair, "left_semi"), depth, half, budget))
        depth += _STEP
        crowded = _crowded_pairs(sent, most)


def _walker(depth: int, half: int, budget: int):
    def walk(table: pa.Table) -> pa.Table:
        keys = np.asarray(table.column("key")).view(np.uint64)
        upper = np.asarray(table.column("upper"))
        turn, low, high = (table.column(c)[0].as_py() for c in ("turn", "low", "high"))
        a, b = np.sort(keys[~upper]), np.sort(keys[upper])
        alone = low == high
        values = a if alone else np.concatenate([a, b])
        labels = np.arange(len(values))
        for i, j in trie_links(a, None if alone else b, depth, (low ^ high).bit_count(), half, budget):
            labels = _join_labels(labels, i, j if alone else j + len(a))
        moved = np.flatnonzero(labels != np.arange(len(values)))
        values = _rotate(values) if turn else values
        return pa.table([values[moved].view(np.int64), values[labels[moved]].view(np.int64)], names=["a", "b"])

    return walk


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected links (a, b); the root is the smallest node.

    Alternates large and small stars until nothing changes, which takes about the logarithm of
    the longest path in rounds. Minima are taken before the shuffle, so a hub is no hot key there;
    the joins that hand them back are split by adaptive execution.
    """

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        least = least.select("node", F.least("node", "low").alias("low"))
        joined = both.join(least, both["a"] == least["node"])
        far = joined.filter(F.col("b") > F.col("a")) if large else joined
        made = far.select(F.col("b").alias("a"), F.col("low").alias("b"))
        if not large:
            made = made.union(least.select(F.col("node").alias("a"), F.col("low").alias("b")))
        return made.filter(F.col("a") != F.col("b")).distinct()

    edges, seen = cut(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct()), None
    while True:
        edges = cut(stars(stars(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, content, fp, component_id, n_copies.

    ``fp`` holds the fingerprint's bits as a long and ``content`` the text's MD5.
    ``component_id`` is the smallest ``doc_id`` that links of at most ``budget`` bits reach, the
    row itself included; null where no row of the component has an id. ``n_copies`` counts the
    rows with this very fingerprint. A null or empty text has fingerprint 0 and links like any
    other. Rows may repeat. Only ``doc_id`` and ``text`` are read.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.md5(F.coalesce("text", F.lit(""))).alias("content"),
    )
    marked = with_fingerprint(source, "made", ["doc_id", "content"]).select("doc_id", "content", "made.fp")
    marked = cut(marked)
    own = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies")))
    rooted = components(fingerprint_links(own.select("fp"), budget))
    own = own.join(rooted, own["fp"] == rooted["node"], "left").select(
        own["fp"].alias("key"), "least", "n_copies", F.coalesce("root", "fp").alias("root")
    )
    reach = own.groupBy(F.col("root").alias("group")).agg(F.min("least").alias("component_id"))
    whole = cut(own.join(reach, own["root"] == reach["group"]).select("key", "n_copies", "root", "component_id"))
    return marked.join(whole, marked["fp"] == whole["key"]).select(
        "doc_id", "content", "fp", "component_id", "n_copies", "root"
    )


def keep_one_of_each(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one row per component, all columns kept: the one with the smallest id.

    Rows without an id stay only if no row of the component has one; among equal ids the smallest
    content hash wins, and of rows equal in both one stays.
    """
    found = near_duplicates(docs, budget)
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("first")
    chosen = found.groupBy("root").agg(winner).select(
        F.col("first.doc_id").alias("first_id"), F.col("first.content").alias("first_content")
    )
    row = unused_name(docs, "row")
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
        F.col("doc_id").cast("long").alias("first_id"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("first_content"),
    )
    same = marked["first_id"].eqNullSafe(chosen["first_id"]) & (marked["first_content"] == chosen["first_content"])
    kept = marked.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["first_id", "first_content"]).select(f"{row}.*")
