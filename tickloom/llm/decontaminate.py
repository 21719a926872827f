"""Benchmark contamination by one Aho-Corasick automaton over normalised test texts.

Texts are lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters. A
window is ``WINDOW`` consecutive words of a test item (an item with fewer words is one window).
The automaton finds every occurrence of every window in one scan of a document. Hits are mapped
back to word numbers and to character spans of the original text.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.llm.common import as_bytes, broadcast_up_to, cut, file_system, held_by_worker, new_folder, unused_name, with_struct

WINDOW = 13
#: Texts with hits go to the tasks while they are so few, with so many ranges and items in all; beyond, the join shuffles.
_FEW_HITS, _FEW_ENTRIES = 10_000, 200_000
# Everything up to 0x7F that is no digit and no letter becomes a space; A-Z become a-z.
_NORMAL = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField(
        "spans",
        T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])),
    ),
]


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


class Matcher:
    """The automaton of some test items, and the items' words to hold its hits against.

    Its keys are not the windows themselves, which would repeat every item ``window`` times, but
    the item's consecutive stretches of half a window: every window holds a whole one. Where one
    is found, item and document are compared word by word to both sides, as far as a window that
    holds the stretch can reach, and what is as long as a window at least is a hit. Places of a
    stretch with the same words within that reach are one place, so an item that repeats a word or
    a phrase has a few places however long it is. Items shorter than a window are keys as they are.
    """

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        known: dict[bytes, bytes] = {}
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, text in items:
            words = tuple(known.setdefault(w, w) for w in normal_words(text))
            if words:
                owners.setdefault(words, set()).add(item_id)
        self.words = list(owners)
        step = (window + 1) // 2
        self.reach = window - step
        keys: dict[bytes, tuple[int, dict[tuple, tuple[int, int, set[str]]]]] = {}
        for n, (words, ids) in enumerate(owners.items()):
            short = len(words) < window
            width = len(words) if short else step
            for at in range(0, len(words) - width + 1, step):
                around = () if short else (words[max(0, at - self.reach) : at], words[at + width : at + width + self.reach])
                places = keys.setdefault(b" ".join(words[at : at + width]), (width, {}))[1]
                have = places.get(around)
                if have is None:
                    places[around] = (n, at, ids)
                elif not ids <= have[2]:
                    places[around] = (*have[:2], have[2] | ids)
        self.automaton = ahocorasick.Automaton()
        for key in list(keys):
            width, places = keys.pop(key)
            self.automaton.add_word(f" {key.decode('latin-1')} ", (width, list(places.values())))
        if len(self.automaton):
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges that windows cover (end excluded), and the items they are from."""
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.words or not words:
            return ranges, items
        ends: list[int] | None = None
        # Places that were hit before bring no further items.
        hit: set[tuple[int, int]] = set()
        for last_byte, (width, places) in self.automaton.iter(f" {b' '.join(words).decode('latin-1')} "):
            if ends is None:
                ends = list(accumulate((len(w) + 1 for w in words), initial=0))
            hi = bisect_right(ends, last_byte) - 1
            lo = hi - width
            for n, at, ids in places:
                own = self.words[n]
                first, end, shift = lo, hi, at - lo
                if len(own) >= self.window:
                    left, right = max(0, lo - self.reach, -shift), min(len(words), hi + self.reach, len(own) - shift)
                    while first > left and words[first - 1] == own[first + shift - 1]:
                        first -= 1
                    while end < right and words[end] == own[end + shift]:
                        end += 1
                    if end - first < self.window:
                        continue
                ranges.append((first, end))
                if (n, at) not in hit:
                    hit.add((n, at))
                    items |= ids
        return ranges, items


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Character spans of word ranges in the original text."""
    plain = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(plain, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    # UTF-8 continuation bytes don't begin a character.
    character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [{"start": int(character[starts[lo]]) - 1, "end": int(character[ends[hi - 1] - 1])} for lo, hi in ranges]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "found",
    keep: list[str] | None = None,
    window: int = WINDOW,
    most_bytes: int = 8 << 20,
) -> DataFrame:
    """Add the struct ``name`` to ``docs``: n_words, n_hit, items (sorted) and spans.

    A word inside any occurrence of a window counts as hit once; ``spans`` are the hit stretches
    as character offsets (end excluded) in the original text. A null or empty text has no words.
    Items with null or wordless text have no window. Rows of one ``item_id`` count as one item; a
    null ``item_id`` goes as the empty string. Repeated rows are each judged.

    The test texts are written to the shared folder and read from there by the workers, at most
    ``most_bytes`` in one automaton (some 40 bytes of memory each, kept from task to task); none
    pass through the driver. A larger benchmark is cut into several automata
    of that size; each then scans all texts once, and as hits depend on the text alone, those of
    the texts that have any are brought back to their rows by digest.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).filter(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text") + 8).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // most_bytes))
    folder = new_folder(spark, "benchmark")
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))
    dealt.hint("rebalance", "part").write.partitionBy("part").parquet(folder)
    scanners = [_scanner(folder, i, window) for i in range(parts)]
    if parts == 1:
        return with_struct(docs, "text", FIELDS, lambda texts: _found(texts, *scanners[0](texts)), name, keep)

    kept = list(docs.columns if keep is None else keep)
    key, hits = unused_name(docs, "text_key"), unused_name(docs, "hits")
    known = _text_hits(docs.select(F.col("text").cast("string").alias("text")), scanners)
    known = known.select(F.col("digest").alias(key), F.col("hits").alias(hits))
    same = F.sha2(F.col("text").cast("string"), 256) == F.col(key)
    source = docs if keep is None or "text" in kept else docs.select(*kept, "text")
    entries = known.select(F.aggregate(hits, F.lit(0), lambda n, hit: n + F.size(hit["ranges"]) + F.size(hit["items"])).alias("n"))
    few = (entries.agg(F.sum("n").alias("n")).first()["n"] or 0) <= _FEW_ENTRIES
    joined = source.join(broadcast_up_to(known, _FEW_HITS) if few else known, same, "left").drop(key)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges, ids = [], []
            for own in batch.column(hits).to_pylist():
                ranges.append([(r["start"], r["end"]) for hit in own or [] for r in hit["ranges"]])
                ids.append({i for hit in own or [] for i in hit["items"]})
            made = _found(as_bytes(batch.column("text")), ranges, ids)
            struct = pa.StructArray.from_arrays(
                [pa.array(m, type=to_arrow_type(f.dataType)) for m, f in zip(made, FIELDS, strict=True)],
                names=[f.name for f in FIELDS],
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), struct], names=[*kept, name])

    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.StructType(FIELDS))])
    return joined.mapInArrow(finish, schema)


def _scanner(folder: str, part: int, window: int) -> Callable[[list[bytes | None]], tuple[list, list]]:
    """What finds the ranges and items of one part of the written test items in texts.

    Workers read the part from the shared folder themselves and build its automaton once each.
    """
    key = f"automaton-{uuid.uuid4()}"

    def scan(texts: list[bytes | None]) -> tuple[list, list]:
        matcher = held_by_worker(key, lambda: Matcher(_items_of(folder, part), window))
        found = [matcher.scan(normal_words(t)) for t in texts]
        return [ranges for ranges, _ in found], [ids for _, ids in found]

    return scan


def _items_of(folder: str, part: int) -> Iterator[tuple[str, bytes]]:
    """(item_id, text) of one written part; none if it has no folder."""
    system, place = file_system(f"{folder}/part={part}")
    for info in system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(1000, columns=["item_id", "text"]):
                    yield from zip(batch.column("item_id").to_pylist(), as_bytes(batch.column("text")), strict=True)


def _text_hits(texts: DataFrame, scanners: list) -> DataFrame:
    """(digest, hits) of the texts with any hit; ``hits`` has an entry per automaton at most."""
    found = None
    for number, scan in enumerate(scanners):

        def run(batches: Iterator[pa.RecordBatch], scan=scan, number=number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = as_bytes(batch.column("text"))
                rows = [(t, _merge(r), sorted(i)) for t, r, i in zip(own, *scan(own), strict=True) if r]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.sha256(t).hexdigest() for t, _, _ in rows], pa.string()),
                        pa.array([number] * len(rows), pa.int32()),
                        pa.array([[{"start": lo, "end": hi} for lo, hi in r] for _, r, _ in rows], to_arrow_type(FIELDS[3].dataType)),
                        pa.array([i for _, _, i in rows], pa.list_(pa.string())),
                    ],
                    names=["digest", "part", "ranges", "items"],
                )

        hit = texts.mapInArrow(run, "digest string, part int, ranges array<struct<start:int,end:int>>, items array<string>")
        found = hit if found is None else found.unionByName(hit)
    # Copies of a text leave each map task as one row.
    once = found.groupBy("digest", "part").agg(F.first("ranges").alias("ranges"), F.first("items").alias("items"))
    return cut(once.groupBy("digest").agg(F.collect_list(F.struct("ranges", "items")).alias("hits")))


def _found(texts: list[bytes | None], ranges: list[list], ids: list) -> list:
    """The columns of ``FIELDS`` from each text's word ranges and items."""
    merged = [_merge(r) for r in ranges]
    return [
        [len(normal_words(t)) for t in texts],
        [sum(hi - lo for lo, hi in own) for own in merged],
        [sorted(i) for i in ids],
        [original_spans(t, own) if own else [] for t, own in zip(texts, merged, strict=True)],
    ]


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def is_contaminated(found: str = "found"):
    """The rule: some word is hit, and hit words make up a twentieth of all at least."""
    return (F.col(f"{found}.n_hit") > 0) & (20 * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    name = unused_name(docs, "found")
    found = contamination(docs, benchmark, name, window=window)
    return found.filter(~is_contaminated(name)).drop(name)
