"""What several operators share: shared folders, text columns inside tasks, words and window hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import shared_dir, work_folder

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> None:
    """Let Spark checkpoint into the folder that all executors reach.

    Where the session names none, only a local master gets one, of its own.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) or work_folder(spark, "checkpoint"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return work_folder(spark, name)


def file_system(path: str):
    """pyarrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_up_to(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, hinted for broadcast if it has no more than ``rows`` rows; else the join shuffles.

    Counts the rows, so ``df`` should be written already, and its rows short.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has it (case does not count)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).to_pylist()


def text_blob(texts: Sequence[bytes | None]) -> list[bytes]:
    return [t or b"" for t in texts]


def slices(texts: Sequence[bytes], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``most`` bytes; a longer text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def with_struct(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[list[bytes | None]], list],
    name: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the struct column ``name``, computed from the text column batch by batch.

    ``compute`` gets a batch's texts as UTF-8 and returns one sequence per field. The other
    columns pass through unchanged (``keep`` chooses them; all by default); one that is already called
    ``name``, whatever its case, is replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]
    source = df if keep is None or text in kept else df.select(*kept, text)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(name, T.StructType(fields))])
    names, types = [f.name for f in fields], [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(as_bytes(batch.column(text)))
            arrays = [
                a if isinstance(a, pa.Array) else pa.array(a, type=t, from_pandas=False)
                for a, t in zip(made, types, strict=True)
            ]
            struct = pa.StructArray.from_arrays(arrays, names=names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), struct], names=[*kept, name])

    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


_HELD: dict[str, object] = {}


def held_by_worker(key: str, make: Callable[[], object]):
    """What ``make`` returns, kept by the worker process from task to task; the last key stays."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


# --- words and Rabin-Karp hashes --------------------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_ids(texts: Sequence[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Every word of all texts in order as its place among the different words, those words, and each text's number of words.

    Words are runs of bytes other than ASCII white space. Equal places mean equal words; no hash decides.
    """
    buffer = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[buffer]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts = edge[0::2]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    counts = np.diff(np.searchsorted(starts, np.concatenate([[1], 1 + np.cumsum(lengths)])))
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.large_binary()), counts
    # Words and the gaps between them take turns in the buffer.
    both = pa.Array.from_buffers(
        pa.large_binary(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(buffer)]
    )
    coded = both.take(pa.array(np.arange(0, len(edge), 2))).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, counts


#: Window hashes are polynomials modulo this prime, so that no text makes two windows agree whatever the base
#: (modulo a power of two the Thue-Morse words do); one fixed base for each independent hash.
PRIME = (1 << 61) - 1
WINDOW_BASES = (0x16E8FEB86659FD93, 0x02B2AE3D27D4EB4F, 0x1CE4E5B9BF58476D)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX[0]
    h ^= h >> np.uint64(33)
    h *= _MIX[1]
    h ^= h >> np.uint64(33)
    return h


def reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit values modulo ``PRIME``."""
    out = x >> np.uint64(61)
    out += x & _P
    # What is below the prime wraps around to something larger.
    return np.minimum(out, out - _P)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo ``PRIME`` of values below it: 2**61 counts as 1, and halves keep every part below 2**64."""
    a1, a0 = a >> np.uint64(31), a & _LOW31
    b1, b0 = b >> np.uint64(31), b & _LOW31
    mid = a1 * b0
    mid += a0 * b1
    out = a1 * b1
    out <<= np.uint64(1)
    out += mid >> np.uint64(30)
    mid &= _LOW30
    mid <<= np.uint64(31)
    out += mid
    out += a0 * b0
    return reduced(out)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base modulo ``PRIME`` and their inverses."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())

        def row(b: int) -> np.ndarray:
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, times(out, np.uint64(pow(b, len(out), PRIME)))])
            return out

        have = _POWERS[base] = (row(base), row(pow(base, -1, PRIME)))
    return have[0][:n], have[1][:n]


class WindowHasher:
    """Rabin-Karp hashes of any windows of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        power, self.inverse = _powers(WINDOW_BASES[which], max(1, len(values)))
        term = times(reduced(values), power[: len(values)])
        # Halves of the terms are summed apart, which stays below 2**64 for up to 2**33 values.
        low, high = np.cumsum(term & _LOW31, dtype=np.uint64), np.cumsum(term >> np.uint64(31), dtype=np.uint64)
        self.total = np.zeros(len(values) + 1, np.uint64)
        self.total[1:] = reduced(times(reduced(high), np.uint64(1 << 31)) + reduced(low))

    def at(self, starts: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """The hash of the window of ``size`` values at each start."""
        part = reduced(self.total[starts + size] + (_P - self.total[starts]))
        return times(part, self.inverse[starts])

    def every(self, size: int) -> np.ndarray:
        """The hash of every window of ``size`` values."""
        n = len(self.total) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return times(reduced(self.total[size:] + (_P - self.total[:-size] if size else 0)), self.inverse[:n])


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of XXH3 of every word of all texts in order (one row each), and each text's number of words."""
    hashes, counts = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in slices(texts):
        ids, different, n = word_ids(texts[lo:hi])
        counts.append(n)
        if len(ids):
            _, offsets, data = different.buffers()
            edges, letters = np.frombuffer(offsets, np.int64).tolist(), data.to_pybytes()
            made = b"".join([xxhash.xxh3_128_digest(letters[a:b]) for a, b in pairwise(edges[: len(different) + 1])])
            hashes.append(np.frombuffer(made, np.uint64).reshape(-1, 2)[ids])
    return np.concatenate(hashes), np.concatenate(counts)


def window_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """The Rabin-Karp hash of every run of ``size`` words, given as ``word_hashes`` makes them.

    Hash 0 is made from the first half of the words' bits and hash 1 from the second half.
    """
    if len(words) < size:
        return np.zeros(0, np.uint64)
    return mix(WindowHasher(words[:, which], which).every(size))


def whole_windows(counts: np.ndarray, size: int) -> np.ndarray:
    """Which of the ``sum(counts) - size + 1`` window starts lie within one text."""
    n = int(counts.sum())
    if n < size:
        return np.zeros(0, bool)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    return left[: n - size + 1] >= size


def window_starts(counts: np.ndarray, size: int) -> np.ndarray:
    return np.flatnonzero(whole_windows(counts, size))
