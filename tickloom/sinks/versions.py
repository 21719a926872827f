"""Datasets kept in versions, so that readers see a whole one whatever becomes of a writer.

A versioned dataset is a folder of version folders. A version is written beside the others and
counts from the moment its marker stands in it; the marker is the last thing a writer makes, and
comes into being by one rename. Readers take the last version that has one. What a killed writer
left has no marker and goes with the next version that is committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKER = "_committed.json"
#: Committed versions that stay: the current one, and the one that running readers may hold.
KEEP = 2


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_facts(spark: SparkSession, path: str, facts: dict) -> None:
    """Make the small file ``path``, all of it or none."""
    place, fs = _path(spark, path)
    draft, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(facts, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(draft, place):
        fs.delete(draft, False)
        raise FileExistsError(path)


def read_facts(spark: SparkSession, path: str) -> dict | None:
    """What ``write_facts`` wrote; None if there is no such file."""
    place, fs = _path(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it is there."""
    place, fs = _path(spark, path)
    fs.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, in order; none if it does not exist."""
    place, fs = _path(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory())


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of all version folders of ``path``, oldest first."""
    return [n for n in folder_names(spark, path) if n.startswith("v") and n[1:13].isdigit()]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    root = path.rstrip("/")
    _, fs = _path(spark, root)
    return [f"{root}/{n}" for n in _folders(spark, root) if fs.exists(_path(spark, f"{root}/{n}/{MARKER}")[0])]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the last committed version, or None."""
    return next(reversed(versions(spark, path)), None)


def version_facts(spark: SparkSession, path: str) -> dict | None:
    """What the last committed version's marker says: its rows, and what its writer added."""
    folder = current_version(spark, path)
    return None if folder is None else read_facts(spark, f"{folder}/{MARKER}")


def write_version(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], facts: dict | None = None, keep: int = KEEP) -> dict:
    """Write ``df`` as the next version of ``path`` with ``write(df, folder)`` (Parquet); returns its facts.

    The number of rows is read back from the footers of the files that were committed, so rows of
    task attempts that failed or ran twice are never counted. Then the version is marked, and
    versions before the last ``keep`` go. A writer that fails leaves the current version as it is. Of
    two writers at a time the later number wins; both versions are whole.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    last = max((int(n[1:13]) for n in _folders(spark, root)), default=0)
    folder = f"{root}/v{last + 1:012d}-{uuid.uuid4().hex[:8]}"
    write(df, folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    made = {**(facts or {}), "rows": rows}
    write_facts(spark, f"{folder}/{MARKER}", made)
    _drop_old(spark, root, folder, keep)
    return made


def _drop_old(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Remove versions older than ``current`` but for the last ``keep`` committed ones."""
    stay = set(versions(spark, root)[-max(1, keep) :])
    for name in _folders(spark, root):
        folder = f"{root}/{name}"
        if folder not in stay and folder < current:
            drop_folder(spark, folder)
