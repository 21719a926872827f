"""Packing small files: many little documents into few Parquet files, each version of each file once.

Listing and opening dominate when every document is a file. A packing run lists the folder, sets what
it has packed before aside by path, modification time and size, and reads only the other files, once.
A file that was overwritten under its name is taken again, and its text replaces the former one
for readers; one that was only touched costs a reading but no new document. So a source that
rewrites its files in place is followed without a rule on names.

Packed runs stay in ``<packed>/documents`` (path, modified, length, digest, document), one folder per
batch, and count from the moment the batch's manifest is marked in ``<packed>/files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import path_exists, settings
from tickloom.sinks.versions import MARKER, folder_names, read_facts, write_facts
from tickloom.sources.documents import FILE_PATTERN, documents_from_text
from tickloom.sources.frames import empty_like

FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("held_in", T.IntegerType()),
        T.StructField("batch", T.IntegerType()),
    ]
)
PACKED = T.StructType([*FILE.fields[:4], T.StructField("document", T.StringType()), T.StructField("former", T.IntegerType())])
#: What opening a file counts in bytes when files are dealt to tasks: thousands of little ones to a task, not 32.
OPEN_COST = "32768"


def _batch_folder(packed: str, kind: str, batch: int) -> str:
    return f"{packed.rstrip('/')}/{kind}/batch={batch}"


def last_batch(spark: SparkSession, packed: str) -> int:
    """Number of the last committed batch; 0 before the first."""
    there = [int(name.split("=")[1]) for name in folder_names(spark, f"{packed.rstrip('/')}/files") if name.startswith("batch=")]
    marked = (n for n in sorted(there, reverse=True) if path_exists(spark, f"{_batch_folder(packed, 'files', n)}/{MARKER}"))
    return next(marked, 0)


def packed_files(spark: SparkSession, packed: str) -> DataFrame:
    """The newest manifest line of every file ever packed: what it was, and the batch that holds its text."""
    last = last_batch(spark, packed)
    if not last:
        return empty_like(spark, FILE)
    lines = spark.read.schema(FILE).parquet(f"{packed.rstrip('/')}/files").where(F.col("batch") <= last)
    newest = F.max_by(F.struct(*[c for c in FILE.names if c != "path"]), "batch").alias("file")
    return lines.groupBy("path").agg(newest).select("path", "file.*")


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.withColumnRenamed("modificationTime", "modified")


def pack_files(spark: SparkSession, folder: str, packed: str, pattern: str = FILE_PATTERN) -> dict:
    """Pack the files below ``folder`` that are new or rewritten since the last run; returns counts.

    ``files`` were read and ``documents`` packed of them; the rest had the text they had before. A run
    that dies is made again by the next one, whatever it left. One writer at a time. Files that vanish
    keep their packed text; empty files hold no document and are passed over. No file, or no folder,
    packs nothing.
    """
    if not path_exists(spark, folder):
        return {"batch": last_batch(spark, packed), "files": 0, "documents": 0}
    # Folders are listed by as many tasks as run at a time, not by one each.
    lists = str(4 * spark.sparkContext.defaultParallelism)
    with settings(spark, {"spark.sql.files.openCostInBytes": OPEN_COST, "spark.sql.sources.parallelPartitionDiscovery.parallelism": lists}):
        known = packed_files(spark, packed).select(
            "path", F.col("modified").alias("was"), F.col("length").alias("had"), F.col("digest").alias("former_digest"), "held_in"
        )
        listed = _listed(spark, folder, pattern).select("path", "modified", "length")
        same = F.col("was").eqNullSafe(F.col("modified")) & F.col("had").eqNullSafe(F.col("length"))
        changed = listed.join(known, "path", "left").where(~same)
        facts = changed.agg(F.count(F.lit(1)).alias("files"), F.min("modified").alias("oldest")).first()
        batch = last_batch(spark, packed) + 1
        if not facts["files"]:
            return {"batch": batch - 1, "files": 0, "documents": 0}
        # Older files are not opened: the source skips them by their modification time.
        read = _listed(spark, folder, pattern).where(F.col("modified") >= F.lit(facts["oldest"]))
        taken = read.join(changed.select("path", "modified", "former_digest", "held_in"), ["path", "modified"])
        digest = F.sha2("content", 256)
        text = F.when(~digest.eqNullSafe(F.col("former_digest")), F.decode("content", "utf-8"))
        rows = taken.select(
            "path", "modified", "length", digest.alias("digest"), text.alias("document"), F.col("held_in").cast("int").alias("former")
        )
        place = _batch_folder(packed, "documents", batch)
        rows.hint("rebalance").write.mode("overwrite").parquet(place)
    made = spark.read.schema(PACKED).parquet(place)
    held = F.when(F.col("document").isNotNull(), batch).otherwise(F.col("former"))
    lines = _batch_folder(packed, "files", batch)
    made.select("path", "modified", "length", "digest", held.cast("int").alias("held_in")).write.mode("overwrite").parquet(lines)
    counted = spark.read.schema(FILE).parquet(lines).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("held_in") == batch).alias("documents")
    )
    facts = {"batch": batch, **counted.first().asDict()}
    write_facts(spark, f"{lines}/{MARKER}", facts)
    return facts


def pack_facts(spark: SparkSession, packed: str, batch: int) -> dict | None:
    """Counts of a committed batch."""
    return read_facts(spark, f"{_batch_folder(packed, 'files', batch)}/{MARKER}")


def _texts(spark: SparkSession, packed: str) -> DataFrame:
    batch = T.StructField("batch", T.IntegerType())
    return spark.read.schema(T.StructType([*PACKED.fields, batch])).parquet(f"{packed.rstrip('/')}/documents")


def read_packed(spark: SparkSession, packed: str) -> DataFrame:
    """The newest text of every file: path, modified and document."""
    if not last_batch(spark, packed):
        return empty_like(spark, T.StructType([PACKED["path"], PACKED["modified"], PACKED["document"]]))
    newest = packed_files(spark, packed).select("path", F.col("held_in").alias("batch"))
    return _texts(spark, packed).select("path", "modified", "document", "batch").join(newest, ["path", "batch"]).drop("batch")


def file_version(path, modified):
    """A name for one version of a file, later ones greater: breaks ties between versions of a row."""
    micros = F.lpad(F.unix_micros(modified).cast("string"), 17, "0")
    return F.concat(path, F.lit("@"), micros)


def read_packed_documents(spark: SparkSession, packed: str, schema: T.StructType) -> DataFrame:
    """The newest documents parsed, as the parsers of :mod:`tickloom.sources.documents` take them."""
    named = read_packed(spark, packed).select("document", file_version(F.col("path"), F.col("modified")).alias("_file_path"))
    return documents_from_text(named, "document", schema, "_file_path")


def stream_packed_documents(spark: SparkSession, packed: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Documents of batches packed since the last run, as a stream; rewritten files come again."""
    rows = spark.readStream.schema(PACKED).option("maxFilesPerTrigger", max_files).parquet(f"{packed.rstrip('/')}/documents/batch=*")
    named = rows.where(F.col("document").isNotNull())
    named = named.select("document", file_version(F.col("path"), F.col("modified")).alias("_file_path"))
    return documents_from_text(named, "document", schema, "_file_path")
