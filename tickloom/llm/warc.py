"""WARC archives: a writer with identical-payload revisits, and a splittable reader.

Records are gzip members of their own. A reading task gets a byte range, scans it for the gzip
magic number, accepts a candidate only if it inflates to a WARC header, and owns the records that
start inside its range; the last one may end beyond it. Files are reached through pyarrow's file
systems, so archives may lie on local or shared folders, HDFS or object stores.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import cut, file_system, new_folder, shuffle_partitions

GZIP_MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 16 << 20
_CHUNK = 1 << 18
_PIECE = 1 << 13

MANIFEST = "path string, bytes long, n_records long"
RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, date string, page_id long, "
    "refers_to long, payload_digest string, payload_bytes long, computed_digest string, payload binary"
)


# --- Which record is a revisit ---------------------------------------------------------------


def mark_revisits(pages: DataFrame, least_bytes: int = 1000, salts: int = 16) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to) for rows (page_id, url, html).

    The payload is the html in UTF-8, empty for null. Of equal payloads of ``least_bytes`` or
    more, the rows with the largest ``page_id`` are responses and the others refer to it; rows
    without an id then refer to it too, and if none has an id all are responses. Payloads are
    compared by SHA-1 and length. The digests that several rows share are joined back salted.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    shared = (
        rows.filter(F.col("n") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("digest"), F.col("n").alias("length"))
        .agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("digest", "length", "latest", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("part"))
    )
    same = (
        (F.col("payload_digest") == F.col("digest"))
        & (F.col("n") == F.col("length"))
        & (F.col("salt") == F.col("part"))
    )
    older = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return rows.join(shared, same, "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(older, F.col("latest")).alias("refers_to")
    )


# --- Writing ---------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    """The same page and payload always get the same record id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member. A revisit carries the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    labelled = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", labelled),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return _gzip(head.encode() + block + b"\r\n\r\n")


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write rows as of :func:`mark_revisits` below ``folder``, a file per partition with rows.

    Returns the manifest (path, bytes, n_records), read back from the folder. A file appears
    under its name only when it is whole, and a repeated task replaces it.
    """
    spark = records.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():06d}.warc.gz"
        system, place = file_system(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        draft = f"{place}.{context.taskAttemptId()}.open"
        n, size, out = 0, 0, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "payload_digest", "refers_to")), strict=True)
            for page_id, url, payload, digest, refers_to in rows:
                if out is None:
                    out = system.open_output_stream(draft)
                    info = "WARC/1.1\r\nWARC-Type: warcinfo\r\n" + f"WARC-Record-ID: {record_id(None, path)}\r\nWARC-Date: {date}\r\n"
                    size += out.write(_gzip(f"{info}Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()))
                size += out.write(build_record(page_id, url, payload, digest, refers_to, date))
                n += 1
        if out is not None:
            out.close()
            system.move(draft, place)
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "n_records": [n]})

    columns = records.select("page_id", "url", "payload", "payload_digest", "refers_to")
    columns.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


# --- Reading ---------------------------------------------------------------------------------


class _Window:
    """Reads a file forward from a place, keeping what is still needed."""

    def __init__(self, file, start: int):
        self.file, self.at = file, start
        self.data, self.pos = bytearray(), 0
        file.seek(start)

    def more(self) -> bool:
        data = self.file.read(_CHUNK)
        # Neither cutting off the front nor appending copies what stays, however long a record is.
        del self.data[: self.pos]
        self.pos = 0
        self.data += data
        return bool(data)

    def left(self) -> int:
        return len(self.data) - self.pos

    def skip(self, n: int) -> None:
        self.pos += n
        self.at += n


def _inflate(window: _Window) -> tuple[bytes, int] | None:
    """The member at the window's start and its compressed length; None if it is no WARC record.

    It must inflate, without an error in its check sum, to a text that begins with a WARC version
    and whose header block, of any length, ends.
    """
    unpacker, out, used = zlib.decompressobj(31), bytearray(), 0
    while True:
        if used == window.left() and not window.more():
            return None
        piece = window.data[window.pos + used : window.pos + used + _PIECE]
        try:
            out += unpacker.decompress(piece)
        except zlib.error:
            return None
        used += len(piece) - len(unpacker.unused_data)
        if not out.startswith(b"WARC/"[: len(out)]):
            return None
        if unpacker.eof:
            return (bytes(out), used) if parse_header(bytes(out)) else None


def parse_header(record: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name and where the block begins; None if it is no WARC header."""
    end = record.find(b"\r\n\r\n")
    if end < 0 or not re.match(rb"WARC/\d+\.\d+\r\n", record):
        return None
    fields: dict[str, str] = {}
    for line in record[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not {"warc-type", "content-length"} <= fields.keys() or not fields["content-length"].isdigit():
        return None
    return fields, end + 4


def records_in_range(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, inflated record) of the members that start in [start, end)."""
    window = _Window(file, start)
    while window.at < end:
        if window.left() < len(GZIP_MAGIC) and not window.more():
            return
        found = window.data.find(GZIP_MAGIC, window.pos)
        if found < 0:
            window.skip(max(0, window.left() - len(GZIP_MAGIC) + 1))
            if not window.more():
                return
            continue
        window.skip(found - window.pos)
        if window.at >= end:
            return
        member = _inflate(window)
        if member is None:
            window.skip(1)
            continue
        yield window.at, member[0]
        window.skip(member[1])


def _hex_digest(value: str | None) -> str | None:
    """A ``sha1:`` digest in base 32 or hex as bare lower-case hex."""
    if not value or not value.lower().startswith("sha1:"):
        return None
    bare = value[5:]
    if len(bare) == 32:
        return base64.b32decode(bare.upper()).hex()
    return bare.lower() if re.fullmatch("[0-9A-Fa-f]{40}", bare) else None


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def _row(path: str, offset: int, record: bytes, with_payload: bool) -> tuple:
    fields, begin = parse_header(record)
    block = record[begin : begin + int(fields["content-length"])]
    kind, http = fields["warc-type"], fields.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    own = kind != "revisit"
    return (
        path, offset, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
        _number(fields.get("warc-page-id")), _number(fields.get("warc-refers-to-page-id")),
        _hex_digest(fields.get("warc-payload-digest")), len(payload) if own else None,
        hashlib.sha1(payload).hexdigest() if own else None, payload if own and with_payload else None,
    )


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the files (path, bytes), each read by the task in whose range it starts.

    ``payload_digest`` is the header's, ``payload_bytes`` and ``computed_digest`` are those of the
    payload read, null for revisits, which have none. ``with_payload=False`` leaves the payload
    itself null. Damaged stretches and other gzip members are passed over.
    """
    spark = manifest.sparkSession
    ranges = manifest.filter("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    schema = RECORD
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, place = file_system(path)
                with system.open_input_file(place) as file:
                    rows, held = [], 0
                    for offset, record in records_in_range(file, start, start + split_bytes):
                        rows.append(_row(path, offset, record, with_payload))
                        held += len(record)
                        if held > _CHUNK * 16:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, types)

    dealt = ranges.repartition(shuffle_partitions(spark), "path", "start")
    return dealt.mapInArrow(run, schema)


class MissingRecords(RuntimeError):
    """Archives gave another number of records than their manifest counts."""


def check_records(records: DataFrame, manifest: DataFrame) -> None:
    """Raise :class:`MissingRecords` unless every file gave as many pages as its manifest row counts."""
    pages = records.filter(F.col("record_type").isin("response", "revisit"))
    read = pages.groupBy("path").agg(F.count(F.lit(1)).alias("n_read"))
    wrong = manifest.join(read, "path", "left").filter(F.col("n_records") != F.coalesce(F.col("n_read"), F.lit(0)))
    found = wrong.select("path", "n_records", "n_read").limit(5).collect()
    if found:
        raise MissingRecords("; ".join(f"{r.path}: {r.n_read or 0} of {r.n_records} records" for r in found))


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Pages with the length and digest of their full payload, revisits through what they refer to.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to. A revisit finds a
    response with its digest; adaptive execution splits digests that many revisits share. Without
    one its payload_bytes is null.
    """
    pages = records.filter(F.col("record_type").isin("response", "revisit"))
    responses = pages.filter("record_type = 'response'")
    revisits = pages.filter("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "refers_to")
    lengths = responses.groupBy(F.col("computed_digest").alias("digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    found = revisits.join(lengths, revisits["payload_digest"] == lengths["digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    own = responses.select("page_id", "payload_bytes", F.col("computed_digest").alias("payload_digest"), "record_type", "refers_to")
    return own.unionByName(found.select(*columns))


def archive_pages(pages: DataFrame, folder: str | None = None, split_bytes: int = SPLIT_BYTES, least_bytes: int = 1000) -> DataFrame:
    """Write all ``pages`` (page_id, url, html) as WARC, then read the archives back and resolve them.

    The archives are read once; what was read, without payloads, is written to the shared folder and
    held against the manifest: a damaged stretch raises :class:`MissingRecords` instead of losing rows.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    manifest = write_warc(mark_revisits(pages, least_bytes), folder)
    return read_pages(manifest, split_bytes)


def read_pages(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The pages of the manifest's archives, all of them or :class:`MissingRecords`; see :func:`resolve_revisits`."""
    read = read_warc(manifest, split_bytes, with_payload=False)
    records = cut(read.select("path", "record_type", "page_id", "refers_to", "payload_digest", "payload_bytes", "computed_digest"))
    check_records(records, manifest)
    return resolve_revisits(records)
