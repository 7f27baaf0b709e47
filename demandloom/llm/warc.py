"""WARC archives: write records, index them first, then read the selected ones in coalesced byte ranges.

Each record is a gzip member of its own, so that offset and length in the index are all a reader needs. The index is a
table (file, offset, length, url, digest) written with the archives; a selection is a filter on it. Selected entries are
sorted by file and offset, neighbours become one ranged read, and records are parsed from the bytes in memory.

Files are opened through Arrow's file systems by URI, so the archive folder may be on any store Arrow knows. A task
names its files afresh on every attempt, and only the index says which files count: a lost or repeated task leaves an
unused file behind, never a wrong record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.storage import written
from demandloom.session import scratch_path

FILE_BYTES = 256 << 20  # a new file after that many bytes
RANGE_BYTES = 8 << 20  # one ranged read holds at most that many, or one record
READ_BYTES = 32 << 20  # archive bytes of one task, about
GAP_BYTES = 64 << 10  # read through unselected bytes up to that many
DATE = "2000-01-01T00:00:00Z"  # archives of equal pages are equal byte for byte

INDEX = (
    "page_id bigint, file string, offset bigint, length bigint, url string, payload_digest string, payload_bytes bigint, "
    "record_type string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One compressed WARC record; a revisit keeps the payload's digest and length but not the payload."""
    name = "none" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload))), ("Content-Type", "text/html"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))  # a header is one line
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{'none' if refers_to is None else refers_to}>")]
    block = b"" if revisit else payload
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{key}: {value}\r\n" for key, value in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block; raises where the bytes are not one whole record."""
    raw = gzip.decompress(data)
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {key.lower(): value for key, _, value in (line.partition(": ") for line in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) != size + 4:
        raise ValueError("a WARC record of the wrong length")
    return fields, rest[:size]


def _page(value: str | None) -> int | None:
    name = value[len("<urn:page:"):-1] if value else "none"
    return None if name == "none" else int(name)


def _writer(folder: str):
    names = [part.split()[0] for part in INDEX.split(", ")]
    kinds = [pa.int64() if part.split()[1] == "bigint" else pa.string() for part in INDEX.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, refers_to, revisit in zip(*[column.to_pylist() for column in batch.columns]):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    digest = base32_sha1(payload)
                    data = record_bytes(page_id, url, payload, digest, refers_to, revisit)
                    out.write(data)
                    rows.append((page_id, name, at, len(data), url, digest, len(payload), "revisit" if revisit else "response"))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(column), kind) for column, kind in zip(zip(*rows) if rows else [()] * len(names), kinds)], schema=schema)
        finally:
            if out is not None:
                out.close()

    return run


def _reader(folder: str):
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        source, opened = None, None

        def read(name: str, entries: list[tuple[int, int]]) -> pa.RecordBatch:
            nonlocal source, opened
            if opened != name:
                if source is not None:
                    source.close()
                source, opened = system.open_input_file(f"{root}/{name}"), name
            first, end = entries[0][0], max(at + length for at, length in entries)
            data, rows = source.read_at(end - first, first), []
            for at, length in entries:
                fields, block = parse_record(data[at - first : at - first + length])
                revisit = fields["warc-type"] == "revisit"
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if not revisit and base32_sha1(block) != digest:
                    raise ValueError(f"{name} at {at}: payload and digest differ")
                rows.append((
                    _page(fields["warc-record-id"]), int(fields["warc-payload-length"]), digest, fields["warc-type"],
                    _page(fields.get("warc-refers-to")), fields.get("warc-target-uri"), None if revisit else block))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        name, entries, first, end = "", [], 0, 0
        try:
            for batch in batches:
                for file, at, length in zip(*[column.to_pylist() for column in batch.columns]):
                    if entries and (file != name or at > end + GAP_BYTES or max(end, at + length) - first > RANGE_BYTES):
                        yield read(name, entries)
                        entries = []
                    if not entries:
                        name, first, end = file, at, at
                    entries.append((at, length))
                    end = max(end, at + length)
            if entries:
                yield read(name, entries)
        finally:
            if source is not None:
                source.close()

    return run


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder`` and return the index, written.

    The payload is the html in UTF-8, nothing for null. Among payloads of at least ``least`` bytes that are equal, the one
    with the smallest ``page_id`` is a response and the others are revisits of it; smaller payloads are responses.
    Repeated rows of that smallest page are responses all. Rows without ``page_id`` are revisits where a page with one
    has the payload, responses otherwise. Other columns are ignored; an empty table gives an empty index.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    names = rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    # Only payloads held by several pages are joined, so most rows pass by and a frequent one is AQE's to split.
    shared = names.where(F.col("size") >= least).groupBy("digest", "size").agg(
        F.min("page_id").alias("first"), F.count("*").alias("held")).where("held > 1").select("digest", "first")
    told = rows.withColumn("digest", F.sha1("payload")).join(shared, "digest", "left")
    revisit = F.coalesce(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.lit(False))
    placed = told.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    return written(placed.mapInArrow(_writer(folder), INDEX), "warc-index")


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows, read in file order: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, payload`` (payload null for revisits).

    Tasks follow the bytes to read, not the size of the index: entries are dealt by stretches of ``READ_BYTES`` of a file.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    entries = index.select("file", "offset", "length").repartition(
        max(1, -(-total // READ_BYTES)), "file", F.floor(F.col("offset") / F.lit(READ_BYTES))).sortWithinPartitions("file", "offset")
    return entries.mapInArrow(
        _reader(folder), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "url string, payload binary")


def hadoop_qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark's file system gives it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def archive_folder(docs: DataFrame, qualified: Callable[[SparkSession, str], str] = hadoop_qualified) -> str:
    """A fresh archive folder in the shared folder, as a URI that Arrow resolves to the place Spark means."""
    uri = qualified(docs.sparkSession, scratch_path(docs.sparkSession, "warc"))
    return f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") and not uri.startswith("file://") else uri
