"""WARC archives with an index: write, then read selected records by coalesced byte ranges.

Method: index first. While a task writes its archive, it returns for each record the
file, offset, length, URL and digest; only what a finished task returned is in the
index, so archives of lost attempts are never read. A reader takes index rows, sorts
them by file and offset, joins ranges that lie close together into one read, and cuts
the records out of it. Each record is a gzip member of its own.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import own_folder
from .common import durable, shared_table

GAP = 1 << 16
READ = 1 << 23
STRETCH = 1 << 26
ROLL = 1 << 30
INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
#: Fixed value: the header block's lines end so, and two of them end a record.
EOL = b"\r\n"


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as Arrow columns of a Spark schema. Ids stay integers: as pandas numbers, large ones beside a null would be rounded."""
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows) if rows else [[]] * len(fields), fields)], [name for name, _ in fields])


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI and the path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return (fs.LocalFileSystem(), folder) if "://" not in folder else fs.FileSystem.from_uri(folder)


def header_value(text: str | None) -> str:
    """Header lines are UTF-8; line ends and percent signs in a value are escaped."""
    return re.sub(r"[%\r\n]", lambda m: f"%{ord(m[0]):02X}", text or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", header_value(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    head = b"WARC/1.1" + EOL + b"".join(f"{k}: {v}".encode("utf-8", "replace") + EOL for k, v in fields) + EOL
    return gzip.compress(head + body + EOL + EOL, compresslevel=4, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the body."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(EOL + EOL)
    first, *lines = head.split(EOL)
    if not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.decode().lower(): v.decode() for k, v in (x.split(b": ", 1) for x in lines)}
    n = int(fields["content-length"])
    if rest[n:] != EOL + EOL:
        raise ValueError("a record's length doesn't fit its header")
    return fields, rest[:n]


def page_of(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def classify(pages: DataFrame, least: int = 100) -> DataFrame:
    """pages(page_id, url, html, ...) -> page_id, url, html, digest, refers_to.

    Of equal payloads of at least `least` bytes, the row with the smallest page_id is a
    response and refers to nothing; rows repeated with that very page_id are responses
    too. Where every page_id of a group is null, all its rows are responses.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    groups = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # As a table its size is known: few groups are broadcast and no payload is shuffled, many are joined by sorting.
    groups = durable(groups.where("n > 1").select("digest", "first"))
    rows = rows.join(groups, "digest", "left")
    return rows.select("page_id", "url", "html", "digest", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 100) -> DataFrame:
    """Write a record per row into archives in the folder and return the index, already written as a table.

    Null html is an empty payload, null url an empty header value. The folder must be
    reachable from every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page, url, html, digest, refers in (tuple(x.as_py() for x in row) for row in zip(*b.columns)):
                    if out is None or at >= ROLL:
                        if out is not None:
                            out.close()
                        name, at = f"{path}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(name, compression=None)
                    member = record(page, url, html.encode("utf-8", "replace"), digest, refers)
                    out.write(member)
                    rows.append((name, at, len(member), page, url, digest, "response" if refers is None else "revisit", refers))
                    at += len(member)
                yield _batch(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return shared_table(classify(pages, least).mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Index rows -> page_id, url, payload (binary; null for revisits), payload_bytes, payload_digest, record_type, refers_to, as the archives have them. Raises where a payload doesn't have its digest."""
    stretch = F.floor(F.col("offset") / STRETCH)
    parts = max(1, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chosen = index.select("file", "offset", "length").repartition(parts, "file", stretch).sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for b in batches:
            start, rows = 0, list(zip(*(c.to_pylist() for c in b.columns)))
            while start < len(rows):
                (file, low, length), end = rows[start], start + 1
                high = low + length
                while end < len(rows) and rows[end][0] == file and rows[end][1] - high <= GAP and rows[end][1] + rows[end][2] - low <= READ:
                    high = max(high, rows[end][1] + rows[end][2])
                    end += 1
                with store.open_input_file(file) as f:
                    f.seek(low)
                    data = io.BytesIO(f.read(high - low)).getbuffer()
                found = []
                for _, offset, length in rows[start:end]:
                    fields, body = parse(bytes(data[offset - low : offset - low + length]))
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"payload and digest differ in {file} at {offset}")
                    refers = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
                    size = len(body) if kind == "response" else int(fields["x-payload-length"])
                    found.append((page_of(fields["warc-record-id"]), re.sub("%(25|0D|0A)", lambda m: chr(int(m[1], 16)), fields["warc-target-uri"]), body if kind == "response" else None, size, digest, kind, refers))
                yield _batch(found, RECORD)
                start = end

    return chosen.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write the archives of all pages into the shared folder and read every record back."""
    folder = f"{own_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_records(write_archives(pages, folder, least), folder)
