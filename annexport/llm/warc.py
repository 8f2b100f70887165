"""WARC archives with revisit resolution.

Headers (id, payload digest, length) are shuffled without their payloads. The least id of each
digest that occurs more than once is found by a pre-aggregated minimum; records join it by digest,
and every record but that one becomes a revisit that refers to it. A digest that a third of all
records share is a skewed side of a plain join, which Spark splits. Payloads move once at most, when
the pages join the list of revisits by id and digest.

Archives are gzip-compressed record by record, under names unique to a task attempt. A task returns
the names of the archives it closed, and only the committed list of archives counts: a repeated attempt cannot
leave half an archive in it. Headers are new: record ids from the record's key, one date a run,
block and payload digests, lengths, and for revisits the profile and the record referred to.

Edge cases: a NULL payload is empty. Payloads under ``MIN_BYTES`` bytes are always responses, and so are
records with a NULL id that no other id precedes. Rows that repeat the least id of a payload are all
responses. A NULL URL is written as an empty target. Only the three named columns are read, so others cannot
clash. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annexport.session import scratch_path, staged

MIN_BYTES = 100
ARCHIVE_BYTES = 64 << 20  # an archive is closed when it has grown so large
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed: URLs, by RFC 4122
CRLF = b"\r\n"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the path in it."""
    if uri.startswith("s3a:"):
        uri = "s3:" + uri[4:]
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def resolved(pages: DataFrame, identifier: str = "page_id", payload: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(id, digest, length, refers_to): refers_to is NULL for responses."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    headers = staged(pages.select(
        F.col(identifier).alias("id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("length")
    ), "headers")
    shared = headers.where(F.col("length") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    ).where((F.col("n") > 1) & F.col("first").isNotNull()).drop("n")
    joined = headers.join(staged(shared, "originals"), "digest", "left")
    return joined.select(
        "id", "digest", "length",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'record/{key}')}>"


def record(key: object, url: str, payload: bytes, digest: str, length: int, refers_to: object, date: str) -> bytes:
    """One record: a whole HTTP response, or a revisit that carries the HTTP header alone."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % length]) + CRLF * 2
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key)), ("WARC-Date", date),
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Source-Key", "" if key is None else str(key)),
        ("WARC-Payload-Length", str(length)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("WARC-Refers-To-Key", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields).encode() + CRLF + block + CRLF * 2


def write_archives(pages: DataFrame, folder: str, identifier: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages and returns the committed list (path, n_records) of archives."""
    verdicts = staged(resolved(pages, identifier, payload, min_bytes).where("refers_to is not null").select("id", "digest", "refers_to").distinct(), "revisits")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(identifier).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("body"),
        F.sha2(body, 256).alias("digest"),
    )
    # Repeats of the same id and payload share a verdict; the id alone may stand for two payloads.
    same = rows["id"].eqNullSafe(verdicts["id"]) & (rows["digest"] == verdicts["digest"])
    rows = rows.join(verdicts, same, "left").select(
        rows["id"].cast("string").alias("id"), "url", F.when(F.col("refers_to").isNull(), F.col("body")).alias("body"),
        rows["digest"], F.octet_length("body").cast("long").alias("length"), F.col("refers_to").cast("string").alias("refers_to"),
    )
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)
        out, path, n, size = None, "", 0, 0
        closed: list[tuple[str, int]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                key, link, text, digest, length, refers = (batch.column(c)[i].as_py() for c in range(6))
                if out is None:
                    path, n, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                    out.write(gzip.compress(_info(date)))
                part = gzip.compress(record(key, link, text or b"", digest, length, refers, date), 6)
                out.write(part)
                n, size = n + 1, size + len(part)
                if size >= archive_bytes:
                    out.close()
                    closed.append((path, n))
                    out = None
        if out is not None:
            out.close()
            closed.append((path, n))
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in closed], "n_records": [k for _, k in closed]}, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64())]))

    return staged(rows.mapInArrow(write, "path string, n_records long"), "archives")


def _info(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + f"<urn:uuid:{uuid.uuid4()}>".encode() + b"\r\nWARC-Date: " + date.encode() + b"\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n" % len(block) + block + CRLF * 2


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an uncompressed stream; one record is held at a time."""
    while True:
        version = stream.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (CRLF, b""):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or stream.read(4) != CRLF * 2:
            raise ValueError("a record is cut off")
        yield headers, block


COLUMNS = "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def read_archives(spark: SparkSession, folder: str, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the listed archives. Digests of responses are computed from what was read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(folder)
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as whole:
                    for headers, block in records(io.BufferedReader(whole)):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        body = block.partition(CRLF * 2)[2]
                        response = headers["WARC-Type"] == "response"
                        rows.append((
                            headers["WARC-Source-Key"] or None, headers["WARC-Target-URI"], headers["WARC-Type"],
                            len(body) if response else int(headers["WARC-Payload-Length"]),
                            hashlib.sha256(body).hexdigest() if response else headers["WARC-Payload-Digest"].partition(":")[2],
                            headers.get("WARC-Refers-To-Key"), body if response and payloads else None,
                        ))
                        held += len(block)
                        if held > 8 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)

    # As many partitions as archives: the list is small, and would be merged into one task.
    return archives.select("path").repartition(max(1, archives.count()), "path").mapInArrow(read, COLUMNS)


_TYPES = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "archives")
