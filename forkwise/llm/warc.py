"""WARC archives through a table of chunks.

``chunk_table`` cuts each payload into rows of record identifier and chunk number. The
writer streams these rows into gzip members, one per record, and never holds more than one
chunk; the reader streams records back into chunk rows, each with the SHA-1 and length of
the payload so far, so that the last row of a record carries those of the whole payload.

Of records with equal payloads of at least ``min_bytes``, that with the largest page_id is a
response and the others revisit it; smaller ones are all responses. A revisit holds the HTTP
header only, whose Content-Length is that of the payload.

The folder may be of any scheme that pyarrow opens and must be shared by all executors.
Each task attempt writes a file of its own; the manifest names those of the attempts that
finished, and the reader opens no others.

Defined cases: null html is an empty payload; a null url leaves out the target; a null
page_id is smaller than any other and is read back as null. Repeated rows with the largest
page_id are responses each. An empty table writes no file and reads back empty. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_enough, text_bytes, written

MIN_BYTES = 1000
CHUNK_BYTES = 1 << 16
#: Digests of repeated payloads up to this many are broadcast (about 20 MB); more are joined by a shuffle.
BROADCAST_DIGESTS = 200_000

CHUNKS = "page_id long, record_type string, refers_to long, target_uri string, payload_digest string, declared_bytes long, chunk_no int, data binary, bytes_so_far long, sha1_so_far string, last boolean"


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` with payload_digest, payload_bytes, record_type and refers_to."""
    rows = pages.select("page_id", "url", "html", F.sha1(text_bytes("html")).alias("payload_digest"), F.octet_length(text_bytes("html")).cast("bigint").alias("payload_bytes"))
    again = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 AND keeper IS NOT NULL").drop("n")
    again = written(again, "repeated")
    rows = rows.join(F.broadcast(again) if small_enough(again, BROADCAST_DIGESTS) else again, "payload_digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.select("page_id", "url", "html", "payload_digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("keeper")).alias("refers_to"))


def chunk_table(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each chunk of a record's payload, in order; one, empty, for a revisit."""
    n = F.when(F.col("record_type") == "revisit", F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("payload_bytes") / chunk_bytes))).cast("int")
    rows = rows.select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", text_bytes("html").alias("payload"), n.alias("n_chunks"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    data = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return rows.select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "n_chunks", "chunk_no", data.alias("data"))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _head(row: dict) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_urn(row['page_id'])}", "WARC-Date: 2024-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~')}")
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode())
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(row['refers_to'])}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}", "", ""]
    return "\r\n".join(lines).encode() + http


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write the rows of a chunk table; returns the manifest ``(path, n_records)``, itself a written table."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path, out, n = None, "", None, 0
        gz = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs, root = FileSystem.from_uri(folder)
                    fs.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, path = fs.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}"
                if row["chunk_no"] == 0:
                    gz = zlib.compressobj(4, zlib.DEFLATED, 31)
                    out.write(gz.compress(_head(row)))
                    n += 1
                out.write(gz.compress(row["data"]))
                if row["chunk_no"] == row["n_chunks"] - 1:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])

    return written(chunks.mapInArrow(made, "path string, n_records long"), "manifest")


def _records_in(stream, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of an archive."""

    def header() -> dict[str, str]:
        found = {}
        while line := stream.readline().rstrip(b"\r\n"):
            k, _, v = line.partition(b":")
            found[k.decode().lower()] = v.strip().decode()
        return found

    def page(urn: str | None) -> int | None:
        n = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(n) if n else None

    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        warc = header()
        left = int(warc["content-length"])
        status = stream.readline()
        left -= len(status)
        declared = 0
        while True:
            h = stream.readline()
            left -= len(h)
            if not h.strip():
                break
            k, _, v = h.partition(b":")
            declared = int(v) if k.lower() == b"content-length" else declared
        row = {"page_id": page(warc["warc-record-id"]), "record_type": warc["warc-type"], "refers_to": page(warc.get("warc-refers-to")), "target_uri": warc.get("warc-target-uri"), "payload_digest": base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex(), "declared_bytes": declared}
        sha, size, no = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk_bytes, left))
            if left and not data:
                raise ValueError("an archive ends within a record")
            left -= len(data)
            sha.update(data)
            size += len(data)
            yield row | {"chunk_no": no, "data": data, "bytes_so_far": size, "sha1_so_far": sha.copy().hexdigest(), "last": not left}
            no += 1
            if not left:
                break
        if row["record_type"] == "response" and (size != declared or sha.hexdigest() != row["payload_digest"]):
            raise ValueError(f"the payload of page {row['page_id']} is not the one that was written")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of all archives that ``manifest(path)`` names; see ``CHUNKS`` for the columns."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = FileSystem.from_uri(uri)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as f, gzip.GzipFile(fileobj=io.BufferedReader(f, 1 << 18)) as stream:
                    for row in _records_in(stream, chunk_bytes):
                        rows.append(row)
                        size += len(row["data"])
                        if size >= 1 << 22 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    n = max(1, min(manifest.count(), 4096))
    return manifest.select("path").repartition(n, "path").mapInArrow(made, CHUNKS)


SCHEMA = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("declared_bytes", pa.int64()), ("chunk_no", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_())])
