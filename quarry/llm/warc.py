"""WARC archives: writing pages, and a splittable reader.

Writing.  Every record is its own gzip member.  Payloads are compared by
SHA-1: of equal payloads the row with the smallest id is written as a
``response``, the others as ``revisit`` records without payload that refer to
it (payloads shorter than ``min_bytes`` are always responses).  Each task
writes its own archive files into the shared folder under a name that no
other attempt has, and reports them; only reported files are read, so a lost
or repeated task leaves nothing wrong behind.

Reading.  Archives are cut into byte ranges.  A task looks for the gzip magic
in its range, checks each candidate by inflating it and parsing a WARC header,
and owns the records that start inside the range (reading past its end for the
last one).  No index and no record-aligned splits are needed.

Defined results: a null payload counts as empty; empty payloads are equal
payloads like any others; rows without an id never serve as the smallest and
are responses unless another row has their payload; rows that repeat the
smallest id with its payload are responses; columns other than the named ones
are ignored; no rows give no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read, store
from quarry.session import shared_dir

MAGIC = b"\x1f\x8b\x08"
#: Bytes that a reader fetches at a time.
CHUNK = 1 << 18
#: What a record begins with.
VERSION = b"WARC/1."

RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, digest_ok boolean, payload binary")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that a path or URI lives in, seen from any machine."""
    return fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(id, url, payload, original): ``original`` is the id of the response
    that a row revisits, null for responses."""
    rows = pages.withColumn("_sha", F.sha1("payload"))
    # written: between two plain exchanges, adaptive execution can split a hot payload's join
    repeated = store(rows.where(F.octet_length("payload") >= min_bytes).groupBy("_sha")
                     .agg(F.min("id").alias("_first"), F.count("*").alias("_n"))
                     .where("_n > 1").select(F.col("_sha").alias("_key"), "_first"), "repeated")
    return rows.join(repeated, F.col("_sha") == F.col("_key"), "left").select(
        "id", "url", "payload",
        F.when(F.col("_first").isNotNull() & ~F.col("id").eqNullSafe(F.col("_first")),
               F.col("_first")).alias("original"))


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None) -> bytes:
    """One WARC record, compressed as a gzip member."""
    digest = _digest(payload)
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http if original is not None else http + payload
    name = page_id if page_id is not None else "none-" + uuid.uuid5(
        uuid.NAMESPACE_URL, f"{url} {digest}").hex
    lines = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if original is not None:
        lines += [f"WARC-Refers-To: <urn:page:{original}>", "WARC-Profile: "
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    data = ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(pages: DataFrame, page_id: str, url: str, html: str, folder: str,
                   min_bytes: int = 0, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write the archives now; (path, size) of each file."""
    rows = with_originals(pages.select(
        F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")), min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size = None, "", 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    place, inner = _open(path)
                    place.create_dir(os.path.dirname(inner), recursive=True)
                    out = place.open_output_stream(inner, compression=None)
                data = record(*row)
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    out.close()
                    yield pa.record_batch({"path": [path], "size": pa.array([size], pa.int64())})
                    out = None
        if out is not None:
            out.close()
            yield pa.record_batch({"path": [path], "size": pa.array([size], pa.int64())})

    files = rows.mapInArrow(run, "path string, size long").collect()   # one row per archive
    return pages.sparkSession.createDataFrame(files, "path string, size long")


def _find(f, start: int, end: int) -> int:
    """Position of the next gzip magic that starts in [start, end), or -1."""
    while start < end:
        f.seek(start)
        data = f.read(min(CHUNK, end - start) + len(MAGIC) - 1)
        at = data.find(MAGIC)
        if 0 <= at < end - start:
            return start + at
        if len(data) < len(MAGIC):
            return -1
        start += len(data) - len(MAGIC) + 1
    return -1


def _member(f, at: int) -> tuple[bytes, int] | None:
    """The inflated gzip member at ``at`` and its length, or None if there is
    no WARC record.  What does not begin like a record is left at once; a
    record's header may be of any length."""
    inflate, data, fed, step = zlib.decompressobj(31), bytearray(), 0, 4096
    f.seek(at)
    while not inflate.eof:
        more = f.read(step)
        if not more:
            return None
        try:
            data += inflate.decompress(more)
        except zlib.error:
            return None
        fed += len(more)
        step = CHUNK
        if not VERSION.startswith(data[:len(VERSION)]):
            return None
    if len(data) < len(VERSION) or b"\r\n\r\n" not in data:
        return None
    return bytes(data), fed - len(inflate.unused_data)


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _page(urn: str) -> int | None:
    name = urn.strip("<>").removeprefix("urn:page:")
    return int(name) if name.lstrip("-").isdigit() else None


def parse(data: bytes) -> dict:
    """A record's columns; of a revisit the payload is null, and its length is
    that of the HTTP header it keeps."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    http, _, payload = rest[:int(warc["content-length"])].partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    return {"page_id": _page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
            "record_type": warc["warc-type"],
            "refers_to": _page(warc["warc-refers-to"]) if revisit else None,
            "payload_bytes": int(_fields(http)["content-length"]) if revisit else len(payload),
            "payload_digest": digest if revisit else _digest(payload),
            "digest_ok": None if revisit else _digest(payload) == digest,
            "payload": None if revisit else payload}


def read_archives(files: DataFrame, split_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """The records (see RECORD) of the archives listed in ``files`` (path,
    size); without ``payloads`` that column stays null."""
    spark = files.sparkSession
    ranges = (files.where("size > 0").withColumn("start", F.explode(F.expr(
        f"sequence(0L, size - 1, {int(split_bytes)}L)"))).select("path", "start", "size"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
                        ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                place, inner = _open(path)
                rows, held, end = [], 0, min(size, start + split_bytes)
                with place.open_input_file(inner) as f:
                    at = _find(f, start, end)
                    while at >= 0:
                        member = _member(f, at)
                        if member is None:
                            at = _find(f, at + 1, end)
                            continue
                        row = parse(member[0])
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(member[0])
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                        at = _find(f, at + member[1], end)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.repartition(tasks, "path", "start").mapInArrow(run, RECORD)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "llm", f"warc-{uuid.uuid4().hex[:10]}")
    files = write_archives(read(spark, sf_dir, "pages"), "page_id", "url", "html", folder)
    return read_archives(files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
