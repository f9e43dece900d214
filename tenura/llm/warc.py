"""WARC archives: three records per capture, and their assembly through concurrent-to identifiers."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.common import SharedFiles, arrow_schema, batch_of, kind_of, same, text_batches
from tenura.session import scratch_path, settle

FILE_BYTES = 16 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORDS = (
    "file string, position long, record_id string, type string, target_uri string, "
    "concurrent_to array<string>, refers_to string, payload_digest string, digest_agrees boolean, "
    "http string, fields map<string,string>, payload_bytes long, payload binary"
)
CAPTURES = ("response", "revisit", "resource")


def base32_sha1(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    whole = b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def capture_records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The capture's response or revisit, request and metadata records, each a gzip member."""
    uri = " ".join((url or "").split())
    own, target = _urn(page_id, digest), [("WARC-Target-URI", uri)] if uri else []
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind, block = "response", http + payload
    headers = [*target, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        kind, block = "revisit", http
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to, digest))]
    asked = f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode()
    said = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return b"".join([
        _record(kind, own, headers, block),
        _record("request", _urn(own, "request"), [*target, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], asked),
        _record("metadata", _urn(own, "metadata"), [*target, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], said),
    ])


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest and refers_to (the page whose record holds the payload; null: this one).

    Of the pages with equal payloads of at least ``min_bytes`` bytes that with the
    largest page_id holds it. A null page_id is smaller than any other.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    keys = rows.filter(F.length("payload") >= min_bytes).select("page_id", "sha1")
    holders = keys.groupBy("sha1").agg(F.max("page_id").alias("holder"))
    # ids only: adaptive execution splits the digest of a large group of copies here
    revisits = (
        keys.distinct().join(holders, "sha1")
        .filter(~F.col("page_id").eqNullSafe(F.col("holder")))
        .select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), F.col("holder").alias("refers_to"))
    )
    # pages meet their own decision, one for each page
    return rows.join(revisits, same(rows["page_id"], revisits["_id"]) & (rows["sha1"] == revisits["_sha1"]), "left").drop("_id", "_sha1")


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes three records for each page (page_id, url, html) and returns one row per file: file, captures, bytes.

    Files are gzip members, one per record, and end after the record that brings them
    to ``file_bytes``. A null html is an empty payload, a null url leaves out the
    target, a null page_id leaves out the id. Rows that repeat a page_id and a payload
    write the same records again. An empty table writes nothing; other columns are
    not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    columns = "file string, captures long, bytes long"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, part, seq = SharedFiles(folder), TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, seq
            name = f"part-{part:07d}-{seq:06d}.warc.gz"
            row = (name, len(held), files.write(name, iter(held)))
            held, size, seq = [], 0, seq + 1
            return batch_of(shape, [row])

        for frame in text_batches(frames, "payload"):
            for page_id, url, payload, sha1, refers_to in zip(*[frame.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "refers_to")], strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                held.append(capture_records(page_id, url, payload, digest, refers_to))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
        if held:
            yield close()

    rows = with_revisits(pages, min_bytes).select("page_id", "url", "payload", "sha1", "refers_to")
    # a fixed order in each task: a repeated attempt cuts the same files
    return settle(rows.sortWithinPartitions("page_id", "sha1", "url").mapInArrow(task, columns))


def members(raw: memoryview) -> Iterator[tuple[int, bytes]]:
    """Position and content of each gzip member; a file without compression is one."""
    if bytes(raw[:2]) != b"\x1f\x8b":
        if len(raw):
            yield 0, bytes(raw)
        return
    at = 0
    while at < len(raw):
        start, step, out, unpack = at, 1024, [], zlib.decompressobj(31)
        while not unpack.eof:
            if at >= len(raw):
                raise ValueError(f"the archive ends inside the member at {start}")
            piece = raw[at : at + step]
            out.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
            step *= 2
        yield start, b"".join(out)


def _headers(raw: bytes) -> list[tuple[str, str]]:
    pairs = [line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n") if ":" in line]
    return [(k.strip().lower(), v.strip()) for k, _, v in pairs]


def parse_records(raw: memoryview) -> Iterator[tuple[object, ...]]:
    """Rows of ``RECORDS`` without the file's name."""
    for position, content in members(raw):
        at = 0
        while at < len(content):
            cut = content.find(b"\r\n\r\n", at)
            if not content.startswith(b"WARC/", at) or cut < 0:
                raise ValueError(f"no WARC record at {position} + {at}")
            headers = _headers(content[at:cut])
            first = dict(reversed(headers))
            length = int(first["content-length"])
            block = content[cut + 4 : cut + 4 + length]
            kind, http, payload, fields = first.get("warc-type"), None, None, None
            size, own = None, None
            if "application/http" in first.get("content-type", ""):
                head, _, body = block.partition(b"\r\n\r\n")
                http = head.decode("utf-8", "replace")
                if kind == "revisit":
                    size = int(dict(_headers(head)).get("content-length", 0))
                elif kind in CAPTURES:
                    payload, size = body, len(body)
            elif first.get("content-type", "") == "application/warc-fields":
                fields = _headers(block)
            elif kind in CAPTURES:
                payload, size = block, length
            stated = first.get("warc-payload-digest", "").removeprefix("sha1:") or None
            if payload is not None:
                own = base32_sha1(payload)
            yield (
                position, first.get("warc-record-id"), kind, first.get("warc-target-uri"),
                [v for k, v in headers if k == "warc-concurrent-to"], first.get("warc-refers-to"),
                own or stated, None if own is None or stated is None else own == stated, http, fields, size, payload,
            )
            at = cut + 4 + length
            while content.startswith(b"\r\n", at):
                at += 2


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``; columns as in ``RECORDS``."""
    columns = RECORDS if with_payload else RECORDS.removesuffix(", payload binary")
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(len(frame)):
                name, out, size = frame.column("file")[i].as_py(), [], 0
                for row in parse_records(memoryview(frame.column("content")[i].as_buffer())):
                    out.append((name, *(row if with_payload else row[:-1])))
                    size += 1024 + len(row[-1] or b"")
                    if size > 16 << 20:
                        yield batch_of(shape, out)
                        out, size = [], 0
                yield batch_of(shape, out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content").mapInArrow(task, columns)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response, request, metadata, n_requests, n_metadata.

    A request or metadata record belongs to the capture that its concurrent-to names,
    or that names it. Of several, that with the smallest id is kept and all are
    counted. Repeated records count once. Records whose capture is nowhere give a row
    with a null response; records that name no capture give none. ``records`` is read
    several times: hand over a written table.
    """
    about = [c for c in records.columns if c not in ("record_id", "type", "concurrent_to")]
    whole = F.struct("record_id", "type", *about)
    captures = records.filter(F.col("type").isin(*CAPTURES))
    responses = captures.groupBy("record_id").agg(F.min_by(whole, F.struct("file", "position")).alias("response"))
    parts = records.filter(F.col("type").isin("request", "metadata"))
    named = captures.select(F.col("record_id").alias("key"), F.explode("concurrent_to").alias("record_id"))
    linked = parts.select(F.explode("concurrent_to").alias("key"), *parts.columns).unionByName(
        parts.join(named, "record_id").select("key", *parts.columns)
    )

    once = linked.groupBy("key", "type", "record_id").agg(F.min_by(whole, F.struct("file", "position")).alias("row"))
    sides = [
        once.filter(F.col("type") == kind).groupBy("key").agg(F.min_by("row", "record_id").alias(name), F.count(F.lit(1)).alias(f"n_{plural}"))
        for kind, name, plural in (("request", "request", "requests"), ("metadata", "metadata", "metadata"))
    ]
    both = sides[0].join(sides[1], "key", "full_outer")
    joined = responses.withColumnRenamed("record_id", "key").join(both, "key", "full_outer")
    return joined.select(
        F.col("key").alias("record_id"), "response", "request", "metadata",
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"),
    )


def page_captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as archives, reads them back, and gives one row per page; ``refers_to`` is the page of the response.

    Rows that repeat a page_id and a payload are one capture.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder, min_bytes)
    SharedFiles(folder)
    captures = settle(assemble(settle(read_warc(spark, folder, with_payload=False))).select(
        "record_id",
        F.col("metadata.fields")["page-id"].cast(kind_of(pages, "page_id")).alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("named"),
        F.col("response.target_uri").alias("target_uri"),
        F.col("request.record_id").isNotNull().alias("has_request"),
    ))
    held = captures.filter("record_type = 'response'").select(F.col("record_id").alias("named"), F.col("page_id").alias("refers_to"))
    # many revisits may name one response: only those rows are joined, and a hot key is split
    revisits = captures.filter("named is not null").join(held, "named", "left")
    others = captures.filter("named is null").withColumn("refers_to", F.lit(None).cast(kind_of(pages, "page_id")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "has_request"]
    return others.select(columns).unionByName(revisits.select(columns))
