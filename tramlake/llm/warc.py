"""WARC archives: writing, normalising monolithic gzip files, and reading records back by offset.

The normaliser inflates a file that was compressed as one stream exactly once, rewrites every record as a gzip member of its
own, and writes a sidecar index (a line a record: offset, length, record id) beside it. Records can then be read singly. Files are the unit of
work; a record is the most that stands in memory.

Each task names its files anew, and only the manifest rows of tasks that ended well are used, so a lost executor or a second
attempt leaves unused files at worst. The monolithic files are deleted once the manifest of the normalised ones is written. Files lie in
the store that Spark takes for the folder's path.

Defined cases: null html is an empty payload, and equal to other empty ones; rows that share a payload and its least page_id are all
responses; a null page_id comes after all others; a null url is written as urn:page:<page_id>; an empty table gives no files.
"""

from __future__ import annotations

import zlib
from base64 import b32encode
from hashlib import sha1
from uuid import UUID, uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tramlake.llm.common import as_bytes, cut, shared_dir
from tramlake.llm.files import delete, open_read, open_write, qualified

#: Uncompressed bytes after which a writer begins a new file, and bytes that are read at once.
FILE_BYTES, READ_BYTES = 32 << 20, 1 << 20
#: Repeated payloads up to this number are broadcast (28 bytes each); beyond it they are joined by a shuffle.
BROADCAST_ROWS = 50_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compression levels of the monolithic files, which are read once, and of the members.
RAW_LEVEL, MEMBER_LEVEL = 1, 4


def record_id(page_id: int | None) -> str:
    """A UUID of version 8 that holds the page id."""
    n = (1 << 64) if page_id is None else page_id & (1 << 64) - 1
    return f"<urn:uuid:{UUID(int=(n >> 62) << 64 | 8 << 76 | 2 << 62 | n & (1 << 62) - 1)}>"


def digest(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes | None, size: int, sha: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record; payload is left out of a revisit, whose HTTP header keeps its length."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", *([] if refers_to is None else [f"WARC-Refers-To-Page-ID: {refers_to}"])]
    head += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def inflated(file):
    """Bytes of a gzip file of one or more members, inflated piece by piece."""
    stream = zlib.decompressobj(31)
    while data := file.read(READ_BYTES):
        while data:
            if stream.eof:
                stream = zlib.decompressobj(31)
            yield stream.decompress(data, READ_BYTES)
            data = stream.unconsumed_tail or stream.unused_data
    if tail := stream.flush():
        yield tail


def records(pieces):
    """Whole records, one by one, from the pieces of an inflated archive."""
    held, pieces = bytearray(), iter(pieces)

    def fill() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill():
                if held.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        size = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
        while len(held) < size:
            if not fill():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[:size])
        del held[:size]


def parse(data: bytes) -> dict:
    """A record's columns; a response's length and digest are those of its payload as read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    own = headers(head)
    block = rest[: int(own["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = own["warc-type"] == "revisit"
    number = lambda name: int(own[name]) if name in own else None
    sha = own["warc-payload-digest"].removeprefix("sha1:") if revisit else digest(payload)
    if sha != own["warc-payload-digest"].removeprefix("sha1:"):
        raise ValueError(f"{own['warc-record-id']}: payload and digest differ")
    size = int(headers(http)["content-length"]) if revisit else len(payload)
    return {"page_id": number("warc-page-id"), "payload_bytes": size, "payload_digest": sha, "record_type": own["warc-type"], "refers_to": number("warc-refers-to-page-id")}


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, revisit and refers_to: of equal payloads, the least page_id is the response."""
    hashed = pages.select("page_id", "url", as_bytes("html").alias("payload")).withColumn("sha", F.sha1("payload"))
    # Counted inside tasks first, so a payload that a third of all pages share is a row a task here.
    groups = pages.select("page_id", F.sha1(as_bytes("html")).alias("sha")).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = cut(groups.where("n > 1").select("sha", "first"))
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return hashed.join(side, "sha", "left").select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), F.length("payload").alias("size"), "sha", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of one gzip stream each; the result is their manifest (path, records)."""

    def written(batches):
        file = stream = path = None
        size = n = 0

        def closed():
            file.write(stream.flush())
            file.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

        for batch in batches:
            for page_id, url, payload, length, sha, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is None:
                    path, size, n = f"{folder}/{uuid4().hex}.raw.warc.gz", 0, 0
                    file, stream = open_write(path), zlib.compressobj(RAW_LEVEL, zlib.DEFLATED, 31)
                data = record(page_id, url, payload, length, b32encode(bytes.fromhex(sha)).decode(), refers_to, revisit)
                file.write(stream.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield closed()
                    file = None
        if file is not None:
            yield closed()

    return rows.select("page_id", "url", "payload", "size", "sha", "revisit", "refers_to").mapInArrow(written, "path string, records bigint")


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrites each file of the manifest into a folder, with a member a record and a sidecar index; the result is the new manifest
    (path, index, records)."""

    def rewritten(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = f"{folder}/{uuid4().hex}"
                at = n = 0
                with open_read(path) as source, open_write(f"{name}.warc.gz") as target, open_write(f"{name}.idx") as index:
                    for data in records(inflated(source)):
                        stream = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
                        member = stream.compress(data) + stream.flush()
                        target.write(member)
                        index.write(f"{at}\t{len(member)}\t{headers(data[: data.index(b'\r\n\r\n')])['warc-record-id']}\n".encode())
                        at, n = at + len(member), n + 1
                yield pa.RecordBatch.from_arrays([pa.array([f"{name}.warc.gz"]), pa.array([f"{name}.idx"]), pa.array([n], pa.int64())], names=["path", "index", "records"])

    return manifest.select("path").mapInArrow(rewritten, "path string, index string, records bigint")


def read_records(manifest: DataFrame) -> DataFrame:
    """The records of normalised archives, each read by its offset in the index."""
    fields = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def read(batches):
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist(), strict=True):
                out = []
                with open_read(path) as file, open_read(index) as listed:
                    for line in listed.read().splitlines():
                        at, length, _ = line.split(b"\t")
                        file.seek(int(at))
                        out.append(parse(zlib.decompress(file.read(int(length)), 31)))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in fields.items()], names=[*fields])

    return manifest.select("path", "index").mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def archive(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages as WARC and normalises the files; the result is the manifest of the normalised archives."""
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    raw = cut(write_monolithic(decided(pages), f"{folder}/raw"))
    # A file is the unit of work: no more tasks than files, and no fewer, however many there are.
    out = cut(normalise(raw.repartition(max(1, raw.count()), "path"), folder))
    delete(spark, f"{folder}/raw")
    return out


def query(pages: DataFrame) -> DataFrame:
    return read_records(archive(pages, f"{shared_dir(pages.sparkSession)}/warc-{uuid4().hex}"))


# Base 32 by blocks of 20 bits: five hex digits make four characters.
SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, upper(sha1(payload)) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (5 * i + 1)::INTEGER, 5))::INTEGER >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""
