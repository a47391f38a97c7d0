"""WARC archives: a writer of one gzip member per record, and a sequential reader that checks digests."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import pieces, small, written

#: Payloads below this many bytes are stored whole wherever they stand.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task begins a new archive; bytes that the reader takes at once.
ARCHIVE_BYTES, READ_BYTES = 64 << 20, 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(value: str | None, page: str) -> str:
    """The url in one line of ASCII; a page without one has its number as name."""
    if not value:
        return f"urn:page:{page}"
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], value.encode("utf-8", "surrogatepass")).decode("ascii")


def record(page: str, url: str | None, payload: bytes, refers: str | None, date: str = DATE) -> bytes:
    """One gzip member. A revisit keeps the HTTP head, which tells the payload's length, and not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode("ascii")
    block = http if refers is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url, page)}", f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, path: str, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """Writes the rows of ``pages`` as archives under ``path``; (archive, records, bytes) of each.

    Of rows with equal payloads of at least REVISIT_BYTES, those with the largest key are responses and the
    others revisit it; a null key is less than any other. Payloads are compared by SHA-256 and length. Null
    html is an empty payload. A task writes under a name of its attempt and renames when done, so one that
    runs again leaves the same archives. ``path`` must be one that pyarrow.fs opens. An empty table gives none.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("string").alias("_key"), F.col(key).alias("_id"), F.col(url).alias("_url"), body.alias("_html"))
    rows = rows.withColumn("_digest", F.when(F.octet_length("_html") >= REVISIT_BYTES, F.sha2("_html", 256)))
    groups = rows.filter("_digest is not null").groupBy("_digest", F.octet_length("_html").alias("_bytes")).agg(
        F.max("_id").alias("_first"), F.count("*").alias("n")
    )
    groups = written(groups.filter("n > 1 and _first is not null").select("_digest", "_first"), "warc-groups")
    rows = rows.join(small(groups), "_digest", "left").select(
        "_key", "_url", "_html", F.when(~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first").cast("string")).alias("_refers")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        made, out = 0, None

        def begin():
            store.create_dir(f"{folder}/_work", recursive=True)
            work = f"{folder}/_work/{task.partitionId():06d}-{made:04d}-{task.taskAttemptId()}"
            return work, store.open_output_stream(work, compression=None), [0, 0]

        def end() -> pa.RecordBatch:
            work, stream, (n, size) = out
            stream.close()
            name = f"{folder}/{task.partitionId():06d}-{made:04d}.warc.gz"
            if store.get_file_info(name).type != fs.FileType.NotFound:
                store.delete_file(name)
            store.move(work, name)
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [n], "bytes": [size]})

        for batch in pieces(batches, "_html"):
            for page, link, value, refers in zip(*(batch.column(c).to_pylist() for c in ("_key", "_url", "_html", "_refers"))):
                out = out or begin()
                member = record(page or "none", link, value.encode("utf-8", "surrogatepass"), refers)
                out[1].write(member)
                out[2][0] += 1
                out[2][1] += len(member)
                if out[2][1] >= ARCHIVE_BYTES:
                    yield end()
                    made, out = made + 1, None
        if out:
            yield end()

    return written(rows.mapInArrow(write, "archive string, records long, bytes long"), "warc-archives")


def members(stream, size: int = READ_BYTES) -> Iterator[tuple[int, bytes, str | None]]:
    """(offset, content, error) of each gzip member, read in order in pieces of ``size`` bytes.

    After a broken member nothing more is read, since the next one's place is not known.
    """
    offset = read = 0
    rest = b""
    while True:
        unpack, found = zlib.decompressobj(31), []
        while not unpack.eof:
            data = rest or stream.read(size)
            read += 0 if rest else len(data)
            rest = b""
            if not data:
                if found or read > offset:
                    yield offset, b"".join(found), "the archive ends inside a member"
                return
            try:
                found.append(unpack.decompress(data))
            except zlib.error as broken:
                yield offset, b"".join(found), str(broken)
                return
        rest = unpack.unused_data
        yield offset, b"".join(found), None
        offset = read - len(rest)


def parsed(content: bytes, error: str | None) -> dict:
    """Fields of one record; ``error`` tells what is wrong with its frame or digests, or is null."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = fields.get("content-length", "")
    size = int(length) if length.isascii() and length.isdecimal() else -1
    block, tail = rest[: max(size, 0)], rest[max(size, 0):]
    if not error and (not lines[0].startswith("WARC/") or not gap or size < 0 or len(block) < size):
        error = "the record's frame is broken"
    if not error and tail != b"\r\n\r\n":
        error = "the record is not as long as it says"
    kind = fields.get("warc-type")
    payload, told = block, size
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        if found := re.search(rb"(?im)^content-length:\s*(\d+)", http):
            told = int(found[1])
    digest = fields.get("warc-payload-digest")
    for name, data in (("block", block), ("payload", payload if kind != "revisit" else None)):
        said = fields.get(f"warc-{name}-digest")
        if not error and data is not None and said and said.startswith("sha1:") and said != _sha1(data):
            error = f"the {name} digest does not fit"
    if not error and kind == "response" and told != len(payload):
        error = "the payload is not as long as it says"
    plain = None
    if digest and digest.startswith("sha1:"):
        try:
            plain = base64.b32decode(digest[5:]).hex()
        except ValueError:
            error = error or "the payload digest cannot be read"
    return {
        "record_type": kind, "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"),
        "payload_bytes": told, "payload_digest": plain, "refers_to": fields.get("warc-refers-to"),
        "payload": payload if kind != "revisit" else None, "error": error,
    }


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row for each record of the ``*.warc.gz`` files under ``path``.

    Columns: archive, offset, record_type, record_id, url, payload_bytes, payload_digest (hex SHA-1),
    refers_to, error, and payload if asked for. Archives are dealt to tasks whole and read in order; a task
    holds one record. Damage shows as an ``error``, never as a lost task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path")
    names = ["record_type", "record_id", "url", "payload_bytes", "payload_digest", "refers_to", "error", *["payload"] * payload]
    schema = pa.schema([
        ("archive", pa.string()), ("offset", pa.int64()),
        *[(n, {"payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in names],
    ])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                store, inner = fs.FileSystem.from_uri(name.replace("file:///", "/", 1).replace("file:/", "/", 1))
                held, size = [], 0
                with store.open_input_stream(inner, compression=None) as stream:
                    for offset, content, error in members(stream):
                        row = parsed(content, error)
                        held.append({"archive": name, "offset": offset} | {n: row[n] for n in names})
                        size += len(content) if payload else 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {"offset": "long", "payload_bytes": "long", "payload": "binary"}
    return files.mapInArrow(read, ", ".join(f"{f.name} {kinds.get(f.name, 'string')}" for f in schema))
