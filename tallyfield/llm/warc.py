"""WARC archives: one gzip member per record, and a sequential reader.

Archives are rows (archive, content) of a table, so that they can be written and read by any
executor; ``content`` of files found by Spark's ``binaryFile`` source is read the same way.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import slices, stored, table

# An archive is closed when it has reached this many bytes.
ARCHIVE_BYTES = 4 << 20
PIECE = 1 << 16
LONGEST_HEAD = 1 << 20
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_32(data: bytes) -> str:
    """Base32 SHA-1 in upper case."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    """A header value without line breaks or other control characters."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit leaves its payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url or '')}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_32(block)}", f"Content-Length: {len(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _members(pieces: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """The decompressed pieces of every gzip member in turn; each must be used up before the next."""
    source, rest = iter(pieces), b""

    def unpacked() -> Iterator[bytes]:
        nonlocal rest
        opener = zlib.decompressobj(31)
        while not opener.eof:
            if not rest:
                rest = next(source, b"")
                if not rest:
                    raise ValueError("the archive ends inside a record")
            out = opener.decompress(rest, PIECE)
            rest = opener.unused_data if opener.eof else opener.unconsumed_tail
            if out:
                yield out

    while True:
        while not rest:
            rest = next(source, None)
            if rest is None:
                return
        yield unpacked()


def read_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, in order. Names of headers are in lower case.

    Raises ValueError for a broken member, a missing or wrong length, and a block or payload
    that does not match its digest.
    """
    for member in _members(pieces):
        try:
            data = bytearray()
            while (end := data.find(b"\r\n\r\n")) < 0:
                if len(data) > LONGEST_HEAD:
                    raise ValueError("a record's head does not end")
                data += next(member)
        except (zlib.error, StopIteration) as error:
            raise ValueError("a record cannot be read") from error
        version, *named = data[:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in named)}
        length = int(headers["content-length"])
        try:
            for piece in member:
                data += piece
        except zlib.error as error:
            raise ValueError("a record cannot be read") from error
        block, tail = bytes(data[end + 4 : end + 4 + length]), bytes(data[end + 4 + length :])
        if len(block) != length or tail != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        if (said := headers.get("warc-block-digest")) and said != f"sha1:{sha1_32(block)}":
            raise ValueError("a block does not match its digest")
        if headers.get("warc-type") == "response" and (said := headers.get("warc-payload-digest")):
            if said != f"sha1:{sha1_32(payload_of(block))}":
                raise ValueError("a payload does not match its digest")
        yield headers, block


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP head of a block."""
    return block.partition(b"\r\n\r\n")[2]


def _payload() -> Column:
    return F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, key and response_id of every row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of ``min_bytes`` or more, the largest page_id is the response;
    response_id holds it in all rows. Smaller payloads refer to nothing. Only ids and hashes
    are grouped and joined on the payload's key, so a payload that very many pages share moves
    no text.
    """
    payload = _payload()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.sha1("payload"))
    ids = rows.where(F.length("payload") >= min_bytes).select("page_id", "key")
    repeated = ids.groupBy("key").agg(F.count("*").alias("n"), F.max("page_id").alias("response_id")).where("n > 1").drop("n")
    referring = ids.distinct().join(repeated, "key").where("page_id < response_id or (page_id is null and response_id is not null)")
    named = referring.select(F.col("page_id").alias("_id"), F.col("key").alias("_key"), "response_id")
    return rows.join(named, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").drop("_id", "_key")


def archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, content): the pages as WARC archives of about ``ARCHIVE_BYTES`` each.

    Null html is an empty payload and a null url an empty target. Rows that share page_id and
    payload with the response are responses too; a null page_id counts as the smallest. An
    empty table gives no archive. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, parts, size = 0, [], 0
        part_id = TaskContext.get().partitionId()

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part_id:06}-{made:05}.warc.gz"]), pa.array([b"".join(parts)], pa.binary())], names=["archive", "content"]
            )

        for batch in slices(batches, 64):
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "key", "response_id")]
            for page_id, url, payload, key, response_id in zip(*columns, strict=True):
                digest = base64.b32encode(bytes.fromhex(key)).decode("ascii")
                parts.append(record(page_id, url, payload, digest, response_id, response_id is not None))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    made, parts, size = made + 1, [], 0
        if parts:
            yield closed()

    return with_references(pages, min_bytes).mapInArrow(run, "archive string, content binary")


_RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def records(content: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives (a ``content`` column of bytes), read in sequence and verified."""

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                view, out, size = memoryview(content.as_buffer()), [], 0
                for headers, block in read_records(bytes(view[i : i + PIECE]) for i in range(0, len(view), PIECE)):
                    payload = payload_of(block)
                    http = block.partition(b"\r\n\r\n")[0].lower()
                    revisit = headers["warc-type"] == "revisit"
                    length = int(http.rpartition(b"content-length:")[2].split(b"\r\n")[0]) if revisit else len(payload)
                    out.append((
                        number(headers.get("x-page-id")), headers.get("warc-target-uri"), headers["warc-type"],
                        headers["warc-payload-digest"].removeprefix("sha1:"), length, number(headers.get("x-refers-to-page-id")),
                        payload if with_payload and not revisit else None,
                    ))
                    size += len(payload) if with_payload else 100
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return content.select(F.col("content").cast("binary").alias("content")).mapInArrow(run, _RECORDS)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(archives(table(spark, sf_dir, "pages")))
    return records(kept, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
