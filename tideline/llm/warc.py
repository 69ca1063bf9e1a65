"""WARC archives: writing pages as records and reading archives back, record by record.

Every record is a gzip member of its own. The reader is sequential: it decompresses each member as the
bytes arrive, takes the block's length from Content-Length, and compares block and payload with their
digests; it holds one record at a time. Of pages with equal payloads of at least `least` bytes, the one
with the smallest id is stored as a response; the others are revisit records that refer to it and hold
its HTTP header only, whose Content-Length tells the full payload's length.

Archives of others are read too: digests may be sha1, sha256 or md5, in hexadecimal or base32, or missing
(those of other algorithms aren't compared); only blocks of type application/http have an HTTP header, whose
length may be missing or chunked; records of other types (warcinfo, resource, metadata ...) come back with
their block as payload. with_payloads() gives revisits the payload that they refer to.

Archives go to the shared folder, through pyarrow's file systems, under names that hold the task attempt's
number: an attempt never touches another one's archives, and the result names those of the attempts that
counted. What a failed attempt leaves behind is in no result.

Edge cases: a null payload is empty; a null id gives a record id without a number, is always a response
and reads back as null; a null url gives no WARC-Target-URI and reads back as null; smaller
payloads are all responses; repeated rows of one id are all responses or all revisits; a damaged or cut
archive raises ValueError; a space or control in a URL is written as its escape and stays so, all else of it
is kept verbatim; a very long payload is one record, held whole by the task that writes or reads it; an empty table writes no archives; further columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.tables import checkpointed, made, shared_dir, stored, table

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 64_000_000
READ_BYTES = 256 * 1024
_RECORD_ID = "<urn:page:{}>"
#: What a header's line can't hold as it is; all else of a URL is written and read verbatim.
_ILLEGAL = re.compile(r"[\x00-\x20\x7f]")
#: A record's header is at most so long.
HEADER_BYTES = 1_000_000
#: Duplicates whose keys may be broadcast at most; more are joined.
BROADCAST_ROWS = 500_000
_ALGORITHMS = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}
RECORDS = "record_id string, refers_to_record string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def file_system(uri: str):
    """(pyarrow file system, path) of a folder's or file's URI."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri) if ":/" in uri else f"file://{os.path.abspath(uri)}")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """A whole record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_RECORD_ID.format('' if page_id is None else page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _ILLEGAL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_RECORD_ID.format(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def digest_of(text: str) -> tuple[str, bytes] | None:
    """(algorithm, digest) of a header's value such as sha1:BASE32 or sha256:hexadecimal; None if it can't be compared."""
    name, _, value = text.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in _ALGORITHMS:
        return None
    value, size = value.strip(), _ALGORITHMS[name]().digest_size
    try:
        got = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return None
    return (name, got) if len(got) == size else None


def _differs(text: str | None, *data: bytes) -> bool:
    """Whether a digest can be compared and is that of none of the data."""
    return bool(text and (found := digest_of(text)) and all(_ALGORITHMS[found[0]](x).digest() != found[1] for x in data))


def _fields(lines: list[str]) -> dict[str, str]:
    """Values by lower-case names. A line that begins with white space goes on with the one before."""
    whole: list[str] = []
    for line in lines:
        if line[:1] in (" ", "\t") and whole:
            whole[-1] += " " + line.strip(" \t")
        else:
            whole.append(line)
    return {k.strip(" \t").lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in whole)}


def unchunked(body: bytes) -> bytes:
    """A body of chunks put together; one that isn't made of chunks, as where they have been removed already, stays."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            return body
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + n])
        if len(parts[-1]) < n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            return body
        at = end + 4 + n
    return body


class ArchiveReader:
    """Iterates over the records of an archive: (WARC headers with lower-case names, HTTP headers, payload)."""

    def __init__(self, stream: BinaryIO, chunk: int = READ_BYTES):
        self.stream, self.chunk = stream, chunk
        self.packed, self.plain = b"", b""
        self.member, self.held_back = zlib.decompressobj(31), False

    def _more(self) -> bool:
        """Decompresses some more of the current member; False at its end."""
        while not self.member.eof:
            if not self.packed and not self.held_back:
                self.packed = self.stream.read(self.chunk)
                if not self.packed:
                    raise ValueError("the archive ends within a record")
            try:
                got = self.member.decompress(self.packed, self.chunk)
            except zlib.error as error:
                raise ValueError(f"damaged gzip member: {error}") from error
            self.held_back = len(got) == self.chunk  # the member may have more to give without more input
            self.packed = self.member.unconsumed_tail or self.member.unused_data
            if got:
                self.plain += got
                return True
        return False

    def _headers(self) -> tuple[str, dict[str, str]]:
        looked = 0
        while (end := self.plain.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(self.plain) - 3)
            if looked > HEADER_BYTES or not self._more():
                raise ValueError("a record without the end of its header")
        head, self.plain = self.plain[:end].decode("utf-8", "replace"), self.plain[end + 4 :]
        first, *lines = head.split("\r\n")
        return first, _fields(lines)

    def _block(self, size: int) -> bytes:
        parts, left = [], size
        while left:
            if not self.plain and not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            part, self.plain = self.plain[:left], self.plain[left:]
            parts.append(part)
            left -= len(part)
        return b"".join(parts)

    def __iter__(self) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
        while True:
            if not self.packed:
                self.packed = self.stream.read(self.chunk)
                if not self.packed:
                    return
            self.member, self.held_back, self.plain = zlib.decompressobj(31), False, b""
            version, headers = self._headers()
            if not version.startswith("WARC/") or not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
                raise ValueError("not a WARC record")
            block = self._block(int(headers["content-length"]))
            while self._more():
                pass
            if self.plain != b"\r\n\r\n":
                raise ValueError("a record is longer or shorter than its Content-Length")
            if _differs(headers.get("warc-block-digest"), block):
                raise ValueError("a block differs from its digest")
            http, payload = {}, block
            if headers.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
                head, _, body = block.partition(b"\r\n\r\n")
                http = _fields(head.decode("latin-1").split("\r\n")[1:])
                payload = unchunked(body) if "chunked" in http.get("transfer-encoding", "").lower() else body
                if headers["warc-type"] == "response" and _differs(headers.get("warc-payload-digest"), body, payload):
                    raise ValueError("a payload differs from its digest")
            yield headers, http, payload


def with_revisits(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, size, refers_to): refers_to is null for responses."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("size") >= least).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id")).where("first_id < last_id").drop("last_id")
    later = stored(large.join(firsts, "digest").where("page_id > first_id").select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct(), "revisits")
    # payloads are shuffled only where the revisits are too many to broadcast
    return rows.join(F.broadcast(later) if later.count() <= BROADCAST_ROWS else later, ["page_id", "digest"], "left")


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes rows of with_revisits() as archives in the folder; returns (path, records), computed once."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base)
        context = TaskContext.get()
        paths: list[str] = []
        counts: list[int] = []
        out, size = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    paths.append(f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(paths):04d}.warc.gz")
                    counts.append(0)
                    out, size = fs.open_output_stream(paths[-1], compression=None), 0
                member = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["size"], row["refers_to"])
                out.write(member)
                size += len(member)
                counts[-1] += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return checkpointed(rows.select("page_id", "url", "payload", "digest", "size", "refers_to").mapInArrow(write, "path string, records long"))


def _row(headers: dict[str, str], http: dict[str, str], payload: bytes, payloads: bool) -> tuple:
    def as_id(record_id: str | None) -> int | None:
        number = (record_id or "").removeprefix(_RECORD_ID.split("{")[0]).removesuffix(">")
        return int(number) if re.fullmatch("-?[0-9]{1,19}", number) else None

    record_id, refers, uri = headers.get("warc-record-id"), headers.get("warc-refers-to"), headers.get("warc-target-uri")
    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    if headers["warc-type"] == "revisit":  # it tells of a payload that it doesn't hold
        told, length = digest_of(headers.get("warc-payload-digest", "")), http.get("content-length", "")
        size, digest = int(length) if length.isdigit() else None, told[1].hex() if told else None
    return record_id, refers, as_id(record_id), uri, headers["warc-type"], size, digest, as_id(refers), payload if payloads else None


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives named in column path, as RECORDS; without payloads, that column is null.

    page_id and refers_to are numbers in record ids of this module; payload_digest is the payload's SHA-256, or what a revisit tells.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        strings = [(x, pa.string()) for x in ("record_id", "refers_to_record")]
        schema = pa.schema([*strings, ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        as_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for headers, http, payload in ArchiveReader(stream):
                        rows.append(_row(headers, http, payload, payloads))
                        held += len(payload)
                        if len(rows) >= 2000 or held >= 16_000_000:
                            yield as_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return archives.select("path").repartition(_tasks(archives.sparkSession), "path").mapInArrow(read, RECORDS)


def with_payloads(records: DataFrame) -> DataFrame:
    """The records; a revisit has the payload of the response that it refers to, null where no archive read has that."""
    held = records.where("record_type = 'response'").select(F.col("record_id").alias("held_id"), F.col("payload").alias("held"))
    again = records.where("record_type = 'revisit'").join(held, F.col("refers_to_record") == F.col("held_id"), "left")
    return records.where("record_type <> 'revisit'").unionByName(again.withColumn("payload", F.col("held")).drop("held_id", "held"))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = made(f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    archives = write_archives(with_revisits(table(spark, sf_dir, "pages")), folder)
    return read_archives(archives, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
f AS (SELECT s, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY s)
SELECT page_id, n::BIGINT AS payload_bytes, d.s AS payload_digest, CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.s = f.s AND d.n >= 100
"""
