"""WARC archives: written with one compressed member per record, read back with salvage.

The text sink of Spark is the only one that writes a column's bytes as they are. It ends each row
with a separator, here NUL. The last byte of a gzip member is the high byte of its length, which
is NUL for records under 16 MB, so a row holds a member without that byte; a longer record
is followed by an empty member. The files are plain ``.warc.gz`` content.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import broadcast_if_small

#: Records of one archive at most.
RECORDS_PER_FILE = 20_000
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MAGIC = b"\x1f\x8b\x08"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    record_id: str, date: str, payload: bytes, digest: str, uri: str | None = None, refers_to: str | None = None
) -> bytes:
    """One response, or one revisit if ``refers_to`` is given, as it stands in an uncompressed archive."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>"]
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {quote(uri, safe=_URI_SAFE)}")
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI_SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def member(data: bytes) -> bytes:
    """``data`` as gzip members whose last byte is NUL."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    if packed[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed += packer.flush()
    return packed


def urn(kind: str, value: int | None) -> str:
    return f"urn:{kind}:{'' if value is None else value}"


def plan_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of the rows of ``pages`` (page_id, payload) that repeat another's payload.

    Among equal payloads of at least ``least`` bytes the smallest page_id is the one referred to.
    """
    narrow = pages.filter(F.octet_length("payload") >= least).select("page_id", F.sha1("payload").alias("sha1"))
    first = narrow.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("most"))
    repeated = first.filter(F.col("refers_to") < F.col("most")).drop("most")
    return narrow.join(repeated, "sha1").filter(F.col("page_id") > F.col("refers_to")).select("page_id", "sha1", "refers_to")


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    least: int = 0,
) -> None:
    """Write one record per row into archives under ``path``, which must not exist.

    The payload is the text in UTF-8 (null: empty). Rows without id are responses of their own; rows
    that repeat an id are records of their own, each judged by its payload. A null url leaves its header out. Other columns are
    not read. Payloads move between tasks only if there are more revisits than can be sent to all.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), text.alias("payload")
    )
    revisits = broadcast_if_small(plan_revisits(rows, least).distinct())
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to")]
            packed = [
                member(
                    record(
                        urn("page", page_id),
                        date,
                        payload,
                        base32_sha1(payload),
                        url,
                        None if refers_to is None else urn("page", refers_to),
                    )
                )[:-1]
                for page_id, url, payload, refers_to in zip(*columns)
            ]
            yield pa.record_batch([pa.array(packed, pa.binary())], names=["member"])

    rows = rows.withColumn("sha1", F.sha1("payload"))
    members = rows.join(revisits, ["page_id", "sha1"], "left").mapInArrow(build, "member binary")
    (
        members.select(F.col("member").cast("string"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


class Salvage:
    """Reads the records of one archive, and goes on after damage.

    ``gaps`` lists (start, end, reason) of the bytes that gave no record.
    """

    def __init__(self, data: bytes):
        self.data = data
        self.gaps: list[tuple[int, int, str]] = []

    def records(self) -> Iterator[tuple[int, dict, bytes]]:
        """(offset, header fields in lower case, block); the offset is that of the member or record."""
        at, size, bad = 0, len(self.data), None
        while at < size:
            found, end, reason = self._unit(at)
            if found is None and reason == "":  # padding between records
                at = end
                continue
            if bad is not None and not reason:
                self.gaps.append((bad[0], at, bad[1]))
                bad = None
            yield from found or ()
            if reason:
                bad = bad or (at, reason)
                end = self._next(at + 1)
            at = end
        if bad is not None:
            self.gaps.append((bad[0], size, bad[1]))

    def _next(self, start: int) -> int:
        """The next place that looks like the start of a member or record."""
        line = _VERSION.search(self.data, start)
        packed = self.data.find(_MAGIC, start, line.start() + 2 if line else len(self.data))
        return packed if packed >= 0 else line.start() if line else len(self.data)

    def _unit(self, at: int):
        """Records of the unit at a place, its end, and what is wrong with it (None: nothing)."""
        if self.data.startswith(_MAGIC, at):
            return self._member(at)
        if _VERSION.match(self.data, at):
            found, end, reason = parse_record(self.data, at)
            return ([(at, *found)] if found else []), end, reason
        if self.data[at] in b"\r\n\0":
            end = at + 1
            while end < len(self.data) and self.data[end] in b"\r\n\0":
                end += 1
            return None, end, ""
        return [], at, "no record begins here"

    def _member(self, at: int):
        unpacker, out, position, reason = zlib.decompressobj(31), [], at, None
        try:
            while not unpacker.eof and position < len(self.data):
                piece = self.data[position : position + (1 << 16)]
                out.append(unpacker.decompress(piece))
                position += len(piece)
            if not unpacker.eof:
                reason = "member cut short"
        except zlib.error as error:
            reason = f"bad member: {error}"
        end = position - len(unpacker.unused_data)
        inner = b"".join(out)
        # A member may hold several records; those whole before the damage count.
        found, inside = [], 0
        while inside < len(inner):
            one, following, wrong = parse_record(inner, inside)
            if wrong:
                line = _VERSION.search(inner, inside + 1)
                reason = reason or wrong
                if not line:
                    break
                following = line.start()
            else:
                found.append((at, *one))
            inside = following
        return found, end, reason


def _agrees(digest: str | None, content: bytes) -> bool:
    """Whether a content has a digest; true of digests that are missing or of another kind."""
    return not digest or not digest.startswith("sha1:") or digest[5:] == base32_sha1(content)


def parse_record(data: bytes, at: int):
    """((fields, block), end, None) of the record at a place, or (None, place, what is wrong)."""
    if not _VERSION.match(data, at):
        return None, at, "no version line"
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        return None, at, "header not ended"
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "bad header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        return None, at, "no content length"
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return None, at, "block not ended where its length says"
    block = data[start:end]
    if not _agrees(fields.get("warc-block-digest"), block):
        return None, at, "block digest differs"
    if fields.get("warc-type") == "response" and not _agrees(fields.get("warc-payload-digest"), payload_of(block)):
        return None, at, "payload digest differs"
    return (fields, block), end + 4, None


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header of a block."""
    return block[block.find(b"\r\n\r\n") + 4 :] if block.startswith(b"HTTP/") else block


def _payload_length(block: bytes) -> int | None:
    """As the HTTP header states it, which a revisit has without the payload itself."""
    head = block[: block.find(b"\r\n\r\n") + 2] if block.startswith(b"HTTP/") else b""
    found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r$", head)
    return int(found[1]) if found else None


ROWS = (
    "archive string, start long, stop long, record_type string, record_id string, refers_to string, url string,"
    " date string, payload_digest string, payload_bytes long, payload binary, problem string"
)
_NAMES = [part.split()[0] for part in ROWS.split(",")]


def _rows_of(name: str, data: bytes, with_payload: bool) -> Iterator[tuple]:
    salvage = Salvage(data)
    for at, fields, block in salvage.records():
        payload = payload_of(block) if fields.get("warc-type") != "revisit" else None
        length = _payload_length(block) if payload is None else len(payload)
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        bare = lambda key: fields[key].strip("<>") if key in fields else None
        yield (
            *(name, at, None, fields.get("warc-type"), bare("warc-record-id"), bare("warc-refers-to")),
            *(fields.get("warc-target-uri"), fields.get("warc-date"), digest, length),
            *(payload if with_payload else None, None),
        )
    for start, stop, reason in salvage.gaps:
        yield (name, start, stop, *[None] * 8, reason)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of every archive under ``path``, plain or gzip: its records, and its gaps (ROWS).

    After a failed check (a member that does not unpack, a version line, header, length, end,
    or digest of block or payload that is wrong) reading goes on at the next member or version line that gives a
    record. The bytes between are one gap: ``problem`` says what failed, ``start`` and ``stop``
    where; records have no problem. An empty file gives no rows. One file is read by one
    task, so an archive has to fit in its memory.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (n, pa.int64() if n in ("start", "stop", "payload_bytes") else pa.binary() if n == "payload" else pa.string())
                for n in _NAMES
            ]
        )
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"]):
                rows, size = [], 0
                for row in _rows_of(name, content.as_py(), with_payload):
                    rows.append(row)
                    size += len(row[-2] or b"")
                    if len(rows) >= 2000 or size > 16 << 20:
                        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, ROWS)
