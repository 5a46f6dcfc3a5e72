"""WARC archives: a deduplicating writer and a splittable reader.

Writer. Every page becomes one record in a gzip member of its own, as the
format asks. Of the pages with equal payloads, the one with the smallest id is
written as ``response``, the others as ``revisit`` records, which name it and
carry no payload. Tasks pack members into files of bounded size, which Spark's
own committer writes: a retried task leaves nothing behind. A file ends with an
empty gzip member, which marks its end.

Reader. The listing is cut into byte ranges, dealt to tasks. A task scans its
range for the magic bytes of a gzip member, takes a place for the start of a
record only if the bytes there decode and begin with a WARC header, and owns
the records that start inside its range, reading on beyond the end for the last
one. Ranges therefore need no index and no agreement between tasks: every
member belongs to the range its first byte lies in. Bytes that are no record
(a magic inside compressed data, damage) are skipped: the scan goes on one byte
later, and the records after them are found again. After a record the next
member is expected at once, so records within a range are not searched for. Only
if a range begins inside a record whose payload is itself an archive that was
stored without compression could inner records be taken for outer ones; text
payloads cannot hold the magic (it is not UTF-8).

Defined results: a null payload counts as empty; a null url gives a record
without target; a null id is larger than any other and stays null; rows that
repeat both id and payload of a response are responses, too; an empty table
gives no records and an empty folder reads as none. Payloads are handled whole.
Columns other than id, url and payload are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.enrich import left_enrich

from .common import ARROW_ROWS, materialize, small_batches

MAGIC = b"\x1f\x8b\x08"
# A gzip member that holds nothing; it ends every file.
END_MEMBER = MAGIC + bytes([0, 0, 0, 0, 0, 0, 255, 3, 0]) + bytes(8)
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 32 * 1024 * 1024
RANGE_BYTES = 32 * 1024 * 1024
READ_BYTES = 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024
# First payloads up to this many are sent to every task; beyond, the join is
# shuffled and hot payloads are spread.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 64
HOT_SHARE = 0.001

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-capture")


# -------------------------------------------------------------------- writing

def payload_digest(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1 of a payload."""
    return base64.b32encode(sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def _target(url: str) -> str:
    """A url that fits a header line: control characters are escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def _member(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_record_id(first, digest)}", f"Refers-To-Page-ID: {first}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + press.flush()


def with_first(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload binary) with ``first_id``, the smallest
    page_id of an equal payload. Only payloads that occur more than once are
    joined with; where these are many, the join spreads those that hold many rows."""
    spark = pages.sparkSession
    keyed = pages.withColumn("digest", F.unhex(F.sha1("payload")))
    # At most one row per payload and task is shuffled; nulls are larger than any id.
    firsts = materialize(
        keyed.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
        "warc-firsts")
    rows = firsts.agg(F.sum("n")).first()[0] or 0
    hot = firsts.filter(F.col("n") > F.lit(HOT_SHARE * rows)).select("digest")
    known = left_enrich(keyed, firsts.drop("n"), "digest", broadcast_max_rows=BROADCAST_ROWS,
                        broadcast_max_bytes=BROADCAST_BYTES, salt_buckets=SALTS, hot_keys=hot)
    return known.select("page_id", "url", "payload", F.coalesce("first_id", "page_id").alias("first_id"))


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id long, url string, payload binary) to the new
    folder ``path``, in files of about ``file_bytes`` (a larger record gets a
    file that long). ``date`` is the capture time of all records."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, held = [], 0
        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                members.append(_member(page_id, url, payload, first, first != page_id, date))
                held += len(members[-1])
                if held >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["value"])
                    members, held = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["value"])

    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    files = with_first(rows).mapInArrow(pack, "value binary")
    # One row is one file; the text sink writes its bytes as they are and ends it with the line separator.
    files.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1) \
        .option("encoding", "ISO-8859-1").option("lineSep", END_MEMBER.decode("latin-1")).text(path)


# -------------------------------------------------------------------- reading

class _Bytes:
    """Random access to a file through one remembered stretch."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.at, self.held = handle, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on; fewer at the end of the file."""
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.held):
            self.handle.seek(at)
            self.at, self.held = at, self.handle.read(max(n, min(READ_BYTES, self.size - at)))
        return self.held[at - self.at:at - self.at + n]

    def find_magic(self, at: int, end: int) -> int:
        """The first place of the magic in [at, end), or -1."""
        while at < end:
            block = self.read(at, min(READ_BYTES, end - at + len(MAGIC) - 1))
            found = block.find(MAGIC)
            if found >= 0:
                return at + found
            if at + len(block) >= self.size or len(block) < len(MAGIC):
                return -1
            at += len(block) - len(MAGIC) + 1
        return -1


def _inflate(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at ``at`` and its end, None if there is
    none. A member that does not begin like a record is given up early."""
    inflater, out, size, checked, step = zlib.decompressobj(31), [], 0, False, 4096
    place = at
    while not inflater.eof:
        block = source.read(place, step)
        if not block:
            return None
        try:
            out.append(inflater.decompress(block))
        except zlib.error:
            return None
        place, size, step = place + len(block), size + len(out[-1]), min(step * 4, READ_BYTES)
        if not checked and size >= 5:
            if not b"".join(out).startswith(b"WARC/"):
                return None
            checked = True
    return b"".join(out), place - len(inflater.unused_data)


def _headers(block: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name, and where the content begins."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in block[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields, end + 4


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdecimal() else None


RECORD = ("path string, offset long, record_type string, record_id string, date string, target_uri string, page_id long, "
          "refers_to string, refers_to_page_id long, declared_digest string, payload_digest string, payload_bytes long, "
          "payload binary")
_FIELDS = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
                     ("date", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.string()),
                     ("refers_to_page_id", pa.int64()), ("declared_digest", pa.string()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _record(content: bytes) -> dict | None:
    """A record's columns, None if the content is no whole WARC record."""
    parsed = _headers(content)
    if not content.startswith(b"WARC/") or parsed is None:
        return None
    fields, at = parsed
    length = _number(fields.get("content-length"))
    if length is None or length < 0 or len(content) < at + length:
        return None
    block, kind = content[at:at + length], fields.get("warc-type")
    digest = fields.get("warc-payload-digest")
    row = {"record_type": kind, "record_id": fields.get("warc-record-id"), "date": fields.get("warc-date"),
           "target_uri": fields.get("warc-target-uri"), "page_id": _number(fields.get("page-id")),
           "refers_to": fields.get("warc-refers-to"), "refers_to_page_id": _number(fields.get("refers-to-page-id")),
           "declared_digest": digest[5:] if digest and digest.startswith("sha1:") else digest,
           "payload_digest": None, "payload_bytes": None, "payload": None}
    http = _headers(block) if fields.get("content-type", "").startswith("application/http") else None
    if kind == "revisit":  # the payload is the response's; its size and digest stand here
        row["payload_digest"] = row["declared_digest"]
        row["payload_bytes"] = _number(http[0].get("content-length")) if http else None
    else:
        row["payload"] = block[http[1]:] if http else block
        row["payload_bytes"], row["payload_digest"] = len(row["payload"]), payload_digest(row["payload"])
    return row


def _scan(source: _Bytes, path: str, begin: int, end: int) -> Iterator[dict]:
    """The records that start in [begin, end)."""
    at = begin
    while True:
        at = source.find_magic(at, end)
        if at < 0:
            return
        found = _inflate(source, at)
        row = _record(found[0]) if found else None
        if row is not None:
            yield {"path": path, "offset": at, **row}
        # No record: an empty member is stepped over, anything else byte by byte.
        at = found[1] if found and (row is not None or not found[0]) else at + 1


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row["payload_bytes"] or 0
        if len(held) >= ARROW_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_FIELDS)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_FIELDS)


def _reachable(path: str) -> bool:
    """Whether pyarrow opens files of this store (tasks then read ranges)."""
    try:
        fs.FileSystem.from_uri(_uri(path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _uri(path: str) -> str:
    """Spark writes file:/a, where a URI for pyarrow is file:///a; s3a is s3 there."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, whole_files: bool | None = None) -> DataFrame:
    """The records of all gzip-compressed WARC files in the folder ``path``, one
    row each, in any order (columns: ``RECORD``). Files may be of any size, as
    they are read in ranges of ``range_bytes``. Files in a store that pyarrow
    cannot open (``whole_files``, found out if None) are read whole by Spark
    instead, one per row, which bounds them to 2 GB."""
    small_batches(spark)
    listing = spark.read.format("binaryFile").load(path)
    sizes = listing.select("path", "length")  # the content is not read
    if whole_files is None:
        one = sizes.limit(1).collect()
        whole_files = bool(one) and not _reachable(one[0]["path"])
    if whole_files:
        def from_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    content = batch.column(1)[i].as_buffer()
                    source = _Bytes(pa.BufferReader(content), content.size)
                    yield from _batches(_scan(source, batch.column(0)[i].as_py(), 0, content.size))

        return listing.select("path", "content").mapInArrow(from_rows, RECORD)

    def from_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, begin in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = fs.FileSystem.from_uri(_uri(name))
                with store.open_input_file(inner) as handle:
                    yield from _batches(_scan(_Bytes(handle, size), name, begin, min(size, begin + range_bytes)))

    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = sizes.filter("length > 0").select("path", "length", begins.alias("begin"))
    # Ranges are dealt one by one, however many a file has.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(tasks, "path", "begin").mapInArrow(from_ranges, RECORD)
