"""Web archives: pages written as WARC records, and archives read back.

Writing. Each page becomes one record with an HTTP response in chunked transfer framing. Of pages
with equal payloads the first is a ``response`` and the others ``revisit`` it: the first page of
each payload is a grouped minimum, joined back to the pages. A record longer than
``segment_bytes`` is cut into a first segment and continuation records, as the format has it, so
that no record is large. Records are gathered to runs of a few megabytes, and Spark's text writer
makes files of a few runs each, gzip-compressed; the line separator is the CRLF that ends a record.

Reading. Files are parsed one by one, record after record. A record that is whole is decoded on
the spot. Segments are shuffled by the record they continue, sorted by segment number and decoded
as they come: transfer framing, length and digest are followed byte by byte, with no more than
one segment in memory. Revisits take their payload's length and digest from the response they
name, and are held against it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import release_memory, row_by_row, stage

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RUN_BYTES = 8_000_000
RUNS_PER_FILE = 4
BATCH_ROWS = 500
BATCH_BYTES = 8_000_000

# Names and formats of the WARC 1.1 standard and of HTTP.
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
HTTP_TYPE = "application/http;msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
#: An own field for the page's number; readers skip fields that they don't know.
PAGE_FIELD = "Page-Id"

RECORD_FIELDS = [
    ("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.string()), ("stated_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ("problem", pa.string()),
]
RECORDS = pa.schema(RECORD_FIELDS)
RECORDS_DDL = (
    "record_id string, page_id long, uri string, record_type string, refers_to string, "
    "stated_digest string, payload_bytes long, payload_digest string, payload binary, problem string"
)
PARSED = pa.schema([
    *RECORD_FIELDS, ("origin", pa.string()), ("segment", pa.int64()),
    ("total_length", pa.int64()), ("block", pa.binary()),
])
PARSED_DDL = RECORDS_DDL + ", origin string, segment long, total_length long, block binary"


def base32_digest(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# ---- writing -----------------------------------------------------------------------------------


def _record_id(row: str, segment: int = 1) -> str:
    name = row if segment == 1 else f"{row}#{segment}"
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the last of the two line ends that close it."""
    named = [
        *fields, ("WARC-Block-Digest", f"sha1:{base32_digest(hashlib.sha1(block).digest())}"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in named if value is not None)
    return b"".join([VERSION, CRLF, head.encode(), CRLF, block, CRLF])


def _chunked(payload: bytes, chunk_bytes: int) -> bytes:
    parts = [HTTP_HEAD]
    for k in range(0, len(payload), chunk_bytes):
        chunk = payload[k:k + chunk_bytes]
        parts += [b"%X\r\n" % len(chunk), chunk, CRLF]
    return b"".join([*parts, b"0\r\n\r\n"])


def _page_records(page: dict, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The record of a page; more than one if it is cut into segments."""
    uri = None if page["url"] is None else quote(page["url"], safe="%!#$&'()*+,/:;=?@[]~")
    common = [("WARC-Date", date), ("WARC-Target-URI", uri or None)]
    digest = f"sha1:{base32_digest(bytes.fromhex(page['sha1']))}"
    own = [
        ("WARC-Record-ID", _record_id(page["row"])), *common, ("Content-Type", HTTP_TYPE),
        ("WARC-Payload-Digest", digest), (PAGE_FIELD, page["page_id"]),
    ]
    if page["row"] != page["first_row"]:
        yield _record([
            ("WARC-Type", "revisit"), *own, ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(page["first_row"])),
        ], HTTP_HEAD)
        return
    block = _chunked(page["payload"], chunk_bytes)
    count = -(-len(block) // segment_bytes)
    if count == 1:
        yield _record([("WARC-Type", "response"), *own], block)
        return
    yield _record(
        [("WARC-Type", "response"), *own, ("WARC-Segment-Number", 1)], block[:segment_bytes]
    )
    for k in range(2, count + 1):
        yield _record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", _record_id(page["row"], k)), *common,
            ("WARC-Segment-Origin-ID", _record_id(page["row"])), ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", len(block) if k == count else None),
        ], block[(k - 1) * segment_bytes:k * segment_bytes])


def _writer(date: str, segment_bytes: int, chunk_bytes: int) -> Callable:
    """Runs of whole records; the text writer adds the last line end of a run."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for page in row_by_row(batches):
            for record in _page_records(page, date, segment_bytes, chunk_bytes):
                if size and size + len(record) > RUN_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([CRLF.join(parts)])], ["value"])
                    parts, size = [], 0
                parts.append(record)
                size += len(record)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([CRLF.join(parts)])], ["value"])

    return runs


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", row_col: str | None = None, segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES, date: str | None = None,
) -> str:
    """Write one record per page to gzip-compressed archives in a new folder; returns the folder.

    The payload is the html in UTF-8, a null is empty. Of equal payloads the row with the smallest
    page id (a null id comes last; ties: the smallest row name) is the response, all others
    revisit it, rows that repeat an id or a whole row among them. ``row_col`` names a column with
    a name for each row that is unique and the same in each reading; without it the pages are
    staged with names first. An empty table makes archives without records. Further columns are
    not looked at.
    """
    named = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
        (F.monotonically_increasing_id() if row_col is None else F.col(row_col)).cast("string").alias("row"),
    )
    if row_col is None:
        named = stage(named, "named-pages")
    named = named.withColumn("key", F.sha2("payload", 256))
    first = named.groupBy("key").agg(F.min(
        F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    )["row"].alias("first_row"))
    judged = named.join(first.hint("shuffle_hash"), "key").select(
        "page_id", "url", "row", "first_row", F.sha1("payload").alias("sha1"),
        F.when(F.col("row") == F.col("first_row"), F.col("payload")).alias("payload"),
    )
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    runs = judged.mapInArrow(_writer(date, segment_bytes, chunk_bytes), "value binary")
    runs.select(F.col("value").cast("string").alias("value")).write.mode("error").options(
        lineSep=CRLF.decode(), compression="gzip", maxRecordsPerFile=RUNS_PER_FILE
    ).text(path)
    return path


# ---- reading -----------------------------------------------------------------------------------


class HttpEntity:
    """An HTTP response read piece by piece: length, SHA-1 and, if asked for, bytes of its payload.

    Chunked transfer framing is taken off; without it the payload is all that follows the head. No
    more than one unfinished line or head is kept from one piece to the next.
    """

    def __init__(self, keep: bool):
        self.sha1, self.size = hashlib.sha1(), 0
        self.parts: list[bytes] | None = [] if keep else None
        self.rest, self.state, self.left = b"", "head", 0
        self.problem: str | None = None

    def take(self, data: bytes) -> None:
        self.sha1.update(data)
        self.size += len(data)
        if self.parts is not None:
            self.parts.append(data)

    def line(self, end: bytes) -> bytes | None:
        """What stands before ``end``, which is taken too; None if ``end`` hasn't come yet."""
        at = self.rest.find(end, self.at)
        if at < 0:
            return None
        found, self.at = self.rest[self.at:at], at + len(end)
        return found

    def feed(self, piece: bytes) -> None:
        self.rest, self.at = self.rest + piece if self.rest else piece, 0
        while self.state != "done" and self.at < len(self.rest) and self._step():
            pass
        self.rest = self.rest[self.at:] if self.state != "done" else b""

    def _step(self) -> bool:
        """Read one part of the response; False if it hasn't all come yet."""
        if self.state == "head":
            head = self.line(CRLF + CRLF)
            if head is None:
                return False
            fields = [line.partition(b":") for line in head.split(CRLF)[1:]]
            codings = [v.strip().lower() for k, _, v in fields if k.strip().lower() == b"transfer-encoding"]
            self.state = "size" if codings and codings[-1].endswith(b"chunked") else "plain"
        elif self.state == "plain":
            self.take(self.rest[self.at:])
            self.at = len(self.rest)
        elif self.state == "size":
            line = self.line(CRLF)
            if line is None:
                return False
            digits = line.partition(b";")[0].strip()
            if not digits or digits.strip(b"0123456789abcdefABCDEF"):
                return self._fail("no chunk size where one is due")
            self.left = int(digits, 16)
            self.state = "data" if self.left else "trailer"
        elif self.state == "data":
            data = self.rest[self.at:self.at + self.left]
            self.take(data)
            self.at += len(data)
            self.left -= len(data)
            if not self.left:
                self.state = "data end"
        elif self.state == "data end":
            if len(self.rest) - self.at < 2:
                return False
            if self.rest[self.at:self.at + 2] != CRLF:
                return self._fail("a chunk is longer than its size")
            self.at += 2
            self.state = "size"
        else:
            line = self.line(CRLF)
            if line is None:
                return False
            if not line:
                self.state = "done"
        return True

    def _fail(self, problem: str) -> bool:
        self.problem = self.problem or problem
        self.state = "done"
        return False

    def result(self, stated: str | None) -> dict:
        """Columns of the payload; ``problem`` says what is wrong with it."""
        problem = self.problem
        if problem is None and self.state not in ("done", "plain"):
            problem = "the response ends early"
        digest = base32_digest(self.sha1.digest())
        if problem is None and stated not in (None, digest):
            problem = "the payload differs from its digest"
        return {
            "payload_bytes": self.size, "payload_digest": digest, "problem": problem,
            "payload": None if self.parts is None else b"".join(self.parts),
        }


def _sha1_of(value: str | None) -> str | None:
    """The bare digest of a field like ``sha1:ABC``; None for other digests."""
    kind, _, digest = (value or "").partition(":")
    return digest.strip().upper() if kind.strip().lower() == "sha1" else None


def _number(value: str | None) -> int | None:
    return int(value) if value and value.strip().lstrip("-").isdecimal() else None


def archive_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(fields, block, problem) of each record of an archive, compressed or not.

    Names of fields are in lower case. After damage that hides where the next record begins, one
    last row with no fields says so.
    """
    source = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        source = io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 16)
    try:
        while True:
            line = source.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                yield {}, b"", "no record where one is due"
                return
            fields: dict[str, str] = {}
            while (line := source.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            size = _number(fields.get("content-length"))
            if size is None or size < 0:
                yield {}, b"", "a record without length"
                return
            block = source.read(size)
            problem = None if len(block) == size else "the archive ends within a record"
            stated = _sha1_of(fields.get("warc-block-digest"))
            if problem is None and stated not in (None, base32_digest(hashlib.sha1(block).digest())):
                problem = "the block differs from its digest"
            yield fields, block, problem
    except (EOFError, OSError, zlib.error):
        yield {}, b"", "the archive is damaged"


def _parsed(content: bytes, keep: bool) -> Iterator[dict]:
    """Rows of PARSED: whole records decoded, segments as they are; warcinfo and others left out."""
    for fields, block, problem in archive_records(content):
        kind = fields.get("warc-type")
        if fields and kind not in ("response", "revisit", "continuation"):
            continue
        segment = _number(fields.get("warc-segment-number"))
        row = dict.fromkeys(PARSED.names) | {
            "record_id": fields.get("warc-record-id"), "page_id": _number(fields.get(PAGE_FIELD.lower())),
            "uri": fields.get("warc-target-uri"), "record_type": kind, "problem": problem,
            "refers_to": fields.get("warc-refers-to"),
            "stated_digest": _sha1_of(fields.get("warc-payload-digest")),
        }
        if kind == "continuation" or (kind == "response" and segment is not None):
            row |= {
                "origin": row["record_id"] if kind == "response" else fields.get("warc-segment-origin-id"),
                "segment": segment, "block": block,
                "total_length": _number(fields.get("warc-segment-total-length")),
            }
            if row["origin"] is None or segment is None:
                row |= {"origin": None, "problem": problem or "a segment without origin or number"}
        elif kind == "response":
            entity = HttpEntity(keep)
            entity.feed(block)
            found = entity.result(row["stated_digest"])
            row |= found | {"problem": problem or found["problem"]}
        yield row


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    taken, size = [], 0
    for row in rows:
        taken.append(row)
        size += len(row.get("block") or b"") + len(row.get("payload") or b"")
        if len(taken) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(taken, schema)
            taken, size = [], 0
    if taken:
        yield pa.RecordBatch.from_pylist(taken, schema)


def _parser(keep: bool) -> Callable:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in row_by_row(batches):
            yield from _batches(_parsed(file["content"], keep), PARSED)

    return parse


class _Assembly:
    """Segments of one record, in order of their numbers."""

    def __init__(self, first: dict, keep: bool):
        self.row = {name: first[name] for name in RECORDS.names} | {"record_id": first["origin"]}
        self.entity, self.problem = HttpEntity(keep), None
        self.number, self.length, self.last_sha1 = 0, 0, b""
        self.total: int | None = None

    def add(self, row: dict) -> None:
        sha1 = hashlib.sha1(row["block"]).digest()
        if row["segment"] == self.number and sha1 == self.last_sha1:
            return  # the same segment once more
        if row["segment"] != self.number + 1:
            wrong = "is repeated with another block" if row["segment"] == self.number else "is missing"
            self.problem = self.problem or f"segment {max(self.number, 0) + (wrong == 'is missing')} {wrong}"
        elif self.total is not None:
            self.problem = self.problem or "a segment follows the last one"
        self.problem = self.problem or row["problem"]
        self.number, self.last_sha1 = row["segment"], sha1
        self.length += len(row["block"])
        self.total = row["total_length"] if row["total_length"] is not None else self.total
        self.entity.feed(row["block"])

    def result(self) -> dict:
        found = self.entity.result(self.row["stated_digest"])
        problem = self.problem
        if problem is None and self.total is None:
            problem = "the last segment is missing"
        if problem is None and self.total != self.length:
            problem = f"segments have {self.length} bytes instead of {self.total}"
        return self.row | found | {"problem": problem or found["problem"]}


def _assembler(keep: bool) -> Callable:
    """Rows sorted by origin and segment number to one row per record."""
    def records(rows: Iterator[dict]) -> Iterator[dict]:
        now = None
        for row in rows:
            if now is None or row["origin"] != now.row["record_id"]:
                if now is not None:
                    yield now.result()
                now = _Assembly(row, keep)
            now.add(row)
        if now is not None:
            yield now.result()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(records(row_by_row(batches)), RECORDS)
        release_memory()

    return assemble


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per response and revisit record of the archives in a folder.

    Columns: record_id, page_id, uri, record_type, refers_to (a record id), refers_to_page,
    payload_bytes, payload_digest (bare base32 SHA-1; for a revisit those of the response it names),
    payload (null for revisits and with ``payloads=False``), problem. ``problem`` is null for sound
    records; else it says what is wrong: damage, segments that are missing or have another total
    length than stated, bad transfer framing, a digest that differs, a revisit of an unknown
    record. A segment that comes twice with the same block counts once; segments without their
    first one make a row of type ``continuation``. A folder without records gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    parsed = stage(files.select("content").mapInArrow(_parser(payloads), PARSED_DDL), "archive-records")
    segments = parsed.where(F.col("origin").isNotNull()).repartition("origin").sortWithinPartitions(
        "origin", "segment"
    ).mapInArrow(_assembler(payloads), RECORDS_DDL)
    whole = parsed.where(F.col("origin").isNull()).select(*RECORDS.names).union(segments)
    records = stage(whole, "assembled-records")
    revisit = F.col("record_type").eqNullSafe("revisit")
    out = [
        "record_id", "page_id", "uri", "record_type", "refers_to", "refers_to_page",
        "payload_bytes", "payload_digest", "payload", "problem",
    ]
    targets = records.where(~revisit & F.col("record_id").isNotNull()).select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("refers_to_page"),
        F.col("payload_bytes").alias("known_bytes"), F.col("payload_digest").alias("known_digest"),
    ).dropDuplicates(["refers_to"])
    responses = records.where(~revisit).withColumn(
        "refers_to_page", F.lit(None).cast("bigint")
    ).select(*out)
    unlike = F.col("stated_digest").isNotNull() & (F.col("stated_digest") != F.col("known_digest"))
    revisits = records.where(revisit).join(targets, "refers_to", "left").withColumns({
        "payload_bytes": F.col("known_bytes"), "payload_digest": F.col("known_digest"),
        "problem": F.coalesce(
            "problem", F.when(F.col("known_digest").isNull(), F.lit("it revisits an unknown record")),
            F.when(unlike, F.lit("the payload it revisits differs from its digest")),
        ),
    }).select(*out)
    return responses.union(revisits)
