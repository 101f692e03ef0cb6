"""Web archives: round trips, damaged and foreign archives, revisits."""

import base64
import glob
import gzip
import hashlib
import random

import pytest

from tallyframe.llm import catalog
from tallyframe.llm.warc import HttpEntity, archive_records, read_archives, write_archives

from ..support import connect, mismatch

FOLDER = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, record_id string, `row` string, `key` string, origin string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d", "e") for row in rows], KIND).repartition(3)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sample():
    chance = random.Random(3)
    long = "".join(chance.choice("abcé \r\n0") for _ in range(60_000))
    return [
        (0, "http://a.example/", None), (1, None, ""), (2, "http://ü.example/ x\r\ny", "0\r\n\r\n"),
        (3, "http://b.example/", long), (4, "u", "same"), (5, "u", "same"), (9, "u", long),
        (6, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (None, "u", "same"), (5, "u", "same"),
        (None, "u", "only without id"), (7, "u", "x" * 4096), (8, "u", "y" * 8192 + "日本"),
    ]


def expected(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        old = first.get(body, (True, None))
        first[body] = min(old, (i is None, i), key=lambda x: (x[0], x[1] or 0))
    out = []
    taken = set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        lead = first[body][1]
        kind = "response" if body not in taken else "revisit"
        taken.add(body)
        out.append((i, len(body), digest(body), kind, None if kind == "response" else lead))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment_bytes, chunk_bytes", [(16_384, 4_096), (97, 10), (10**9, 10**9)])
def test_round_trip(spark, tmp_path, segment_bytes, chunk_bytes):
    path = write_archives(
        pages(spark, sample()), str(tmp_path / "w"), segment_bytes=segment_bytes, chunk_bytes=chunk_bytes
    )
    rows = read_archives(spark, path).collect()
    assert all(row["problem"] is None for row in rows)
    assert len({row["record_id"] for row in rows}) == len(rows)
    got = sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to_page"])
         for r in rows), key=str,
    )
    assert got == expected(sample())
    text = {i: (html or "").encode() for i, _, html in sample() if i is not None}
    for row in rows:
        if row["record_type"] == "response" and row["page_id"] is not None:
            assert row["payload"] == text[row["page_id"]]
        if row["record_type"] == "revisit":
            assert row["payload"] is None
            named = next(r for r in rows if r["record_id"] == row["refers_to"])
            assert named["record_type"] == "response" and named["payload_digest"] == row["payload_digest"]
    lean = read_archives(spark, path, payloads=False).collect()
    assert {r["payload"] for r in lean} == {None}
    assert sorted((str(r["page_id"]), r["payload_bytes"]) for r in lean) == sorted((str(r["page_id"]), r["payload_bytes"]) for r in rows)


def test_files_are_archives(spark, tmp_path):
    path = write_archives(pages(spark, sample()), str(tmp_path / "w"), segment_bytes=1000)
    kinds = []
    for name in glob.glob(f"{path}/part-*"):
        body = gzip.open(name).read()
        assert body.startswith(b"WARC/1.1\r\n") and body.endswith(b"\r\n\r\n") or not body
        for fields, block, problem in archive_records(body):
            assert problem is None and len(block) <= 1000
            kinds.append(fields["warc-type"])
            if fields["warc-type"] == "continuation":
                assert int(fields["warc-segment-number"]) > 1 and fields["warc-segment-origin-id"]
    assert kinds.count("continuation") > 60 and kinds.count("revisit") == 5


def test_empty_table(spark, tmp_path):
    path = write_archives(pages(spark, []), str(tmp_path / "w"))
    assert read_archives(spark, path).count() == 0


def record(kind, name, block, **fields):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{name}>", f"Content-Length: {len(block)}"]
    head += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return "\r\n".join(["WARC/1.0", *head, "", ""]).encode() + block + b"\r\n\r\n"


def segments(name, block, cuts, total=None, skip=(), **fields):
    edges = [0, *cuts, len(block)]
    out = []
    for k in range(1, len(edges)):
        part = block[edges[k - 1]:edges[k]]
        more = {"WARC_Segment_Number": k}
        if k == len(edges) - 1:
            more["WARC_Segment_Total_Length"] = len(block) if total is None else total
        if k == 1:
            out.append(record("response", name, part, **more, **fields))
        else:
            out.append(record("continuation", f"{name}-{k}", part, WARC_Segment_Origin_ID=f"<urn:{name}>", **more))
    return [r for k, r in enumerate(out, 1) if k not in skip]


def test_foreign_and_damaged_archives(spark, tmp_path):
    plain = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nbody"
    chunked = (
        b"HTTP/1.1 200 OK\r\ntransfer-encoding: gzip, Chunked\r\n\r\n"
        b"3;name=\"v\"\r\nabc\r\n0A\r\n0123456789\r\n0\r\nTrailer: t\r\n\r\n"
    )
    whole = b"abc0123456789"
    good = segments("good", chunked, [10, 70, 80], Page_Id=1)
    parts = [
        record("warcinfo", "info", b"software: x"), record("request", "q", b"GET /"),
        record("response", "plain", plain), *good, good[1], *segments("gap", chunked, [10, 70, 80], skip=(3,)),
        *segments("short", chunked, [50], total=7), *segments("open", chunked, [50], skip=(2,)),
        *segments("headless", chunked, [50], skip=(1,)),
        record("response", "bad", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n"),
        record("response", "early", chunked[:-9]),
        record("response", "digest", plain, WARC_Payload_Digest="sha1:" + digest(b"other")),
        record("response", "block", plain, WARC_Block_Digest="sha1:" + digest(b"other")),
        record("revisit", "again", b"", WARC_Refers_To="<urn:plain>", WARC_Payload_Digest="sha1:" + digest(b"body")),
        record("revisit", "lost", b"", WARC_Refers_To="<urn:nowhere>"),
        record("revisit", "unlike", b"", WARC_Refers_To="<urn:plain>", WARC_Payload_Digest="sha1:" + digest(b"x")),
        record("response", "md5", plain, WARC_Payload_Digest="md5:abc"),
    ]
    random.Random(1).shuffle(parts)
    half = len(parts) // 2
    (tmp_path / "part-0.warc").write_bytes(b"".join(parts[:half]))
    (tmp_path / "part-1.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[half:]))
    (tmp_path / "part-2.warc").write_bytes(record("response", "cut", plain)[:-12])
    (tmp_path / "part-3.warc.gz").write_bytes(gzip.compress(record("response", "torn", plain) * 50)[:-30])
    (tmp_path / "part-4.warc").write_bytes(b"not an archive")
    rows = read_archives(spark, str(tmp_path)).collect()
    found = {}
    for row in rows:
        found.setdefault((row["record_id"] or "<urn:>")[5:-1], row)
    problems = {name: row["problem"] for name, row in found.items()}
    assert problems["plain"] is None and found["plain"]["payload"] == b"body"
    assert problems["good"] is None and found["good"]["payload"] == whole and found["good"]["page_id"] == 1
    assert problems["md5"] is None and problems["again"] is None and found["again"]["payload_bytes"] == 4
    assert problems["gap"] == "segment 3 is missing" and problems["headless"] == "segment 1 is missing"
    assert problems["short"] == f"segments have {len(chunked)} bytes instead of 7"
    assert problems["open"] == "the last segment is missing"
    assert problems["bad"] == "no chunk size where one is due" and problems["early"] == "the response ends early"
    assert problems["digest"] == "the payload differs from its digest"
    assert problems["block"] == "the block differs from its digest"
    assert problems["lost"] == "it revisits an unknown record"
    assert problems["unlike"] == "the payload it revisits differs from its digest"
    assert problems["cut"] == "the archive ends within a record"
    assert {row["problem"] for row in rows if row["record_id"] is None} >= {"no record where one is due"}
    assert any(row["problem"] for row in rows if row["record_type"] is None)


def test_entity_in_pieces_of_any_size():
    chance = random.Random(9)
    body = bytes(chance.randrange(256) for _ in range(500))
    raw = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    for k in range(0, 500, 37):
        raw += b"%x\r\n" % len(body[k:k + 37]) + body[k:k + 37] + b"\r\n"
    raw += b"0\r\n\r\n"
    for size in (1, 2, 3, 7, 50, 1000):
        entity = HttpEntity(True)
        for k in range(0, len(raw), size):
            entity.feed(raw[k:k + size])
        result = entity.result(digest(body))
        assert result["problem"] is None and result["payload"] == body and result["payload_bytes"] == 500


def test_query_against_sql(spark):
    frame = catalog.op13_warc(spark, FOLDER)
    assert mismatch(frame, connect(FOLDER), catalog.SQL["op13_warc"]) is None
