"""Archives: round trips, revisits, and assembly of records in any direction."""

import base64
import gzip
import hashlib
import zlib

import pytest

from tenura.llm import warc

SCHEMA = "page_id long, url string, html string, type string, file string, sha1 string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], SCHEMA).repartition(3)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    last = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        last[payload] = max(last.get(payload, -1), -1 if i is None else i)
    out = set()
    for i, _, html in rows:
        payload = (html or "").encode()
        first = len(payload) < least or last[payload] == (-1 if i is None else i)
        out.add((i, len(payload), digest(payload), "response" if first else "revisit", None if first else last[payload]))
    return out


ROWS = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "http://b", None), (5, "http://b", ""),
    (6, "u\r\nInjected: 1", "WARC/1.1\r\n\r\n\r\n\r\nHTTP"), (7, "é", "é" * 70000), (8, "http://c", "\r\n\r\n"), (None, "http://n", "nothing"),
    (9, "http://d", "<p>x</p>"), (10, "http://e", "abc"), (-5, "http://e", "abc"),
]


@pytest.mark.parametrize("least", [0, 4, 10**6])
def test_pages_come_back(spark, least):
    rows = warc.page_captures(frame(spark, ROWS), least).collect()
    assert {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows} == expected(ROWS, least)
    assert len(rows) == len(ROWS) and all(r["has_request"] for r in rows)
    assert {r["target_uri"] for r in rows if r["page_id"] == 6} == {"u Injected: 1"}


def test_files_are_plain_gzip_members(spark, tmp_path):
    files = warc.write_warc(frame(spark, ROWS), str(tmp_path / "w"), file_bytes=300).collect()
    assert sum(f["captures"] for f in files) == len(ROWS) and len(files) > 3
    whole = b"".join(gzip.decompress((tmp_path / "w" / f["file"]).read_bytes()) for f in files)
    assert whole.count(b"WARC-Type: metadata\r\n") == len(ROWS)
    assert whole.count(b"WARC-Type: revisit\r\n") == 5
    records = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert len(records) == 3 * len(ROWS)
    payloads = {bytes(r["payload"]) for r in records if r["type"] == "response"}
    assert payloads == {(h or "").encode() for _, _, h in ROWS}
    assert all(r["digest_agrees"] for r in records if r["type"] == "response")


def test_captures_are_nested_rows(spark, tmp_path):
    warc.write_warc(frame(spark, ROWS), str(tmp_path / "w"))
    captures = warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    assert len(captures) == len(ROWS)
    for c in captures:
        assert c["request"]["type"] == "request" and c["request"]["http"].startswith("GET ")
        assert c["metadata"]["fields"] is not None and c["n_requests"] == c["n_metadata"] == 1
        assert c["response"]["type"] in ("response", "revisit")


def test_repeated_rows_and_empty_tables(spark):
    assert warc.page_captures(frame(spark, [])).count() == 0
    rows = warc.page_captures(frame(spark, [(1, "u", "x"), (1, "u", "x"), (1, "u", "y"), (2, "u", "x")])).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in rows if r["refers_to"]) == [(1, "revisit", 2)]
    assert len(rows) == 3


def record(kind, name, block=b"", **headers):
    lines = [("WARC-Type", kind), ("WARC-Record-ID", name), *[(k.replace("_", "-"), v) for k, v in headers.items()], ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    http = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nmore"
    content = {"Content_Type": "application/http"}
    (folder / "plain.warc").write_bytes(
        record("warcinfo", "<i>", b"software: x")
        + record("response", "<r1>", http, WARC_Concurrent_To="<q1>", **content)  # the response names its request
        + record("request", "<q1>", b"GET / HTTP/1.1\r\n\r\n", **content)
        + record("metadata", "<m1>", b"a: 1\r\nb: 2", WARC_Concurrent_To="<r1>", Content_Type="application/warc-fields")
        + record("metadata", "<m0>", b"", WARC_Concurrent_To="<r1>", Content_Type="application/warc-fields")
        + record("request", "<q9>", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<gone>", **content)
        + record("request", "<q8>", b"GET / HTTP/1.1\r\n\r\n", **content)
        + record("resource", "<r2>", b"\x00\xff raw")
    )
    (folder / "whole.warc.gz").write_bytes(gzip.compress(record("response", "<r3>", http, **content) + record("request", "<q3>", b"", WARC_Concurrent_To="<r3>", **content)))
    (folder / "empty.warc").write_bytes(b"")
    records = warc.read_warc(spark, str(folder))
    rows = {c["record_id"]: c for c in warc.assemble(records).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<r3>", "<gone>"}
    assert rows["<r1>"]["request"]["record_id"] == "<q1>" and rows["<r1>"]["n_metadata"] == 2
    assert rows["<r1>"]["metadata"]["record_id"] == "<m0>"
    assert rows["<r1>"]["response"]["payload"] == b"body\r\n\r\nmore" and rows["<r2>"]["response"]["payload"] == b"\x00\xff raw"
    assert rows["<gone>"]["response"] is None and rows["<gone>"]["n_requests"] == 1
    assert rows["<r3>"]["n_requests"] == 1


def test_broken_archives_are_told(tmp_path):
    whole = gzip.compress(record("response", "<r>", b"x" * 5000))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.parse_records(memoryview(whole[: len(whole) // 2])))
    with pytest.raises(ValueError):
        list(warc.parse_records(memoryview(b"no archive at all")))
