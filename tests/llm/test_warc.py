import base64
import gzip
import hashlib

import pytest

from millrace.llm import queries, warc

CLASHING = ", ".join(f"{c} string" for c in "id row digest more size first again n value payload type record_id".split())


def pages(spark, rows):
    schema = f"page_id long, url string, html string, {CLASHING}"
    return spark.createDataFrame([(*r, *["x"] * 12) for r in rows], schema).repartition(3)


ODD = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\nWARC/1.WARC/1."
ROWS = [
    (1, "http://a.b/c?d=é#f", "<html>ü</html>"),
    (2, "http://a.b", "<html>ü</html>"),
    (9, None, "<html>ü</html>"),
    (3, "http://x/WARC/1.1\r\n\r\nWARC-Type: x", ODD),
    (4, "", ""),
    (5, "no host", None),
    (6, "http://z/", "WARC/1." * 20_000),
    (7, "http://z/\t\x01 y", "\r\n\r\n"),
    (7, "http://z/2", "\r\n\r\n"),
    (None, "http://n/", "of none"),
    (None, "http://n/", "of none"),
    (8, "http://l/", "long " * 600_000),
]


def brute(rows, least=0):
    """(id, bytes, digest, type, refers_to), sorted."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i), reverse=True)
        named = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, i in enumerate(ids):
            again = k > 0 and len(payload) >= least
            out.append((i, len(payload), named, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def back(spark, tmp_path, rows, **more):
    path = str(tmp_path / "archive")
    warc.write(pages(spark, rows), path, **more)
    return warc.read(spark, path)


@pytest.mark.parametrize("least", [0, 10, 1 << 40])
def test_round_trip_against_plain_python(spark, tmp_path, least):
    found = queries.archived(warc.captures(back(spark, tmp_path, ROWS, least=least)))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()]
    assert sorted(got, key=str) == brute(ROWS, least)


def test_captures_are_whole_transactions(spark, tmp_path):
    rows = warc.captures(back(spark, tmp_path, ROWS)).collect()
    assert len(rows) == len(ROWS)
    assert all(r.request.record_id and r.metadata.record_id and r.response.record_id == r.capture_id for r in rows)
    assert all(r.response.intact for r in rows if r.response.type == "response")
    by_id = {r.metadata.fields.get("page-id"): r for r in rows}
    assert bytes(by_id["3"].response.payload).decode() == ODD
    assert bytes(by_id["6"].response.payload).decode() == "WARC/1." * 20_000
    assert by_id["1"].target_uri == "http://a.b/c?d=é#f" and by_id["9"].target_uri is None
    assert by_id["1"].request.head.startswith("GET /c?d=é HTTP/1.1\r\nHost: a.b")
    assert by_id["2"].origin.metadata.fields == {"page-id": "9"} and by_id["2"].response.payload is None
    assert by_id["2"].response.status == 200 and by_id["9"].origin is None


def test_files_are_plain_warc(spark, tmp_path):
    """A parser that knows nothing but the declared lengths finds all records."""
    back(spark, tmp_path, ROWS[:4])
    kinds = []
    for file in (tmp_path / "archive").glob("part-*.gz"):
        raw, at = gzip.decompress(file.read_bytes()), 0
        while at < len(raw):
            head, _, _ = raw[at:].partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            about = dict(line.split(": ", 1) for line in lines[1:])
            at += len(head) + 4 + int(about["Content-Length"])
            assert raw[at : at + 4] == b"\r\n\r\n"
            at += 4
            kinds.append(about["WARC-Type"])
    assert sorted(kinds) == ["metadata"] * 4 + ["request"] * 4 + ["response"] * 2 + ["revisit"] * 2


def record(kind, name, block=b"", concurrent=(), version=b"WARC/1.0"):
    lines = [version, b"WARC-Type: " + kind.encode(), b"warc-record-id: " + name.encode()]
    lines += [b"WARC-Concurrent-To: " + c.encode() for c in concurrent]
    lines += [b"Content-Type: application/http; msgtype=" + kind.encode()] if kind in ("request", "response") else []
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(tmp_path, raw, name="a.warc.gz"):
    folder = tmp_path / "others"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(raw)
    return str(folder)


def test_other_writers_name_records_in_any_direction(spark, tmp_path):
    http = b"HTTP/1.1 404 Not Found\r\nA: b\r\n\r\nbody"
    raw = [
        record("warcinfo", "i"),
        record("response", "r1", http, ["q1"]),  # names the request, which names nothing
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n"),
        record("metadata", "m1", b"k: v", ["q1"]),  # two steps away
        record("metadata", "m2", b"k: w", ["m1"]),  # three
        record("resource", "r2", b"file"),
        record("request", "q9", b"GET /alone HTTP/1.1\r\n\r\n", ["gone"]),
    ]
    # A member for each record, as usual, and a file with one for all.
    path = archive(tmp_path, b"".join(map(gzip.compress, raw[:4])))
    archive(tmp_path, gzip.compress(b"".join(raw[4:])), "b.warc.gz")
    rows = {r.capture_id: r for r in warc.captures(warc.read(spark, path)).collect()}
    assert sorted(rows) == ["m2", "q9", "r1", "r2"]
    assert rows["r1"].request.record_id == "q1" and rows["r1"].metadata.record_id == "m1"
    assert rows["r1"].response.status == 404 and bytes(rows["r1"].response.payload) == b"body"
    assert rows["r2"].response.type == "resource" and rows["r2"].request is None
    assert rows["m2"].response is None and rows["q9"].request.head.startswith("GET /alone")


@pytest.mark.parametrize("raw", [record("response", "r")[:-6], b"junk" + record("response", "r"), record("response", "r") + b"x", b"WARC/1.0\r\na: b\r\n\r\n"])
def test_damaged_archives_are_errors(spark, tmp_path, raw):
    with pytest.raises(Exception, match="cut off|another length|not a WARC|without a length"):
        warc.read(spark, archive(tmp_path, gzip.compress(raw))).collect()


def test_an_empty_table(spark, tmp_path):
    assert back(spark, tmp_path, []).count() == 0
    assert warc.captures(warc.read(spark, str(tmp_path / "archive"))).count() == 0


def test_without_payloads_only_their_digests_leave_the_task(spark, tmp_path):
    back(spark, tmp_path, ROWS[:2])
    rows = warc.read(spark, str(tmp_path / "archive"), payloads=False).where("type = 'response'").collect()
    assert [(r.payload, r.payload_bytes, r.intact) for r in rows] == [(None, 15, True)]
