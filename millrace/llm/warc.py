"""WARC archives of pages: records are written, read back, and joined into one nested row per capture.

Every page is a transaction of three records: the request, the response (or, where another record has the same
payload, a revisit that refers to it) and the metadata that hold the page's id. Request and metadata name the
response as concurrent to them.

Method: transaction assembly. ``write`` has Spark's text writer put records into gzip files, one after the other, with
the two line ends that close a record as line separator. ``read`` has Spark's text reader cut the files before each
version line; what was cut within a payload or a header is put together again by the declared length, so
any payload comes back byte by byte. A task holds one record at a time. ``captures`` joins records through their
concurrent-to identifiers, in whatever direction and over however many steps they are given. Records of a
transaction meet in joins and in sums of bounded size; nothing is collected.

Nulls and ties: a null payload is empty, a null url gives a record without target, a null id metadata without id. Of
equal payloads the record of the largest id is the response (null is the least; of rows that share the id, one). Repeated
rows are captures of their own. Control characters of a url are percent-encoded (line ends, tabs, blanks) or left out, as they would
break the header. A payload has to fit a Spark row (2 GB). An empty table gives an archive without records.

What does not fit: a companion (request, metadata, ...) that leads to no response, and all but the one of least record id of
several that a response has of a kind, are captures of their own with a null response: nothing is dropped. Records cut
off, or of another length than they say, are errors. Uncompressed archives are read too, but one that holds a version line within
a payload where Spark splits the file is refused; compressed files are never split.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.rows import quoted
from millrace.scratch import materialize

# WARC 1.0 and 1.1, and the profile of revisits with equal payloads.
VERSION = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource")

#: Records in a file at most; a file is read by one task.
PER_FILE = 100_000

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(payload: Column) -> Column:
    """Base32 SHA-1: each 40 bits are ten hexadecimal and eight base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    date: str | None = None,
) -> None:
    """Write the records of all pages below ``path``. Payloads of less than ``least`` bytes are never revisits."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(quoted(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(quoted(id_col).alias("id"), _safe(quoted(url_col)).alias("url"), payload.alias("payload"))
    # Written, so that a row keeps its number and Spark can split the rows of a common payload in the join.
    rows = rows.withColumns({"size": F.octet_length("payload"), "digest": digest(F.col("payload")), "more": F.xxhash64("payload")})
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "pages")
    same = ["digest", "more", "size"]
    shared = rows.where(F.col("size") >= least).groupBy(*same).agg(F.max(F.struct("id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.where("n > 1").select(*same, F.col("first.row").alias("first")), "shared")
    told = rows.join(shared, same, "left").withColumn("again", F.coalesce(F.col("first") != F.col("row"), F.lit(False)))
    records = told.select(F.explode(_records(uuid4().hex, date)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)


def _safe(url: Column) -> Column:
    for plain, coded in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(plain), F.lit(coded))
    return F.regexp_replace(url, r"[\x00-\x1F\x7F]", "")


def _urn(run: str, kind: str, row: str) -> Column:
    key = F.md5(F.concat(F.lit(f"{run}:{kind}:"), F.col(row).cast("string")))
    cuts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: Column | str, fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """Header and block; a field whose value is null is left out."""
    fields = [("WARC-Type", kind), *fields, ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.concat(F.lit(f"\r\n{name}: "), F.lit(v) if isinstance(v, str) else v) for name, v in fields]
    return F.concat(F.lit(f"{VERSION}1"), *[F.coalesce(line, F.lit("")) for line in lines], F.lit(END), block)


def _records(run: str, date: str) -> Column:
    own, http = _urn(run, "response", "row"), "application/http;msgtype="
    about = [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    target = F.regexp_extract("url", r"^[^:/?#]*://[^/?#]*([^#]*)", 1)
    target = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target))
    asked = F.coalesce(F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)), F.lit(f"GET / HTTP/1.1{END}"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    again = F.col("again")
    # As text, because the writer takes text; it writes the bytes as they are.
    answered = F.when(again, head).otherwise(F.concat(head, F.col("payload").cast("string")))
    response = [
        ("WARC-Record-ID", own),
        *about,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Refers-To", F.when(again, _urn(run, "response", "first"))),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("Content-Type", http + "response"),
    ]
    described = F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))
    beside = [("WARC-Concurrent-To", own), *about]
    return F.array(
        _record("request", [("WARC-Record-ID", _urn(run, "request", "row")), *beside, ("Content-Type", http + "request")], asked),
        _record(F.when(again, F.lit("revisit")).otherwise(F.lit("response")), response, answered),
        _record("metadata", [("WARC-Record-ID", _urn(run, "metadata", "row")), *beside, ("Content-Type", "application/warc-fields")], described),
    )


_MAP = pa.map_(pa.string(), pa.string())
_SHAPE = {
    "record_id": pa.string(),
    "type": pa.string(),
    "date": pa.string(),
    "target_uri": pa.string(),
    "concurrent_to": pa.list_(pa.string()),
    "refers_to": pa.string(),
    "status": pa.int32(),
    "head": pa.string(),
    "fields": _MAP,
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "intact": pa.bool_(),
    "payload": pa.binary(),
}
_SCHEMA = (
    "record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, status int, "
    "head string, fields map<string,string>, payload_bytes long, payload_digest string, intact boolean, payload binary"
)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record. ``payload_digest`` is the one declared or, without one, that of the payload found;
    ``intact`` says whether both agree (null where nothing is declared or nothing is stored, as in a revisit).

    ``head`` is the HTTP header, ``fields`` hold the lines of metadata. Without ``payloads`` their bytes stay in the task.
    """
    lines = spark.read.option("lineSep", VERSION).text(path)
    lines = lines.select(
        F.col("value").cast("binary").alias("value"),
        F.concat_ws("@", "_metadata.file_path", F.col("_metadata.file_block_start").cast("string")).alias("part"),
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for record in _joined(batches):
            row = _parsed(*record, payloads)
            out.append(row)
            held += len(row["payload"] or b"") + 1000
            if held > 4_000_000:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)

    return lines.mapInArrow(parse, _SCHEMA)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in _SHAPE.items()], names=list(_SHAPE))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header and block of each record; pieces are joined until the declared length is reached."""
    cut = VERSION.encode()
    part, pieces, size, need = None, [], 0, None

    def left() -> None:
        if pieces:
            raise ValueError(f"{part}: a record is cut off, or split within its payload")

    for batch in batches:
        for value, own in zip(batch.column("value"), batch.column("part")):
            if (name := own.as_py()) != part:
                left()
                part = name
                if part.endswith("@0"):  # what stands before the first version line
                    if value.as_py().strip():
                        raise ValueError(f"{part}: not a WARC archive")
                    continue
            if pieces:
                pieces.append(cut)
                size += len(cut)
            pieces.append(value.as_py())
            size += len(pieces[-1])
            if need is None:
                at = (raw := b"".join(pieces)).find(b"\r\n\r\n")
                if at < 0:
                    pieces = [raw]
                    continue
                fields = _fields(raw[:at].decode("utf-8", "replace").split("\r\n")[1:])
                length = next((v for k, v in fields if k.lower() == "content-length"), "")
                if not length.isdigit():
                    raise ValueError(f"{part}: a record without a length")
                start, pieces = at + 4, [raw]
                need = start + int(length) + 4
            if size < need:
                continue
            raw = pieces[0] if len(pieces) == 1 else b"".join(pieces)
            if size > need or raw[-4:] != b"\r\n\r\n":
                raise ValueError(f"{part}: a record of another length than it says")
            yield fields, raw[start : need - 4]
            pieces, size, need = [], 0, None
    left()


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:  # a folded line goes on
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _parsed(fields: list[tuple[str, str]], block: bytes, payloads: bool) -> dict:
    about = {k.lower(): v for k, v in reversed(fields)}
    kind, head, status, payload = about.get("warc-type"), None, None, block
    if about.get("content-type", "").replace(" ", "").startswith("application/http"):
        raw, found, payload = block.partition(b"\r\n\r\n")
        head = raw.decode("utf-8", "replace")
        code = head.split(" ", 2)[1:2] if kind != "request" else []
        status = int(code[0]) if code and code[0].isdigit() else None
    stored = kind != "revisit"
    declared = about.get("warc-payload-digest")
    named = declared.partition(":")[2] if declared else None
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode() if stored else None
    known = declared is not None and stored and declared.lower().startswith("sha1:")
    warc = about.get("content-type") == "application/warc-fields"
    return {
        "record_id": about.get("warc-record-id"),
        "type": kind,
        "date": about.get("warc-date"),
        "target_uri": about.get("warc-target-uri"),
        "concurrent_to": [v for k, v in fields if k.lower() == "warc-concurrent-to"],
        "refers_to": about.get("warc-refers-to"),
        "status": status,
        "head": head,
        "fields": list(dict(_fields(block.decode("utf-8", "replace").split("\r\n"))).items()) if warc else None,
        "payload_bytes": len(payload) if stored else None,
        "payload_digest": named or own,
        "intact": named.upper() == own if known else None,
        "payload": payload if payloads and stored else None,
    }


_RESPONSE = "record_id type status head payload_bytes payload_digest intact payload".split()
_REQUEST = "record_id head payload_bytes payload".split()
_METADATA = "record_id fields".split()


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, target_uri, date, response, request, metadata, origin.

    ``capture_id`` is the record id of the response, revisit or resource. ``origin`` holds, for a revisit whose response is among the
    records, that response's record_id, payload_bytes and metadata.
    """
    records = materialize(records, "records")
    main = records.where(F.col("type").isin(*PRIMARY))
    rest = records.where(F.col("record_id").isNotNull() & ~F.col("type").isin(*PRIMARY, "warcinfo", "continuation", "conversion"))
    owners = _owners(records, main.select("record_id"), rest.select("record_id"))
    owned = rest.join(owners, "record_id")

    def of(kind: str, columns: list[str], name: str) -> DataFrame:
        one = F.min_by(F.struct(*columns), "record_id").alias(name)
        return owned.where(F.col("type") == kind).groupBy("owner").agg(one)

    requests = materialize(of("request", _REQUEST, "request"), "requests")
    notes = materialize(of("metadata", _METADATA, "metadata"), "metadata")
    found = main.select(
        F.col("record_id").alias("capture_id"), "target_uri", "date", F.struct(*_RESPONSE).alias("response"), F.col("refers_to").alias("refers")
    )
    for part in (requests, notes):
        found = found.join(part.withColumnRenamed("owner", "capture_id"), "capture_id", "left")
    found = materialize(found, "captures")
    # Of copies of a record that archives hold, the one of least bytes; so a revisit stays one row.
    origins = found.where("response.type <> 'revisit' and capture_id is not null").groupBy(F.col("capture_id").alias("refers"))
    origin = F.struct(F.col("capture_id").alias("record_id"), F.col("response.payload_bytes").alias("payload_bytes"), "metadata")
    origins = materialize(origins.agg(F.min_by(origin, "response.payload_bytes").alias("origin")), "origins")
    whole = found.join(origins, "refers", "left").drop("refers")
    used = requests.select("request.record_id").union(notes.select("metadata.record_id"))
    alone = rest.join(used, "record_id", "left_anti").select(
        F.col("record_id").alias("capture_id"),
        "target_uri",
        "date",
        *[
            F.when(F.col("type") == kind, F.struct(*columns)).alias(name)
            for kind, columns, name in (("request", _REQUEST, "request"), ("metadata", _METADATA, "metadata"))
        ],
    )
    return whole.unionByName(alone, allowMissingColumns=True)


def _owners(records: DataFrame, main: DataFrame, rest: DataFrame) -> DataFrame:
    """record_id and owner of the companions that concurrent-to identifiers lead to a main record, the least at the fewest steps."""
    named = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = materialize(named.union(named.select("b", "a")).where("a is not null and a <> b").distinct(), "links")
    known = main.select(F.col("record_id").alias("b"), F.col("record_id").alias("owner")).distinct()
    out, waiting = None, rest.distinct()
    while True:
        reached = links.join(known, "b").groupBy(F.col("a").alias("record_id")).agg(F.min("owner").alias("owner"))
        step = materialize(reached.join(waiting, "record_id", "left_semi"), "owners")
        out = step if out is None else out.unionByName(step)
        waiting = materialize(waiting.join(step, "record_id", "left_anti"), "waiting")
        if step.isEmpty() or waiting.isEmpty():
            return out
        known = step.select(F.col("record_id").alias("b"), "owner")
