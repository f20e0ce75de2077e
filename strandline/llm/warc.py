"""WARC archives: a writer with revisit records, and a reader that salvages what damaged archives still hold."""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch

#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
#: A gzip member of nothing; it ends each run of members that the writer hands to Spark.
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
_ID = "urn:strandline:page:"
#: A header ends within so many bytes; what doesn't is no record.
HEADER_BYTES = 1 << 16
_HEADER = re.compile(rb"WARC/[0-9.]+\r\n(?:[^\r\n:]+:[^\r\n]*\r\n(?:[ \t][^\r\n]*\r\n)*)*\r\n")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record: a response with its payload, or with refers_to a revisit whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


class Damaged(ValueError):
    """What stands here is no whole and valid record or member. to: where the search goes on, if the place is known."""

    def __init__(self, reason: str, to: int | None = None):
        super().__init__(reason)
        self.to = to


@dataclass
class Found:
    """A record, or with `reason` a quarantined gap, at bytes start to end of the file as stored."""

    start: int
    end: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    payload_bytes: int = 0
    digest: str = ""


def _member(content: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """The decompressed gzip member at a place, where it ends, and what is wrong with it: zlib checks its CRC and length.
    Of a damaged member, the bytes up to the damage."""
    inflate, out, to = zlib.decompressobj(31), [], at
    while not inflate.eof:
        if to >= len(content):
            return b"".join(out), to, "member cut short"
        before = inflate.copy()
        try:
            out.append(inflate.decompress(content[to : to + 65536]))
            to = min(len(content), to + 65536)
        except zlib.error as e:
            with contextlib.suppress(zlib.error):
                while True:
                    out.append(before.decompress(content[to : to + 1]))
                    to += 1
            return b"".join(out), to, f"member: {e}"
    return b"".join(out), to - len(inflate.unused_data), None


def _inside(data: bytes, at: int, end: int) -> tuple[list[Found], str | None]:
    """The valid records of a decompressed member, with the gaps between them as places in it; the first reason of a gap."""
    found, inner, reason, bad = [], 0, None, None
    while inner < len(data):
        if bad is None and data.startswith(b"\r\n", inner):
            inner += 2
            continue
        try:
            record, to = _record(data, inner)
        except Damaged as e:
            reason, bad = reason or str(e), bad or (inner, str(e))
            if e.to is not None and (e.to == len(data) or data.startswith(b"WARC/", e.to)):
                inner = e.to
                continue
            line = data.find(b"\nWARC/", inner)
            inner = line + 1 if line >= 0 else len(data)
            continue
        if bad:
            found.append(Found(at, end, f"{bad[1]} (bytes {bad[0]} to {inner} of the member)"))
            bad = None
        record.start, record.end = at, end
        found.append(record)
        inner = to
    if bad:
        found.append(Found(at, end, f"{bad[1]} (bytes {bad[0]} to {inner} of the member)"))
    return found, reason


def _digest_holds(stated: str, content: bytes) -> bool:
    """Whether a digest (in lower case; sha1 is mostly in base32, sha256 in hex) fits; others can't be told."""
    kind, _, value = stated.partition(":")
    if kind not in ("sha1", "sha256", "md5") or not value:
        return True
    raw = hashlib.new(kind, content, usedforsecurity=False).digest()
    return value in (raw.hex(), base64.b32encode(raw).decode().lower(), base64.b32encode(raw).decode().lower().rstrip("="))


def _record(data: bytes, at: int) -> tuple[Found, int]:
    """The record at a place in plain bytes, and where it ends, after all checks."""
    if not data.startswith(b"WARC/", at):
        raise Damaged("no version line")
    header = _HEADER.match(data, at, at + HEADER_BYTES)
    if header is None:
        raise Damaged("header cut short, too long or with an odd line")
    blank = header.end() - 4
    lines = data[at:blank].decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines[1:]) if sep}
    size = headers.get("content-length", "")
    if not size.isdecimal() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("header without type, id or length")
    start, end = blank + 4, blank + 4 + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("length doesn't lead to the end of the record")
    block = data[start:end]
    payload, sent = block, None
    if headers.get("content-type", "").startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            raise Damaged("HTTP header cut short", end + 4)
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        sent = int(length[1]) if length else None
    stated = headers.get("warc-payload-digest", "").lower()
    if headers["warc-type"] == "revisit":
        digest, n = stated.removeprefix("sha256:"), sent if sent is not None else 0
    else:
        digest, n = hashlib.sha256(payload).hexdigest(), len(payload)
        if not _digest_holds(stated, payload):
            raise Damaged("payload digest differs", end + 4)
    if headers.get("warc-block-digest") and not _digest_holds(headers["warc-block-digest"].lower(), block):
        raise Damaged("block digest differs", end + 4)
    return Found(0, 0, None, headers, payload, n, digest), end + 4


def salvage(content: bytes) -> Iterator[Found]:
    """Every valid record of an archive, gzip members or plain, with the gaps between them.

    Where a check fails (CRC, lengths, header, payload or block digest), the reader looks for the next gzip magic or version line
    that opens a valid member or record and goes on there; the bytes passed over are yielded as one gap with the first
    reason. Where only a digest differs, and the stated length leads to another record or the end, it goes on there, so a record that a
    damaged payload quotes isn't taken for one of the archive. A header ends within 64 KB. Inside a member the search goes on in its decompressed bytes, and a gap there is one with the member's place,
    whose reason says which of its bytes; of a damaged member, the records before the damage are yielded, and the gap from
    its start. An empty file gives nothing. Empty members and blank lines between records are no gaps.
    """
    view, n, at = memoryview(content), len(content), 0
    bad: tuple[int, str] | None = None
    known: set[str] = set()
    candidates = _Candidates(content)
    while at < n:
        try:
            if content.startswith(GZIP_MAGIC, at):
                data, end, broken = _member(view, at)
                found, reason = _inside(data, at, end)
                good = [x for x in found if not x.reason]
                if (broken or reason) and not good:
                    raise Damaged(broken or reason, None if broken else end)
                if broken:  # its good records; what follows the damage is sought in the file
                    if bad and bad[0] < at:
                        yield Found(bad[0], at, bad[1])
                    yield from good
                    bad = (at, broken)
                    known = {x.headers["warc-record-id"] for x in good}
                    at = candidates.after(at + 1)
                    continue
            elif bad is None and content.startswith(b"\r\n", at):
                found, end = [], at + 2
            else:
                record, end = _record(content, at)
                if bad and record.headers["warc-record-id"] in known:
                    raise Damaged(bad[1])  # stored bytes of a damaged member, whose records were yielded
                record.start, record.end = at, end
                found = [record]
        except Damaged as e:
            bad = bad or (at, str(e))
            known_end = e.to is not None and (e.to == n or content.startswith((b"WARC/", GZIP_MAGIC), e.to))
            at = e.to if known_end else candidates.after(at + 1)
            continue
        if bad:
            yield Found(bad[0], at, bad[1])
            bad, known = None, set()
        yield from found
        at = end
    if bad:
        yield Found(bad[0], n, bad[1])


class _Candidates:
    """Where members or version lines may stand; each is sought once, whatever comes between."""

    def __init__(self, content: bytes):
        self.content, self.member, self.line = content, -1, -1

    def after(self, at: int) -> int:
        """The next such place from here on; the end if there is none."""
        none = len(self.content)
        if self.member < at:
            found = self.content.find(GZIP_MAGIC, at)
            self.member = found if found >= 0 else none
        if self.line < at:
            found = self.content.find(b"\nWARC/", at - 1)
            self.line = found + 1 if found >= 0 else none
        return min(self.member, self.line)


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = 100, file_bytes: int = 8 << 20, path: str | None = None) -> str:
    """Write a record for each page, one gzip member each, and return the folder (by default a new shared one).

    Of pages with equal payloads of at least `revisit_bytes`, that with the smallest id is a response and the others
    revisit it; rows that share the smallest id are all responses. A null payload is empty. A null id is written as
    such, never chosen as the smallest, and revisits an equal page that has an id. A null url leaves the header out. Other
    columns are ignored. An empty table gives a folder without archives. Files close at about `file_bytes`.

    The smallest ids come from an aggregation that is combined before the shuffle; a payload shared by many pages is one
    key of a left join, which Spark splits at run time.
    """
    spark = pages.sparkSession
    payload = F.coalesce(pages[html_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    firsts = rows.filter(F.col("size") >= revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("of"), "first")
    joined = rows.join(firsts, rows.digest == firsts.of, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = joined.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest", "size", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, body, digest, n, to in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                held.append(deflate.compress(record_bytes(page_id, url, body or b"", digest, n, to)) + deflate.flush())
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["content"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["content"])

    out = path or scratch(spark, "warc")
    files = joined.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(out)
    return out


RECORD_SCHEMA = "file string, start long, end long, gap string, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True, glob: str = "part-*") -> DataFrame:
    """Every record and every quarantined gap of the archives in a folder. `gap` is null for records and the reason for
    gaps, whose start and end are the bytes passed over. Without payloads that column is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for x in salvage(content.as_py()):
                    h = x.headers
                    uri = lambda name, h=h: h[name].strip("<>") if name in h else None
                    rows.append((file, x.start, x.end, x.reason, h.get("warc-type"), uri("warc-record-id"), h.get("warc-target-uri"), uri("warc-refers-to"), None if x.reason else x.payload_bytes, None if x.reason else x.digest, x.payload if payloads and not x.reason else None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    text, number = pa.string(), pa.int64()
    schema = pa.schema([("file", text), ("start", number), ("end", number), ("gap", text), ("record_type", text), ("record_id", text), ("target_uri", text), ("refers_to", text), ("payload_bytes", number), ("payload_digest", text), ("payload", pa.binary())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """The records that write_warc wrote, with page ids: page_id, payload_bytes, payload_digest, record_type, refers_to. Gaps are left out; a
    record whose id isn't one of write_warc's, or that of a null page id, has a null page_id; records that repeat stay."""
    number = lambda name: F.expr(f"try_cast(substring({name}, {len(_ID) + 1}) as bigint)")
    return records.filter("gap is null").select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
