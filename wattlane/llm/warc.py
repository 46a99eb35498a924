"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

The writer hands complete gzip members to Spark's text writer, which copies a
value's bytes as they are and puts an empty gzip member, as its line
separator, after each: every file is a valid row of members, and Spark's own
commit protocol covers lost tasks. The reader takes whole files of bounded
size. Where a check fails, it searches for the next member or version line
that is valid, goes on there, and logs the bytes between as a gap; it does the
same inside a member, also on what was inflated before the member's damage.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.common import stage


@dataclass(frozen=True)
class WarcConfig:
    """Payloads of ``revisit_bytes`` or more that equal another record's are written as revisits of it."""

    revisit_bytes: int = 1000
    records_per_file: int = 2000
    date: str = "2024-01-01T00:00:00Z"
    gzip_level: int = 5


VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
GZIP_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
#: bytes of the digests that are checked
DIGEST_SIZES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
_URN = "urn:page:"


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 cfg: WarcConfig) -> bytes:
    """One WARC record, uncompressed. ``refers_to`` makes it a revisit, whose block is the HTTP header alone."""

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "urn:unknown")
    head = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {cfg.date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).hexdigest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[5:5] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Damaged(ValueError):
    """A check of a record failed."""


def _named_digest(field: str | None) -> tuple[str, str] | None:
    """(algorithm, hex digest) of a digest field in hex, base 32 or base 64; null where either isn't recognised."""

    name, _, value = (field or "").partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    size = DIGEST_SIZES.get(name)
    if size is None or not value.isascii():
        return None
    if len(value) == 2 * size and re.fullmatch("[0-9A-Fa-f]+", value):
        return name, value.lower()
    bare = value.rstrip("=")
    if len(bare) == -(-size * 8 // 5) and re.fullmatch("[A-Z2-7]+", bare.upper()):
        return name, base64.b32decode(bare.upper() + "=" * (-len(bare) % 8)).hex()
    if len(bare) == -(-size * 8 // 6) and re.fullmatch("[A-Za-z0-9+/_-]+", bare):
        return name, base64.b64decode(bare.replace("-", "+").replace("_", "/") + "=" * (-len(bare) % 4)).hex()
    return None


def _parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the place after it; raises _Damaged where any check fails."""

    end = data.find(b"\r\n\r\n", at)
    lines = data[at:end].split(b"\r\n") if end >= 0 else [b""]
    if not re.fullmatch(rb"WARC/1\.[0-9]", lines[0]):
        raise _Damaged("no version line")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Damaged("bad header line")
        name = name.strip().lower().decode("latin-1")
        if name in head and name != "warc-concurrent-to":
            raise _Damaged("a field repeats")  # a cut-off header runs into the next record's
        head[name] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if "warc-type" not in head or not length.isascii() or not length.isdigit():
        raise _Damaged("header incomplete")
    start, stop = end + 4, end + 4 + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise _Damaged("block doesn't end where its length says")
    block = data[start:stop]
    if (named := _named_digest(head.get("warc-block-digest"))) and hashlib.new(named[0], block).hexdigest() != named[1]:
        raise _Damaged("block digest")
    body_at = block.find(b"\r\n\r\n")
    is_http = head.get("content-type", "").startswith("application/http") and body_at >= 0
    payload = block[body_at + 4 :] if is_http else block
    revisit = head["warc-type"] == "revisit"
    digest, named = hashlib.sha1(payload).hexdigest(), _named_digest(head.get("warc-payload-digest"))
    if revisit:  # that of the full payload, as the field has it where it is no SHA-1
        digest = named[1] if named and named[0] == "sha1" else head.get("warc-payload-digest")
    elif named and named[1] != (digest if named[0] == "sha1" else hashlib.new(named[0], payload).hexdigest()):
        raise _Damaged("payload digest")
    size = len(payload)
    if revisit and is_http:
        said = re.search(rb"(?im)^content-length: *([0-9]+)\r?$", block[: body_at + 2])
        size = int(said.group(1)) if said else None
    record = {"type": head["warc-type"], "record_id": head.get("warc-record-id"), "uri": head.get("warc-target-uri"),
              "refers_to": head.get("warc-refers-to"), "digest": digest, "payload_bytes": size,
              "payload": None if revisit else payload}
    return record, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Content of the gzip member at ``at``, the place after it and "".

    For a damaged member: what was inflated before the damage, how far it was read and the reason.
    """

    inflate, out, pos = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof:
            if pos >= len(data):
                return b"".join(out), len(data), "member is cut off"
            out.append(inflate.decompress(data[pos : pos + 65536]))
            pos += 65536
    except zlib.error as e:
        return *_inflated(data, at), f"member: {e}"
    return b"".join(out), min(pos, len(data)) - len(inflate.unused_data), ""


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """All that can be inflated of the damaged member at ``at``, and the place of the damage."""

    inflate, out = zlib.decompressobj(31), []
    for pos in range(at, len(data), 4096):
        before = inflate.copy()
        try:
            out.append(inflate.decompress(data[pos : pos + 4096]))
        except zlib.error:  # the call's output is lost: once more, byte by byte
            try:
                for i in range(pos, pos + 4096):
                    out.append(before.decompress(data[i : i + 1]))
            except zlib.error:
                return b"".join(out), i
    return b"".join(out), len(data)


def _pieces(data: bytes, starts: re.Pattern, read: Callable) -> Iterator[tuple[int, int, object]]:
    """(start, end, what ``read`` found there, or the reason of a gap), covering all of ``data``.

    ``read`` gives what it found, the end and whether that is sure; else the
    next valid start ends the piece, a version line only after what was read.
    It raises _Damaged where nothing is valid.
    """

    at = 0
    while at < len(data):
        try:
            found, end, sure = read(data, at)
        except _Damaged as e:
            found, end, sure = str(e), at + 1, False
        if not sure:
            done, end = end, len(data)
            for m in starts.finditer(data, at + 1):
                if m.start() < done and m.group() != GZIP_MAGIC:
                    continue
                try:
                    read(data, m.start())
                except _Damaged:
                    continue
                end = m.start()
                break
        yield at, end, found
        at = end


def _record_at(data: bytes, at: int) -> tuple[dict, int, bool]:
    return *_parse_record(data, at), True


def _rows_at(data: bytes, at: int) -> tuple[list[dict], int, bool]:
    """Records, and gaps inside the member, of the member or plain record at ``at``, as ``_pieces`` reads them."""

    if data[at : at + 3] != GZIP_MAGIC:
        record, end = _parse_record(data, at)
        return [record], end, True
    content, end, damage = _member(data, at)
    rows, reasons = [], []
    for start, stop, found in _pieces(content, _VERSION_LINE, _record_at):
        if isinstance(found, str):
            reasons.append(found)
            found = {"type": "gap", "reason": f"{found} (bytes {start} to {stop} of the member's content)"}
        rows.append(found)
    if len(reasons) == len(rows) and (damage or rows):
        raise _Damaged(damage or reasons[0])
    if damage:
        rows.append({"type": "gap", "reason": f"{damage} (after {len(content)} bytes of the member's content)"})
    return rows, end, not damage


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive file, in order, with their byte offsets and lengths.

    A gap runs from the first byte that isn't valid to the next valid member
    or record, or to the end; ``reason`` says which check failed there. All
    records and gaps of one gzip member have the member's offset and length;
    such a gap's reason says which bytes of the content it covers.
    """

    for at, end, found in _pieces(data, _START, _rows_at):
        for r in [{"type": "gap", "reason": found}] if isinstance(found, str) else found:
            yield {**r, "offset": at, "length": end - at}


_ROW = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()),
    ("record_id", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("reason", pa.string()),
])
_ROW_DDL = ("file string, offset long, length long, type string, record_id string, uri string, refers_to string, "
            "digest string, payload_bytes long, payload binary, reason string")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record, and per gap (type ``gap``), of all files under ``path``; gzipped or plain.

    Revisits have no payload of their own; their size and digest are those of
    the full payload. ``payloads=False`` leaves payloads null. Empty files
    give no rows; repeated records come repeated.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[dict] = []
                held = 0
                for r in salvage(content.as_py()):
                    r["file"] = file
                    if not payloads:
                        r["payload"] = None
                    held += len(r.get("payload") or b"")
                    rows.append(r)
                    if held > 16_000_000 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, _ROW)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, _ROW_DDL)


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               cfg: WarcConfig | None = None) -> None:
    """Write one record per row of ``pages`` to gzipped files under ``path``; a null html is an empty payload.

    Of equal payloads of ``revisit_bytes`` or more, the one with the largest
    page_id is written as a response (each row that repeats that id, too), the
    others as revisits of it; rows with a null page_id revisit it as well. The
    payloads' digests are grouped, never the payloads.
    """

    cfg = cfg or WarcConfig()
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    large = rows.where(F.octet_length("payload") >= cfg.revisit_bytes)
    groups = large.groupBy(F.col("digest").alias("known")).agg(
        F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("known", "first_id")
    groups = stage(groups, "repeated")
    joined = rows.join(groups, rows["digest"] == groups["known"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    refers_to = F.when(revisit, F.col("first_id"))

    @F.arrow_udf("binary")
    def member(ids: pa.Array, urls: pa.Array, payloads: pa.Array, digests: pa.Array, refers: pa.Array) -> pa.Array:
        out = []
        for i, u, p, d, r in zip(ids.to_pylist(), urls.to_pylist(), payloads, digests.to_pylist(), refers.to_pylist(),
                                 strict=True):
            record = record_bytes(i, u, p.as_py(), d, r, cfg)
            out.append(gzip.compress(record, cfg.gzip_level, mtime=0))
        return pa.array(out, pa.binary())

    members = joined.select(member("page_id", "url", "payload", "digest", refers_to).cast("string").alias("value"))
    (members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("maxRecordsPerFile", cfg.records_per_file).text(path))


def page_number(urn: str) -> Column:
    """The page id in a record id column; null where it has none."""

    return F.regexp_extract(F.col(urn), f"<{_URN}(-?[0-9]+)>", 1).try_cast("long")
