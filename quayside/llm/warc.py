"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

*Writing.* Each page becomes a record in a gzip member of its own. Of pages with the same payload of
at least ``REVISIT_BYTES``, the one with the greatest page_id is the response, the others revisit
it. Spark's text writer stores the members, as it writes bytes to every file system that Spark
knows; it ends each value with a separator, and here that is the zero byte with which
a member ends anyway (the top byte of its length; a member that ends otherwise is followed by an
empty one, which ends with zero).

*Reading.* Archives may be compressed by member or plain. A record is taken if its member
decompresses and passes its checksum, its header parses, its length fits and its digest is right.
Where that fails, the reader looks for the next place at which a valid member or a version line
with a valid record begins, goes on from there, and logs the bytes between as a gap with the reason.
Inside a member that passes its checksum, bad records are gaps with their place in the unpacked bytes, and
the records around them are kept. Of a member that is damaged or cut off, what unpacks before the damage is searched
by version lines, too; records found there have no checksum of their member behind them and are marked as not checked.
Fields of other writers: digests may be in base32 or hexadecimal; a digest, length or record id that
cannot be read or does not fit is NULL.

Results by case: a NULL html is an empty payload; a NULL page_id orders before all others, and of
pages without id none refers; NULL urls leave out the header; line ends in urls are escaped; repeated
rows are records of their own (all of them responses if theirs is the greatest page_id); an empty table
makes no records; extra columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.base import query, table
from quayside.session import scratch_folder

REVISIT_BYTES = 1000
#: An archive holds at most so many records and bytes, as it is read back whole.
RECORDS_PER_FILE, FILE_BYTES = 4096, 1 << 29
#: Compressed bytes unpacked at a time where a member is known to be damaged.
STEP = 64
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
RECORD_ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
_MUST = {"warc-type", "warc-record-id", "warc-date"}
_EMPTY_MEMBER = zlib.compressobj(9, wbits=31).flush()
_START = re.compile(rb"\x1f\x8b\x08|(?:(?<=\n)|\A)WARC/1\.")
_LINE = re.compile(rb"(?:(?<=\n)|\A)WARC/1\.")
_HEAD = re.compile(rb"WARC/1\.\d\r\n((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hexadecimal(digest: str) -> str | None:
    """A SHA-1 digest field as lower-case hexadecimal; NULL if it is none."""
    value = digest.removeprefix("sha1:")
    if value == digest:
        return None
    if re.fullmatch(r"[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record, not compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>")]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{RECORD_ID}{'' if refers_to is None else refers_to}>")]
    fields += [
        ("WARC-Date", date), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member that ends with a zero byte."""
    packer = zlib.compressobj(level, wbits=31)
    packed = packer.compress(data) + packer.flush()
    return packed if packed.endswith(b"\0") else packed + _EMPTY_MEMBER


def _members(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page_id, url, html, refers_to, revisit in zip(*batch.columns, strict=True):
                payload = html.as_py() or b""
                packed = member(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py(), date))
                out.append(packed[:-1])
                size += len(packed)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
    return run


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, date: str = DATE,
                   file_bytes: int = FILE_BYTES) -> None:
    """Writes ``pages(page_id, url, html)`` as archives below ``path``.

    An archive has so few records that even the longest of all would not take it beyond ``file_bytes``.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("long", F.octet_length("payload") >= REVISIT_BYTES)
    # Only digests that occur twice matter; a page without that is a response.
    twice = rows.filter("long").groupBy("digest").agg(
        F.max("page_id").alias("_last"), F.count("*").alias("_n")).filter("_n > 1").select(
        F.col("digest").alias("_digest"), "_last")
    joined = rows.join(twice, F.when(F.col("long"), F.col("digest")) == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    records = joined.select("page_id", "url", "payload", F.when(revisit, F.col("_last")).alias("refers_to"), revisit.alias("revisit"))
    longest = pages.agg(F.max(
        F.coalesce(F.octet_length(F.col("html").cast("binary")), F.lit(0)).cast("long")
        + 3 * F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    records_per_file = max(1, min(records_per_file, file_bytes // (longest + 1024)))
    (
        records.mapInArrow(_members(date), "member binary").select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(path))


class Salvaged(NamedTuple):
    """A record, or (with ``problem``) a gap, at bytes start to end of an archive.

    ``inner`` is the place in the unpacked member, for gaps and records in one. A gap's ``recovered`` are
    records out of damaged members in it.
    """

    start: int
    end: int
    problem: str | None
    fields: dict[str, str]
    payload: bytes
    inner: tuple[int, int] | None = None
    recovered: tuple[Salvaged, ...] = ()


def _unzipped(data: memoryview, start: int) -> tuple[bytes, int]:
    unpacker = zlib.decompressobj(wbits=31)
    parts, at = [], start
    while not unpacker.eof:
        if at >= len(data):
            raise ValueError("cut off member")
        part = data[at: at + (1 << 16)]
        parts.append(unpacker.decompress(part))
        at += len(part)
    return b"".join(parts), at - len(unpacker.unused_data)


def _unzipped_part(data: memoryview, start: int) -> tuple[bytes, int]:
    """What a damaged member holds before the damage, and about where that is."""
    unpacker = zlib.decompressobj(wbits=31)
    parts, at = [], start
    try:
        while at < len(data) and not unpacker.eof:
            part = data[at: at + STEP]
            parts.append(unpacker.decompress(part))
            at += len(part)
    except zlib.error:
        pass
    return b"".join(parts), at


def _parsed(data: bytes | memoryview, start: int) -> tuple[dict[str, str], bytes, int]:
    """Header, payload and end of the record that begins at ``start``."""
    head = _HEAD.match(data, start)
    if not head:
        raise ValueError("bad header")
    fields = {}
    for line in head[1].decode("utf-8", "replace").split("\r\n")[:-1]:
        name, _, value = line.partition(":")
        fields.setdefault(name.lower(), value.strip())
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")) or not _MUST <= fields.keys():
        raise ValueError("bad header")
    end = head.end() + int(fields["content-length"])
    if bytes(data[end: end + 4]) != b"\r\n\r\n":
        raise ValueError("bad length")
    block = bytes(data[head.end(): end])
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and _hexadecimal(digest) != hashlib.sha1(block).hexdigest():
        raise ValueError("bad digest")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        http, separator, payload = block.partition(b"\r\n\r\n")
        if not separator:
            raise ValueError("bad block")
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        if length:
            fields["payload-length"] = length[1].decode()
    if fields["warc-type"] == "response" and fields.get("warc-payload-digest", "").startswith("sha1:"):
        if _hexadecimal(fields["warc-payload-digest"]) != hashlib.sha1(payload).hexdigest():
            raise ValueError("bad digest")
    return fields, payload, end + 4


def _inside(raw: bytes, start: int, end: int) -> Iterator[Salvaged]:
    """Records and gaps of the unpacked bytes of the member at ``start`` to ``end``."""
    at, gap, reason = 0, None, ""
    while at < len(raw):
        try:
            fields, payload, after = _parsed(raw, at)
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            following = _LINE.search(raw, at + 1)
            at = following.start() if following else len(raw)
            continue
        if gap is not None:
            yield Salvaged(start, end, reason, {}, b"", (gap, at))
            gap = None
        yield Salvaged(start, end, None, fields, payload, (at, after))
        at = after
    if gap is not None:
        yield Salvaged(start, end, reason, {}, b"", (gap, len(raw)))


def _at(data: memoryview, start: int) -> tuple[Iterator[Salvaged], int]:
    """What begins at ``start`` (a member with all in it, or one plain record) and its end."""
    if bytes(data[start: start + 3]) == MAGIC:
        try:
            raw, end = _unzipped(data, start)
        except zlib.error as error:
            raise ValueError("bad member") from error
        return _inside(raw, start, end), end
    if bytes(data[start: start + len(VERSION)]) == VERSION:
        fields, payload, end = _parsed(data, start)
        return iter([Salvaged(start, end, None, fields, payload)]), end
    raise ValueError("no record")


def salvage(content: bytes) -> Iterator[Salvaged]:
    """All valid records of an archive, and the gaps between them, in order."""
    data, at, gap, reason = memoryview(content), 0, None, ""
    recovered: list[Salvaged] = []
    while at < len(data):
        try:
            found, end = _at(data, at)
        except ValueError as error:
            if gap is None:
                gap, reason = at, str(error)
            if bytes(data[at: at + 3]) == MAGIC:
                raw, damaged = _unzipped_part(data, at)
                recovered += [r for r in _inside(raw, at, damaged) if r.problem is None]
            following = _START.search(content, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield Salvaged(gap, at, reason, {}, b"", None, tuple(recovered))
            gap, recovered = None, []
        yield from found
        at = end
    if gap is not None:
        yield Salvaged(gap, len(data), reason, {}, b"", None, tuple(recovered))


READ = (
    "archive string, start long, end long, inner_start long, inner_end long, problem string, checked boolean, record_type string,"
    " page_id long, url string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def _long(number: str) -> int | None:
    """A number as Spark's long; NULL if it is none or does not fit."""
    return int(number) if re.fullmatch(r"-?\d{1,19}", number) and -(1 << 63) <= int(number) < 1 << 63 else None


def _page(name: str) -> int | None:
    return _long(name.strip("<>").removeprefix(RECORD_ID))


def _values(r: Salvaged, checked: bool) -> tuple:
    """The columns of a record from ``checked`` on."""
    kind, f = r.fields["warc-type"], r.fields
    digest = _hexadecimal(f.get("warc-payload-digest", ""))
    length = _long(f["payload-length"]) if kind == "revisit" and "payload-length" in f else len(r.payload)
    if kind == "response":
        digest = hashlib.sha1(r.payload).hexdigest()
    return (checked, kind, _page(f.get("warc-record-id", "")), f.get("warc-target-uri"),
            _page(f.get("warc-refers-to", "")), length, digest)


def _rows(with_payload: bool):
    names = [x.split()[0] for x in READ.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds = [types[x.split()[1]] for x in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                rows, size = [], 0
                for found in salvage(content.as_py()):
                    for r in (found, *found.recovered):
                        place = (path.as_py(), r.start, r.end, *(r.inner or (None, None)), r.problem)
                        if r.problem is not None:
                            rows.append((*place, *[None] * 8))
                            continue
                        rows.append((*place, *_values(r, r is found), r.payload if with_payload else None))
                        size += len(r.payload) if with_payload else 100
                        if size > 4_000_000:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> tuple[DataFrame, DataFrame]:
    """The records of all archives below ``path``, and the log of quarantined gaps (archive, start, end, place
    in the unpacked member, problem). Records out of damaged members have ``checked`` false."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    rows = files.mapInArrow(_rows(with_payload), READ)
    return rows.filter("problem IS NULL").drop("problem"), rows.filter("problem IS NOT NULL").select(
        "archive", "start", "end", "inner_start", "inner_end", "problem")


_ORACLE = f"""
    WITH payloads AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    groups AS (
        SELECT *, octet_length(payload) AS bytes, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS last
        FROM payloads)
    SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
        CASE WHEN bytes >= {REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN bytes >= {REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
    FROM groups"""


@query("op2_warc", _ORACLE)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "archives")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records, _ = read_archives(spark, path, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
