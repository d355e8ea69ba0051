"""Operator 1: WARC archives, written by Spark and read by a salvage reader.

Writer: one record per page, each a gzip member of its own. Of records with
equal payloads of at least ``MIN_SHARED`` bytes, the one with the smallest
page_id is a response, the others are revisits that carry the HTTP header
only. Files go through Spark's text writer, which commits the output of
finished tasks only: a row's bytes are the member without its last byte, and
that byte, always zero, is the line separator.

Reader: a file is read member by member, or record by record where it is not
compressed. A record counts only if it passes all checks: the gzip check sum
and length, the version line, the header lines, the length, the two line ends
after the block, and the block and payload digests. After a failed check the
reader searches for the next gzip magic or version line at which a record
passes all checks, goes on from there, and logs the bytes in between as a
quarantined gap (file, offset, length, reason). So damage costs the records
it hits, not those after it. A record found inside the remains of a damaged
uncompressed record cannot be told from a record of its own.

A member that is cut or damaged is searched too, as far as it can be inflated:
its records whose digest holds are read, from a cut one those without a digest
as well, and the member is logged as a gap, with the inflated offset at which
the loss begins. (Bytes inflated before an error may be wrong, so without a
digest nothing vouches for them. Header lines have no digest at all: behind the
damage one may be wrong and still parse.)

A file is one row of Spark's binary reader, so files have to fit a task; the
writer starts a new one after ``FILE_BYTES``. Records and members above
``RECORD_BYTES`` are not read but logged as gaps.

Defined results: a null html is the empty payload; a null url leaves the
target out; equal page_ids with equal payloads are all responses if theirs
is the smallest id; records without page_id are revisits of the smallest
non-null one, or responses if there is none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, shared_path, table, written

MIN_SHARED = 100
FILE_BYTES = 256 << 20     # a task begins another file behind so many bytes
RECORD_BYTES = 1 << 30     # longest record read
CHUNK_BYTES = 1 << 16
BATCH_BYTES = 4 << 20      # payload bytes in one batch of rows read
DATE = "2020-01-01T00:00:00Z"
ID_PREFIX = "urn:x-page:"
# The revisit profile of the standard, gzip's magic, version lines.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
DIGESTS = ("sha1", "sha256", "md5")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_CONTROL = re.compile("[\x00-\x08\x0a-\x1f\x7f\ufffd]")  # never in a header line
_EMPTY_MEMBER = zlib.compress(b"", 6, 31)


# ------------------------------------------------------------------ writer
def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = f"none:{digest}" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{ID_PREFIX}{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if revisit:
        lines += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member_bytes(record: bytes) -> bytes:
    """The record as a gzip member that ends with a zero byte: the high byte
    of its length, or for records of 16 MB or more of an empty member's."""
    member = zlib.compress(record, 6, 31)
    return member if member.endswith(b"\0") else member + _EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """Writes one record per row of ``pages`` to files below ``path``, in folders
    of a task's first, second, ... ``FILE_BYTES``."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    digests = rows.select("id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"))
    shared = written(digests.where(F.col("n") >= MIN_SHARED).groupBy("digest")
                     .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
                     .where("copies > 1 and first is not null").drop("copies"), "warc-shared")
    # both sides are shuffled by the join itself, so AQE can split a digest with very many copies
    joined = (rows.withColumn("digest", F.sha2("payload", 256)).join(shared, "digest", "left")
              .withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))))

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lambda v: None if pd.isna(v) else int(v)
        size = 0
        for batch in batches:
            made = [member_bytes(record_bytes(known(i), url, bytes(payload), digest, known(to)))[:-1]
                    for i, url, payload, digest, to in
                    zip(batch["id"], batch["url"], batch["payload"], batch["digest"], batch["refers_to"])]
            before = size + np.cumsum([0, *map(len, made)])
            yield pd.DataFrame({"volume": before[:-1] // FILE_BYTES, "member": made})
            size = int(before[-1])

    (joined.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest",
                   F.col("refers_to").cast("string").alias("refers_to"))
     .mapInPandas(members, "volume long, member binary").select("volume", F.col("member").cast("string"))
     .write.partitionBy("volume").option("lineSep", "\0").text(path))


# ------------------------------------------------------------------ reader
class Damaged(ValueError):
    """A check failed; the message is the reason logged, ``found`` what could be read all the same."""

    def __init__(self, reason: str, found: tuple = ()):
        super().__init__(reason)
        self.found = found


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes = field(repr=False)

    def http(self) -> tuple[bytes, bytes] | None:
        """(HTTP header, body) of an HTTP block."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return None
        head, mark, body = self.block.partition(b"\r\n\r\n")
        return (head, body) if mark else None

    def has_digest(self) -> bool:
        """Whether a digest that is checked covers the whole block."""
        return self.headers.get("warc-block-digest", "").partition(":")[0].lower() in DIGESTS

    @property
    def payload(self) -> bytes:
        parts = self.http()
        return parts[1] if parts else self.block

    def payload_length(self) -> int:
        """The full payload's length: for a revisit the one its HTTP header has."""
        parts = self.http()
        if self.headers.get("warc-type") == "revisit" and parts:
            found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", parts[0])
            if found:
                return int(found[1])
        return len(self.payload)


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _digest_holds(declared: str, data: bytes) -> bool:
    """Whether the data has the digest (unknown algorithms: no check)."""
    kind, _, value = declared.partition(":")
    if kind.lower() not in DIGESTS:
        return True
    made = hashlib.new(kind.lower(), data)
    return value.lower() == made.hexdigest() or value.upper().rstrip("=") == base64.b32encode(
        made.digest()).decode().rstrip("=")


def _plain_record(data: bytes, at: int) -> Record:
    """The uncompressed record at ``at``, with all checks."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", version.end() - 2, version.end() + CHUNK_BYTES)
    if end < 0:
        raise Damaged("header without end")
    headers: dict[str, str] = {}
    for line in data[version.end():end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or _CONTROL.search(line):
            raise Damaged("bad header line")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("missing header")
    start = end + 4
    stop = start + int(length)
    if int(length) > RECORD_BYTES or stop + 4 > len(data):
        raise Damaged("length beyond the end")
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("no line ends after the block")
    record = Record(at, stop + 4 - at, headers, data[start:stop])
    if not _digest_holds(headers.get("warc-block-digest", ""), record.block):
        raise Damaged("block digest")
    if headers["warc-type"] != "revisit" and not _digest_holds(headers.get("warc-payload-digest", ""), record.payload):
        raise Damaged("payload digest")
    return record


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` inflates to, its length, and why it ends early (None: it does not)."""
    inflate, out, size, fed = zlib.decompressobj(31), [], 0, at
    while not inflate.eof:
        chunk = data[fed:fed + CHUNK_BYTES]
        if not chunk:
            return b"".join(out), fed - at, "member without end"
        before = inflate.copy()
        try:
            out.append(inflate.decompress(chunk))
        except zlib.error as e:
            for n in range(len(chunk)):   # again byte by byte, up to the error
                try:
                    out.append(before.decompress(chunk[n:n + 1]))
                except zlib.error:
                    break
            return b"".join(out), fed + n - at, f"gzip: {e}"
        fed += len(chunk)
        size += len(out[-1])
        if size > RECORD_BYTES:
            raise Damaged("length beyond the limit")
    return b"".join(out), fed - len(inflate.unused_data) - at, None


def _member(data: bytes, at: int) -> tuple[list[Record | Gap], int]:
    """The records and gaps of the gzip member at ``at`` (none if it is empty) and its length."""
    content, length, cut = _inflated(data, at)
    found, inner, broken, whole = [], 0, None, 0
    while inner < len(content):
        try:
            record = _plain_record(content, inner)
            if cut and cut.startswith("gzip") and not record.has_digest():
                raise Damaged("no digest in a damaged member")
        except Damaged as e:
            broken = broken or (inner, str(e))
            version = VERSION.search(content, inner + 1)
            inner = version.start() if version else len(content)
            continue
        if broken:
            found.append(_inner_gap(at, length, *broken, inner))
            broken = None
        inner += record.length
        whole += 1
        found.append(Record(at, length, record.headers, record.block))
    if cut:
        lost = broken[0] if broken else len(content)
        raise Damaged(f"{cut} (inflated bytes from {lost} on)" if whole else cut, tuple(found if whole else ()))
    if broken:
        if not whole:
            raise Damaged(broken[1])
        found.append(_inner_gap(at, length, *broken, len(content)))
    return found, length


def _inner_gap(at: int, length: int, begin: int, reason: str, end: int) -> Gap:
    """A gap inside the member at ``at``; the reason names its inflated bytes."""
    return Gap(at, length, f"{reason} (inflated bytes {begin} to {end})")


def _next_candidate(data: bytes, at: int) -> int:
    magic = data.find(MAGIC, at)
    version = VERSION.search(data, at)
    places = [p for p in (magic, version.start() if version else -1) if p >= 0]
    return min(places, default=-1)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and quarantined gaps of a file, in order; together they cover it
    (apart from empty members)."""
    at = 0
    broken: tuple[int, str] | None = None  # where the open gap begins, and why
    while at < len(data):
        try:
            if data.startswith(MAGIC, at):
                records, length = _member(data, at)
            else:
                found = _plain_record(data, at)
                records, length = [found], found.length
        except Damaged as e:
            if e.found:
                if broken:
                    yield Gap(broken[0], at - broken[0], broken[1])
                yield from e.found
                broken = at, str(e)
            broken = broken or (at, str(e))
            at = _next_candidate(data, at + 1)
            if at < 0:
                break
            continue
        if broken:
            yield Gap(broken[0], at - broken[0], broken[1])
            broken = None
        yield from records
        at += length
    if broken:
        yield Gap(broken[0], len(data) - broken[0], broken[1])


READ_SCHEMA = ("file string, offset long, length long, gap string, warc_type string, record_id string, "
               "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, names: str = "*") -> DataFrame:
    """One row per record or quarantined gap of the archives below ``path``, in
    folders of any depth; ``names`` is a pattern of file names.

    ``gap`` is the reason for a gap, null for a record. ``payload_digest`` is
    the SHA-256 of the payload, for a revisit the one it declares, in bare
    hexadecimal; ``payload_bytes`` the full payload's length.
    """
    bounded_batches(spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                for x in salvage(bytes(content)):
                    if isinstance(x, Gap):
                        rows.append((file, x.offset, x.length, x.reason, *[None] * 7))
                        continue
                    h, payload = x.headers, x.payload
                    revisit = h["warc-type"] == "revisit"
                    digest = (h.get("warc-payload-digest", "").rpartition(":")[2] if revisit
                              else hashlib.sha256(payload).hexdigest())
                    rows.append((file, x.offset, x.length, None, h["warc-type"], h["warc-record-id"],
                                 h.get("warc-refers-to"), h.get("warc-target-uri"), digest, x.payload_length(),
                                 payload if with_payload and not revisit else None))
                    held += len(payload) + 500
                    if held >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return (spark.read.format("binaryFile").option("pathGlobFilter", names)
            .option("recursiveFileLookup", True).load(path).select("path", "content")
            .mapInPandas(read, READ_SCHEMA))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, f"^<{ID_PREFIX}(-?\\d+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    return (read_archives(spark, path, with_payload=False).where("gap is null")
            .select(as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                    F.col("warc_type").alias("record_type"), as_id("refers_to").alias("refers_to")))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload)) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
